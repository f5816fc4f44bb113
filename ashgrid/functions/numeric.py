"""Row arithmetic: percent of a whole, rounding, sums of parts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName, scale: int) -> Column:
    """Round a double to ``scale`` decimals, ties away from zero.

    The value goes through a decimal first so the tie rule works on the
    printed digits, the same in every engine, rather than on the binary
    double (where 1.005 is a hair below 1.005).  A value too large for the
    decimal (beyond 1e26) is returned unrounded instead of failing the query.
    """
    x = _col(c)
    return F.coalesce(F.round(x.try_cast("decimal(38,12)"), scale).cast("double"), x)


def percent_of(part: ColumnOrName, whole: ColumnOrName,
               scale: int | None = None) -> Column:
    """``100 * part / whole``; null where the whole is not positive.

    With ``scale`` the percent is rounded half-up to that many decimals.
    """
    pct = F.when(_col(whole) > 0, F.lit(100) * _col(part) / _col(whole))
    return round_half_up(pct, scale) if scale is not None else pct


def component_sum(parts: list[ColumnOrName],
                  decimal_type: str | None = None) -> Column:
    """Row-wise total of the parts.

    Null counts as 0 as soon as one part is present; the total is null only
    when every part is null (an unsplit row is not a row of zeros).  With
    ``decimal_type`` the parts are added as decimals, so the total does not
    depend on the order of the terms.
    """
    cols = [_col(p) for p in parts]
    any_present = reduce(lambda a, b: a | b, [c.isNotNull() for c in cols])
    k = _integer_scale(decimal_type) if decimal_type else None
    if k:
        # same exact result as the decimal, added as 64-bit integers
        ints = [F.coalesce(F.round(c * F.lit(k)).cast("bigint"), F.lit(0).cast("bigint"))
                for c in cols]
        return F.when(any_present, reduce(lambda a, b: a + b, ints) / F.lit(k))
    if decimal_type:
        cols = [c.cast(decimal_type) for c in cols]
        zero = F.lit(0).cast(decimal_type)
    else:
        zero = F.lit(0.0)
    total = reduce(lambda a, b: a + b, [F.coalesce(c, zero) for c in cols])
    out = F.when(any_present, total)
    return out.cast("double") if decimal_type else out


def _integer_scale(decimal_type: str) -> int | None:
    """10^s for ``decimal(p,s)`` with p <= 18 (fits a 64-bit integer)."""
    m = re.fullmatch(r"\s*decimal\((\d+)\s*,\s*(\d+)\)\s*", decimal_type)
    return 10 ** int(m.group(2)) if m and int(m.group(1)) <= 18 else None


def exact_sum(c: ColumnOrName, decimal_type: str = "decimal(38,12)",
              window: WindowSpec | None = None) -> Column:
    """Aggregate sum that does not depend on the order of the rows, as a
    double; over the frame of ``window`` if one is given.

    For ``decimal(p,s)`` with p <= 18 each value is taken to s decimals as
    a 64-bit integer (``round(value * 10^s)``, half away from zero) and the
    integers are added: exact, and cheaper than decimal arithmetic in the
    aggregation buffer.  Wider types add as that decimal.  A long overflow
    raises under ANSI mode instead of wrapping.
    """
    col = _col(c)
    k = _integer_scale(decimal_type)
    total = F.sum(F.round(col * F.lit(k)).cast("bigint") if k else col.cast(decimal_type))
    if window is not None:
        total = total.over(window)
    return total / F.lit(k) if k else total.cast("double")


def scaled(c: ColumnOrName, decimal_type: str) -> Column:
    """The value as a whole number of its last decimal (``decimal(p,s)``, p at most 18)."""
    k = _integer_scale(decimal_type)
    if not k:
        raise ValueError(f"{decimal_type} does not fit a 64-bit integer")
    return F.round(_col(c) * F.lit(k)).cast("bigint")


def unscaled(c: ColumnOrName, decimal_type: str) -> Column:
    """The value of a ``scaled`` number, as a double."""
    return _col(c) / F.lit(_integer_scale(decimal_type))
