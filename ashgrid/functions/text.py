"""Text cleaning, entity keys, categories and multi-value fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Words dropped from unit names when building a matching key.
STOP_WORDS = ("DE", "DA", "DO", "DAS", "DOS", "E", "RIO")

# Accented capitals and the plain letter a key uses for each (the yearly
# tables are ASCII; names typed with accents elsewhere still get one key).
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUCN"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: ColumnOrName, marks: str = "*") -> Column:
    """Drop footnote marks at the end, collapse runs of blanks to one,
    trim; blank to null."""
    cls = "".join("\\" + m for m in marks)
    stripped = F.regexp_replace(_col(c), f"\\s*[{cls}]+\\s*$", "")
    single = F.regexp_replace(stripped, "\\s+", " ")
    return F.nullif(F.trim(single), F.lit(""))


def unit_key(c: ColumnOrName, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Matching key: upper case, accents dropped, every run of
    non-alphanumerics becomes one blank, stop words are dropped, words are
    joined by one blank.

    Written with ``regexp_replace`` only (no lambda), so it stays inside
    whole-stage codegen: the name is padded with blanks and each stop word
    is removed together with the blank before it; the lookahead leaves the
    blank after it for the next word."""
    plain = F.translate(F.upper(_col(c)), ACCENTED, PLAIN)
    spaced = F.regexp_replace(plain, "[^A-Z0-9]+", " ")
    padded = F.concat(F.lit(" "), spaced, F.lit(" "))
    alt = "|".join(stop_words)
    dropped = F.regexp_replace(padded, f" (?:{alt})(?= )", "")
    return F.nullif(F.trim(dropped), F.lit(""))


def category(c: ColumnOrName) -> Column:
    """First word of the name (APA, PARNA, ...)."""
    return F.nullif(F.substring_index(F.trim(_col(c)), " ", 1), F.lit(""))


def split_values(c: ColumnOrName, sep_regex: str = r"\s*/\s*") -> Column:
    """Split a list held in one string; empty parts dropped.  The separator
    pattern swallows the blanks around it, so parts come out trimmed."""
    return F.array_remove(F.split(F.trim(_col(c)), sep_regex), F.lit(""))


def split_known(c: ColumnOrName, known: list[str] | tuple[str, ...],
                joiner: str = " E ") -> Column:
    """Split on ``joiner`` only when every part is a known value.

    Text that merely contains the joiner (a name with " E " inside) stays
    whole, as a one-element array.
    """
    parts = F.split(_col(c), joiner)
    all_known = F.size(F.array_except(parts, F.array(*[F.lit(k) for k in known]))) == 0
    return F.when(_col(c).isNull(), F.lit(None)).when(
        all_known, parts).otherwise(F.array(_col(c)))


def null_if(c: ColumnOrName, sentinel: str = "-") -> Column:
    """The sentinel (after trimming) becomes null."""
    return F.nullif(F.trim(_col(c)), F.lit(sentinel))
