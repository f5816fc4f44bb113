"""Order units inside a year and number them from 0 (the index column)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ashgrid.session import checkpoint_root

_POS_BITS = 33  # monotonically_increasing_id: partition index above bit 33


def index_within(df: DataFrame, group: str, order: list[str], out: str = "ind") -> DataFrame:
    """0-based position of each row inside its group, by ``order``.

    ``row_number()`` over ``partitionBy(group)`` would sort a whole group in
    one task, and one year may hold a third of all rows.  Instead:

    1. one global sort by (group, order): a range exchange spreads every
       group over as many tasks as its size needs;
    2. ``monotonically_increasing_id`` gives each row (task, position);
       the sorted, tagged rows are checkpointed into the shared checkpoint
       folder so later steps see one fixed numbering, also if an executor
       is lost and a task reruns;
    3. a small table of (task, group) -> first position, row count, and a
       running count over tasks (at most tasks + groups rows) gives each
       task's offset inside the group;
    4. index = offset + position - first position.

    The offset table has at most tasks + groups rows; Spark broadcasts it or
    shuffles both sides by its measured size.
    """
    pos, part = "__pos", "__part"
    tagged = (df.orderBy(F.col(group), *[F.col(c) for c in order])
                .withColumn(pos, F.monotonically_increasing_id()))
    checkpoint_root(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    tagged = tagged.withColumn(part, F.shiftright(F.col(pos), _POS_BITS))
    stats = (tagged.groupBy(part, group)
                   .agg(F.min(pos).alias("__first"), F.count(F.lit(1)).alias("__n")))
    w = (Window.partitionBy(group).orderBy(part)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stats = (stats.withColumn("__offset", F.sum("__n").over(w) - F.col("__n"))
                  .select(F.col(part).alias("__spart"), F.col(group).alias("__sgroup"),
                          "__first", "__offset")
                  .checkpoint(eager=True))
    on = (F.col(part) == F.col("__spart")) & F.col(group).eqNullSafe(F.col("__sgroup"))
    idx = (F.col("__offset") + F.col(pos) - F.col("__first"))
    return (tagged.join(stats, on, "inner")
                  .withColumn(out, idx)
                  .drop(pos, part, "__spart", "__sgroup", "__first", "__offset"))
