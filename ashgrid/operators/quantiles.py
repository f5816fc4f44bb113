"""Quantiles by group: mergeable sketches, and exact ones by refining brackets.

No form holds the values of a group together.  A sketch (KLL) has a bounded
size; sketches of parts merge into that of the whole.  The exact form narrows
a bracket around each wanted rank: sketches name probes near it, one counting
pass says how many values lie between the probes, and the bracket becomes the
stretch that holds the rank, until it holds one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ashgrid.session import scratch_path

#: Size parameter of the sketches.
SKETCH_K = 200
#: Steps of the grid of ranks that a sketch is asked for.
GRID = 64
#: Rows of brackets that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Parts that a group's rows are dealt into where they are shuffled.
PARTS = 16


def rank_error(k: int = SKETCH_K) -> float:
    """Share of a group's rows by which a sketch of size ``k`` may miss a rank.

    The published fit of the sketch's error at 99 % confidence, doubled.
    """
    return 2 * 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, group: str, value: str, k: int = SKETCH_K,
                      out: str = "sketch") -> DataFrame:
    """(group, n, sketch) of the non-null values of each group; partial sketches merge map-side."""
    return df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias(out))


def merge_sketches(sketches: DataFrame, group: str, k: int = SKETCH_K,
                   sketch: str = "sketch") -> DataFrame:
    """Sketches of parts (say, of the years) to those of ``group``, without the values."""
    return sketches.groupBy(group).agg(F.sum("n").alias("n"),
                                       F.kll_merge_agg_double(sketch, F.lit(k)).alias(sketch))


def sketch_quantiles(sketches: DataFrame, group: str, quantiles: list[float],
                     sketch: str = "sketch") -> DataFrame:
    """(group, q, n, value): a value of the group whose rank is within ``rank_error`` of q's."""
    asked = F.array(*(F.lit(float(q)) for q in quantiles))
    each = F.arrays_zip(asked.alias("q"), F.kll_sketch_get_quantile_double(sketch, asked).alias("value"))
    return sketches.select(group, "n", F.explode(each).alias("x")).select(
        group, "x.q", "n", "x.value")


def exact_quantiles(df: DataFrame, group: str, value: str, quantiles: list[float],
                    k: int = SKETCH_K) -> DataFrame:
    """(group, q, n, value): the quantile by linear interpolation between neighbouring ranks.

    Null values don't count; a group without others has no row; rows of null
    group are a group of their own.  Every pass reads the rows that are still
    inside an open bracket, which shrink to a few hundredths each time, whatever the
    values' distribution; a value repeated by a third of all rows is a
    bracket of its own and closes at once.
    """
    rows = _saved(df.where(F.col(value).isNotNull()).select(
        F.struct(F.col(group)).alias("g"), F.col(value).cast("double").alias("v")), "quantile-rows")
    sizes = _saved(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                                         F.max("v").alias("hi")), "quantile-groups")
    at = (F.col("n") - 1) * F.col("q")
    asked = sizes.select("g", "n", F.explode(F.array(*map(F.lit, quantiles))).alias("q")).select(
        "g", "n", "q", F.floor(at).alias("low"), F.ceil(at).alias("high"),
        (at - F.floor(at)).alias("part"))
    ranks = asked.select("g", F.explode(F.array("low", "high")).alias("rank")).distinct()
    # (group, rank, bracket, values below the bracket)
    state = _saved(ranks.join(sizes, "g").select("g", "rank", "lo", "hi", F.lit(0).cast("long")
                                                 .alias("below")), "quantile-state")
    done = []
    active = rows
    while True:
        done.append(state.where("lo = hi"))
        if (todo := state.where("lo < hi")).isEmpty():
            break
        brackets = todo.select("g", "lo", "hi").distinct()
        active = _saved(_inside(active, brackets, _within("g", "lo", "hi")).select("g", "lo", "v"),
                        "quantile-rows")
        sketches = active.groupBy("g", "lo").agg(
            F.count(F.lit(1)).alias("m"), F.kll_sketch_agg_double("v", F.lit(k)).alias("s"))
        cuts = _saved(todo.join(sketches, ["g", "lo"]).groupBy("g", "lo").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(_probes(k))))).alias("cuts")),
            "quantile-cuts")
        counted = (_inside(active, cuts, [F.col("r.g") == F.col("b.g"),
                                          F.col("r.lo") == F.col("b.lo")])
                   # a probe is a stretch of its own: a repeated value closes its bracket
                   .select("g", "lo", "v", (F.size(F.filter("cuts", lambda c: c < F.col("v")))
                                            + F.size(F.filter("cuts", lambda c: c <= F.col("v"))))
                           .alias("place"))
                   .groupBy("g", "lo", "place").agg(F.count(F.lit(1)).alias("m"),
                                                    F.min("v").alias("least"),
                                                    F.max("v").alias("most")))
        # a bracket has a few stretches for each rank in it
        before = Window.partitionBy("g", "lo").orderBy("place").rowsBetween(
            Window.unboundedPreceding, -1)
        counted = counted.withColumn("under", F.coalesce(F.sum("m").over(before), F.lit(0)))
        narrowed = (todo.join(counted, ["g", "lo"])
                    .where((F.col("rank") >= F.col("below") + F.col("under"))
                           & (F.col("rank") < F.col("below") + F.col("under") + F.col("m"))))
        state = _saved(narrowed.select(
            "g", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"),
            (F.col("below") + F.col("under")).alias("below")), "quantile-state")
        active = active.select("g", "v")
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    found = found.select(F.col("g").alias("fg"), "rank", F.col("lo").alias("v"))
    low = found.select("fg", F.col("rank").alias("low"), F.col("v").alias("low_v"))
    high = found.select("fg", F.col("rank").alias("high"), F.col("v").alias("high_v"))
    return (asked.withColumnRenamed("g", "fg").join(low, ["fg", "low"]).join(high, ["fg", "high"])
            .select(F.col("fg")[group].alias(group), "q", "n",
                    (F.col("low_v") + (F.col("high_v") - F.col("low_v")) * F.col("part"))
                    .alias("value")))


def _probes(k: int) -> Column:
    """Values on both sides of a rank's place in its bracket, from a grid, and its ends."""
    place = (F.col("rank") - F.col("below") + F.lit(0.5)) / F.col("m") * GRID
    miss = F.lit(rank_error(k) / 2 * GRID)
    grid = F.kll_sketch_get_quantile_double("s", F.array(*(F.lit(i / GRID) for i in range(GRID + 1))))

    def at(step: Column) -> Column:
        return F.element_at(grid, F.least(F.lit(GRID), F.greatest(F.lit(0), step)).cast("int") + 1)
    return F.array(F.col("lo"), at(F.floor(place - miss)), at(F.ceil(place + miss)), F.col("hi"))


def _within(group: str, lo: str, hi: str) -> list[Column]:
    return [F.col(f"r.{group}") == F.col(f"b.{group}"), F.col("r.v") >= F.col(f"b.{lo}"),
            F.col("r.v") <= F.col(f"b.{hi}")]


def _inside(rows: DataFrame, few: DataFrame, on: list[Column]) -> DataFrame:
    """Rows joined with the few brackets of their group.

    Few enough (their number is counted) are broadcast.  Else both sides are
    shuffled, every group's rows in ``PARTS`` parts, so a group that holds a
    third of all rows is not one task's work.
    """
    held = [c for c in rows.columns if c not in few.columns]
    if few.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    else:
        rows = rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
        few = few.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        on = [*on, F.col("r.part") == F.col("b.part")]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return rows.alias("r").join(few.alias("b"), condition).select(
        *(f"r.{c}" for c in held), "b.*")


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
