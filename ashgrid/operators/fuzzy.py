"""Blocked fuzzy matching of entity names with a size check.

Candidates come from exact equi-joins, never from comparing every pair in a
block, and no candidate is dropped by a cap:

* Edit distance.  Cut each name of length L into t + 1 segments
  (t = ``max_dist``).  If two names are within t edits, some segment i of
  the shorter name survives untouched in the longer one (pigeonhole; the
  partition-based filter of Li et al., "Pass-Join", VLDB 2011), and one
  such segment sits at a shift d from its own start with |d| <= i and
  |d - D| <= t - i, where D is the length difference.  (With e_j edits
  inside segment j, B_i = e_0 + ... + e_{i-1} moves as B_i - i by e_i - 1
  per segment, from 0 down to E - t - 1; the last untouched segment where
  it steps from E - t to E - t - 1 has B_i = i + E - t, so at most i edits
  before it and t - i after it.)  The index side emits its segments, the
  probe side emits, for every length it may pair with, the substrings at
  those shifts; an equi-join on (length, segment no., text) finds every
  pair that can be within the distance.
* Size.  Two sizes within a relative tolerance t have log-sizes closer than
  -ln(1 - t); with buckets twice that wide, partners sit in the same or a
  neighbouring bucket, so one side's sizes are replicated to three buckets
  and sizes are paired by an equi-join on the bucket.

The bucket is part of the candidate key, so names meet only where their sizes
may: names that share a segment but not a size are never paired.  A name is
never compared with itself; every candidate name pair is verified once with
``levenshtein(a, b, max_dist)``, then sizes are attached and checked with the
exact rule.  Names equal as text are the same
entity (see ``unit_key``) and are not reported.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ashgrid.session import checkpoint_root


def _name_pairs(names: DataFrame, block: list[str], tau: int) -> DataFrame:
    """(block..., name_a, name_b, dist): distinct names of one block within
    ``tau`` edits that have sizes in the same or neighbouring buckets, name_a <
    name_b.  ``names`` holds each (block, name, bucket) once, so a name
    repeated on many rows is compared once."""
    nseg = tau + 1

    def seg_len(L, i):
        # the first nseg - L % nseg segments are L // nseg long, the rest one longer
        return F.floor(L / nseg) + F.when(i >= F.lit(nseg) - L % nseg, 1).otherwise(0)

    def seg_start(L, i):
        short = F.lit(nseg) - L % nseg
        return i * F.floor(L / nseg) + F.greatest(F.lit(0), i - short)

    names = names.withColumn("__len", F.length("__name"))
    idx = (names.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(tau))))
                .withColumn("__slen", seg_len(F.col("__len"), F.col("__i")))
                .withColumn("__start", seg_start(F.col("__len"), F.col("__i")))
                .select(*block, "__bucket", F.col("__len").alias("__L"), "__i",
                        F.col("__name").substr(F.col("__start") + 1, F.col("__slen")).alias("__seg"),
                        F.col("__name").alias("__name_s")))
    probe = (names.withColumn("__d", F.explode(F.sequence(F.lit(0), F.lit(tau))))
                  .withColumn("__L", F.col("__len") - F.col("__d"))
                  .where(F.col("__L") >= 0)
                  .withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(tau))))
                  .withColumn("__shift", F.explode(F.sequence(F.lit(-tau), F.lit(tau))))
                  .where((F.abs(F.col("__shift")) <= F.col("__i"))
                         & (F.abs(F.col("__shift") - F.col("__d")) <= F.lit(tau) - F.col("__i")))
                  .withColumn("__slen", seg_len(F.col("__L"), F.col("__i")))
                  .withColumn("__q", seg_start(F.col("__L"), F.col("__i")) + F.col("__shift"))
                  .where((F.col("__q") >= 0) & (F.col("__q") + F.col("__slen") <= F.col("__len")))
                  .withColumn("__near", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
                  .select(*block, (F.col("__bucket") + F.col("__near")).alias("__bucket"),
                          "__L", "__i",
                          F.col("__name").substr(F.col("__q") + 1, F.col("__slen")).alias("__seg"),
                          F.col("__name").alias("__name_r"))
                  .distinct())
    cand = (probe.join(idx, [*block, "__bucket", "__L", "__i", "__seg"], "inner")
                 .where(F.col("__name_r") != F.col("__name_s"))
                 .select(*block, F.least("__name_r", "__name_s").alias("name_a"),
                         F.greatest("__name_r", "__name_s").alias("name_b"))
                 .distinct())
    dist = F.levenshtein(F.col("name_a"), F.col("name_b"), tau)
    return cand.withColumn("dist", dist.cast("int")).where(F.col("dist") >= 0)


def fuzzy_pairs(df: DataFrame, name: str, size: str, block: list[str],
                max_dist: int = 2, size_tol: float = 0.01) -> DataFrame:
    """(block..., name_a, name_b, size_a, size_b, dist) with name_a < name_b,
    ``levenshtein <= max_dist`` and ``|size_a - size_b| < size_tol * max``.

    Text is matched on distinct (block, name, size bucket) first; sizes are attached
    afterwards through an equi-join on neighbouring size buckets, so a name
    seen with many sizes is neither compared with itself nor paired with
    every size of its partner.
    """
    tau = int(max_dist)
    width = 2.0 * -math.log1p(-size_tol)
    ent = df.select(*block, F.col(name).alias("__name"), F.col(size).cast("double").alias("__size"))
    for b in block:
        ent = ent.where(F.col(b).isNotNull())
    ent = (ent.where(F.col("__name").isNotNull() & (F.col("__size") > 0)).distinct()
              .withColumn("__bucket", F.floor(F.log("__size") / F.lit(width))))
    # the entities feed four branches: computed once
    checkpoint_root(df.sparkSession)
    ent = ent.checkpoint(eager=True)
    pairs = _name_pairs(ent.select(*block, "__name", "__bucket").distinct(), block, tau)

    a = ent.select(*block, F.col("__name").alias("name_a"), F.col("__size").alias("size_a"),
                   F.col("__bucket").alias("__bucket_a"))
    b = ent.select(*block, F.col("__name").alias("name_b"), F.col("__size").alias("size_b"),
                   F.explode(F.array(F.col("__bucket") - 1, F.col("__bucket"),
                                     F.col("__bucket") + 1)).alias("__bucket_a"))
    near = F.abs(F.col("size_a") - F.col("size_b")) < F.lit(size_tol) * F.greatest("size_a", "size_b")
    return (pairs.join(a, [*block, "name_a"], "inner")
                 .join(b, [*block, "name_b", "__bucket_a"], "inner")
                 .where(near)
                 .select(*block, "name_a", "name_b", "size_a", "size_b", "dist"))
