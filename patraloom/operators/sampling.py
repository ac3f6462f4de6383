"""Quotas, seeded samples, representatives and balancing.

Seeded draws order rows by SHA-256 of seed, group and id: the same rows come
out whatever the partitioning, though not those of another random generator.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def largest_remainder(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Whole shares of ``total``; leftovers by larger remainder, then key."""
    whole = sum(weights.values())
    if total <= 0 or whole <= 0:
        return dict.fromkeys(weights, 0)
    exact = {k: w / whole * total for k, w in weights.items()}
    out = {k: math.floor(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], k))[: total - sum(out.values())]:
        out[k] += 1
    return out


def shares(counts: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """:func:`largest_remainder` as a frame: adds ``quota``; one row per key is expected."""
    every = W.partitionBy()
    exact = F.col(weight) / F.sum(weight).over(every) * F.lit(float(total))
    out = counts.withColumn("x", exact).withColumn("f", F.floor("x"))
    out = out.withColumn("r", F.row_number().over(W.orderBy(F.col("f") - F.col("x"), key))).withColumn("short", F.lit(total) - F.sum("f").over(every))
    return out.withColumn("quota", F.col("f") + F.when(F.col("r") <= F.col("short"), 1).otherwise(0)).drop("x", "f", "r", "short")


def target_counts(majority: Mapping[str, int], minority: Mapping[str, int], total: int, mode: str) -> dict[str, int]:
    """How many majority rows to keep per source: in the majority's own
    proportions (``proportional``) or the minority's (``match_minority``), never
    more than there are; what is lacking goes to where most is left."""
    if mode not in ("proportional", "match_minority"):
        raise ValueError(f"unknown mode {mode!r}")
    quota = largest_remainder(majority if mode == "proportional" else minority, total)
    out = {k: min(q, majority.get(k, 0)) for k, q in quota.items()}
    lacking = min(total, sum(majority.get(k, 0) for k in quota)) - sum(out.values())
    while lacking > 0:
        k = min(out, key=lambda k: (out[k] - majority.get(k, 0), k))
        step = min(lacking, majority.get(k, 0) - out[k])
        out[k] += step
        lacking -= step
    return out


def draw_key(seed: int | str, group: Column | str, key: Column | str) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(c(group).cast("string"), F.lit("")), F.lit(":"), c(key).cast("string")), 256)


def downsample(df: DataFrame, quotas: DataFrame, group: str, key: str, seed: int | str) -> DataFrame:
    """Of each group, the ``quota`` rows (of ``quotas``) with the smallest draw
    keys; groups without a quota give none.

    Counts per leading digits of the draw key tell which rows are surely in, so
    that only one small slice of a group is ever sorted.
    """
    kept = df.join(quotas.select(group, "quota").where("quota > 0"), group).withColumn("_k", draw_key(seed, group, key)).withColumn("_b", F.substring("_k", 1, 3))
    slices = kept.groupBy(group, "quota", "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(group).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow))
    slices = slices.withColumn("_before", upto - F.col("_n")).select(group, "_b", "_n", "_before")
    placed = kept.join(slices, [group, "_b"]).where("_before < quota")
    sure = placed.where("_before + _n <= quota")
    edge = placed.where("_before + _n > quota").withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy("_k", key)) + F.col("_before")).where("_r <= quota").drop("_r")
    return sure.unionByName(edge).drop("quota", "_k", "_b", "_n", "_before")


def _quota_frame(df: DataFrame, group: str, quotas: Mapping[str, int]) -> DataFrame:
    return df.sparkSession.createDataFrame(list(quotas.items()), f"{group} string, quota long")


def stratified_sample(df: DataFrame, n: int, strata: str, key: str, seed: int | str) -> DataFrame:
    """About ``n`` rows, strata in proportion to their size (largest remainder);
    rows with a null stratum don't take part. One count per stratum is collected."""
    known = df.where(F.col(strata).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(strata).count().collect()}
    quota = {k: min(q, counts[k]) for k, q in largest_remainder(counts, min(n, sum(counts.values()))).items()}
    return downsample(known, _quota_frame(df, strata, quota), strata, key, seed)


def simple_sample(df: DataFrame, n: int, key: str, seed: int | str) -> DataFrame:
    """The ``n`` rows with the smallest draw keys, without strata."""
    one = df.withColumn("_all", F.lit(""))
    quota = df.sparkSession.createDataFrame([("", n)], "_all string, quota long")
    return downsample(one, F.broadcast(quota), "_all", key, seed).drop("_all")  # one row


def balanced_sample(df: DataFrame, n: int, label: str, strata: str, key: str, seed: int | str) -> DataFrame:
    """``n // 2`` rows of label 1 and of label 0, each stratified."""
    parts = [stratified_sample(df.where(F.col(label) == y), n // 2, strata, key, f"{seed}:{y}") for y in (1, 0)]
    return parts[0].unionByName(parts[1])


def balance(df: DataFrame, label: str, source: str, key: str, mode: str, seed: int | str = 42) -> DataFrame:
    """The rarer label whole and as many rows of the other, its sources chosen
    by :func:`target_counts`; on a tie label 1 is the rarer. Fewer rows than
    needed are an error. Rows with a null label or source don't take part."""
    known = df.where(F.col(label).isNotNull() & F.col(source).isNotNull())
    counts: dict[int, dict[str, int]] = {0: {}, 1: {}}
    for y, s, n in known.groupBy(label, source).count().collect():
        counts[y][s] = n
    rare = 1 if sum(counts[1].values()) <= sum(counts[0].values()) else 0
    total = sum(counts[rare].values())
    quota = target_counts(counts[1 - rare], counts[rare], total, mode)
    if sum(quota.values()) != total:
        raise ValueError(f"{mode}: {sum(quota.values())} rows for {total}")
    return known.where(F.col(label) == rare).unionByName(downsample(known.where(F.col(label) == 1 - rare), _quota_frame(df, source, quota), source, key, seed))


def sample_per_group(df: DataFrame, n: int, group: str, key: str, seed: int | str) -> DataFrame:
    """``n`` rows of each group, for people to look at."""
    return downsample(df, df.where(F.col(group).isNotNull()).select(group).distinct().withColumn("quota", F.lit(n)), group, key, seed)


def representatives(df: DataFrame, group: str, label: str, source: str, key: str) -> DataFrame:
    """One row per group with ``cluster_size`` and ``cells``: the lowest key of
    its most frequent (label, source) cell. Of equally frequent cells that of
    the group's lowest key wins if it is among them, else the lowest cell.

    Cells are counted before groups are compared, so a group of any size is
    aggregated in parts."""
    cells = df.groupBy(group, label, source).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
    best = F.min_by(F.struct(label, source, "first"), F.struct((-F.col("n")).alias("n"), (F.col("first") != F.col("lowest")).alias("l"), F.col(label).alias("y"), F.col(source).alias("s")))
    low = cells.groupBy(group).agg(F.min("first").alias("lowest"))
    picked = cells.join(low, group).groupBy(group).agg(best.alias("cell"), F.sum("n").alias("cluster_size"), F.count(F.lit(1)).alias("cells"))
    return picked.select(group, F.col("cell.first").alias(key), F.col(f"cell.{label}").alias(label), F.col(f"cell.{source}").alias(source), "cluster_size", "cells")
