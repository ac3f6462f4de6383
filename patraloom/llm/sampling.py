"""Problem 2: a sample whose category shares match targets.

Categories are counted, integer quotas allotted by largest remainder between
minimum floors and what is available, and the rows with the smallest random
keys of each category selected. The only thing on the driver is one number per
category of the targets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.session import cut

#: Buckets of the random keys; only one bucket of a category is ever sorted.
BUCKETS = 1 << 14


def allot(shares: Sequence[float], floors: Sequence[int], caps: Sequence[int], total: int) -> list[int]:
    """Whole numbers near ``shares`` of ``total``, by largest remainder.

    No number exceeds its cap or, as far as the cap allows, is below its floor;
    what a floor or cap adds or takes is shared out among the others in
    proportion. Ties of remainders go to the earlier category. If the floors
    alone exceed ``total``, the floors win; if all caps are met, the rest is
    left out.
    """
    low = [min(f, c) for f, c in zip(floors, caps, strict=True)]
    fixed: dict[int, int] = {}
    while True:
        free = [i for i in range(len(shares)) if i not in fixed]
        left = total - sum(fixed.values())
        weight = sum(shares[i] for i in free)
        if not free or left <= 0 or weight <= 0:
            return [fixed.get(i, low[i]) for i in range(len(shares))]
        exact = {i: shares[i] / weight * left for i in free}
        given = {i: math.floor(exact[i]) for i in free}
        for i in sorted(free, key=lambda i: (given[i] - exact[i], i))[: left - sum(given.values())]:
            given[i] += 1
        under = sum(low[i] - given[i] for i in free if given[i] < low[i])
        over = sum(given[i] - caps[i] for i in free if given[i] > caps[i])
        if not under and not over:
            return [fixed.get(i, given.get(i, 0)) for i in range(len(shares))]
        # The side that moves more rows is settled first; the other may then no longer bind.
        if under >= over:
            fixed |= {i: low[i] for i in free if given[i] < low[i]}
        else:
            fixed |= {i: caps[i] for i in free if given[i] > caps[i]}


def records(df: DataFrame, keys: Sequence[str], id_column: str = "example_id") -> DataFrame:
    """Distinct records whose category is known: repeated rows of an id count
    once, ids that are null or whose category has a null don't count. An id that
    stands there with several categories is available in each."""
    known = [F.col(k).isNotNull() for k in [id_column, *keys]]
    ok = known[0]
    for k in known[1:]:
        ok = ok & k
    return df.where(ok).select(id_column, *keys).distinct()


def quotas(available: DataFrame, targets: DataFrame, keys: Sequence[str] = ("source_config", "label")) -> DataFrame:
    """The report: one row per row of ``targets`` with ``available``, ``needed``
    (the larger of ``min_rows`` and the share of the wanted size, not rounded),
    ``quota``, ``quota_share``, ``short`` (needed less quota, where positive)
    and ``reason``: ``available`` if there are fewer records than needed,
    ``rounding`` if less than one record is lacking, else ``others``: the floors
    of other categories took what is lacking. Null if the target is met.

    ``targets`` has ``plan``, the keys, ``target_share``, ``min_rows`` and
    ``sample_fraction``; rows with a null in any of them are left out, and a
    category named twice in a plan is an error. Targets, and hence the counts
    joined to them, are one row per category: small enough for the driver.
    """
    spark = available.sparkSession
    counts = available.groupBy(*keys).agg(F.count(F.lit(1)).alias("available"))
    total = counts.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("n"))
    wanted = targets.select("plan", *keys, "target_share", "min_rows", "sample_fraction").dropna()
    rows = wanted.join(counts, list(keys), "left").crossJoin(total).collect()
    plans: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["plan"], *(r[k] for k in keys))):
        plans.setdefault(r["plan"], []).append(r)
    out = []
    for plan, cats in plans.items():
        if len({tuple(r[k] for k in keys) for r in cats}) < len(cats):
            raise ValueError(f"plan {plan!r} names a category twice")
        size = math.floor(cats[0]["sample_fraction"] * cats[0]["n"] + 0.5)
        have = [r["available"] or 0 for r in cats]
        got = allot([r["target_share"] for r in cats], [r["min_rows"] for r in cats], have, size)
        for r, a, q in zip(cats, have, got, strict=True):
            need = max(float(r["min_rows"]), r["target_share"] * r["sample_fraction"] * r["n"])
            out.append((plan, *(r[k] for k in keys), r["target_share"], r["min_rows"], a, need, q, q / sum(got) if sum(got) else None, max(0.0, need - q), _reason(need, a, q)))
    kinds = [targets.schema[k] for k in keys]
    schema = T.StructType([
        T.StructField("plan", T.StringType()), *kinds, T.StructField("target_share", T.DoubleType()), T.StructField("min_rows", T.IntegerType()),
        T.StructField("available", T.LongType()), T.StructField("needed", T.DoubleType()), T.StructField("quota", T.LongType()),
        T.StructField("quota_share", T.DoubleType()), T.StructField("short", T.DoubleType()), T.StructField("reason", T.StringType()),
    ])
    return spark.createDataFrame(out, schema)


def _reason(need: float, available: int, quota: int) -> str | None:
    return None if quota >= need else "available" if available < need else "rounding" if need - quota < 1 else "others"


def draw(available: DataFrame, report: DataFrame, keys: Sequence[str] = ("source_config", "label"), id_column: str = "example_id", seed: int = 42) -> DataFrame:
    """The sample: for each plan and category the ``quota`` records with the
    smallest keys, a hash of seed, plan and id (ties by id).

    Counts of key buckets tell up to which bucket all rows belong to the
    sample; only the bucket that holds the last rows is sorted. So a category
    with a third of all rows is spread over all tasks.
    """
    plan = report.where("quota > 0").select("plan", *keys, "quota")
    key = F.xxhash64(F.lit(seed), "plan", id_column)
    keyed = available.join(plan, list(keys)).select("plan", *keys, id_column, "quota", key.alias("k")).withColumn("b", F.shiftrightunsigned("k", 64 - 14).cast("int"))
    cat = ["plan", *keys]
    sizes = keyed.groupBy(*cat, "quota", "b").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy(*cat).orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = sizes.withColumn("upto", F.sum("n").over(upto)).where("upto >= quota and upto - n < quota").select(*cat, F.col("b").alias("last"), F.expr("quota - (upto - n)").alias("still"))
    marked = keyed.join(last, cat)
    below = marked.where("b < last").select(*cat, id_column)
    edge = marked.where("b = last").withColumn("r", F.row_number().over(W.partitionBy(*cat).orderBy("k", id_column))).where("r <= still").select(*cat, id_column)
    return below.unionByName(edge)


def target_sample(df: DataFrame, targets: DataFrame, keys: Sequence[str] = ("source_config", "label"), id_column: str = "example_id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(sample, report) of :func:`draw` and :func:`quotas`; the records are
    found once and kept in the shared folder."""
    found = cut(records(df, keys, id_column))
    report = quotas(found, targets, keys)
    return draw(found, report, keys, id_column, seed), report
