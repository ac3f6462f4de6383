"""Accounting and audits: funnel, coverage, alignment, leaks, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.functions.ids import example_id


def latest_scores(shards: DataFrame, key: str = "example_id", score: str = "p_hate_raw", at: str = "written_at") -> DataFrame:
    """One score per id: the last written that isn't null (ties: the higher
    score). The aggregate is combined before the shuffle, so an id with a tenth
    of all rows is no burden."""
    rows = shards.where(F.col(key).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    return rows.groupBy(key).agg(F.max(F.struct(at, score)).alias("m")).select(key, F.col(f"m.{score}").alias(score))


def attach_scores(df: DataFrame, scores: DataFrame, key: str = "example_id") -> DataFrame:
    return df.join(scores, key)


def coverage(wanted: DataFrame, found: DataFrame, key: str = "example_id") -> DataFrame:
    """One row: distinct ids wanted, found, missing and unexpected, and ids found more than once."""
    w = wanted.where(F.col(key).isNotNull()).select(key).distinct().withColumn("w", F.lit(1))
    f = found.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    return w.join(f, key, "full").agg(
        F.count("w").alias("wanted"), F.count("times").alias("found"), F.count_if(F.expr("times is null")).alias("missing"), F.count_if(F.expr("w is null")).alias("unexpected"), F.count_if(F.expr("times > 1")).alias("repeated"),
    )


def with_metadata(predictions: DataFrame, metadata: DataFrame, columns: Sequence[str], key: str = "example_id") -> DataFrame:
    """Predictions with columns of their records, joined by key, never by place;
    a prediction without a record keeps nulls."""
    return predictions.join(metadata.select(key, *columns).dropDuplicates([key]), key, "left")


def still_to_do(wanted: DataFrame, done: DataFrame, key: str = "example_id") -> DataFrame:
    """Distinct ids without a finished row, to resume a run."""
    return wanted.where(F.col(key).isNotNull()).select(key).distinct().join(done.select(key), key, "left_anti")


def alignment(df: DataFrame, doc: str = "doc_id", eng: str = "eng_latn", ory: str = "ory_orya") -> DataFrame:
    """One row: rows, distinct and repeated ids, conversations whose sides differ in turns."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(doc).alias("unique_docs"), (F.count(doc) - F.count_distinct(doc)).alias("repeated_docs"), F.count_if(size(eng) != size(ory)).alias("turn_mismatches"),
    )


def turn_histogram(df: DataFrame, turns: str = "num_turns") -> DataFrame:
    """Rows per number of turns; -1 for null and NaN."""
    n = F.when(F.col(turns).isNull() | F.isnan(F.col(turns).cast("double")), F.lit(-1)).otherwise(F.col(turns).cast("int"))
    return df.groupBy(n.alias("turns")).agg(F.count(F.lit(1)).alias("n"))


def length_profile(df: DataFrame, length: str, over: Sequence[int], by: str | None = None) -> DataFrame:
    """Mean, percentiles (linear, truncated), maximum, and the share above each cut."""
    ps = (0.5, 0.75, 0.9, 0.95, 0.99, 0.999)
    p = F.percentile(length, F.array(*map(F.lit, ps)))
    out = df.groupBy(*([by] if by else [])).agg(F.avg(length).alias("mean"), p.alias("p"), F.max(length).alias("max"), *(F.avg((F.col(length) > c).cast("double")).alias(f"over_{c}") for c in over))
    names = ("p50", "p75", "p90", "p95", "p99", "p99_9")
    return out.withColumns({n: F.get("p", F.lit(i)).cast("int") for i, n in enumerate(names)}).drop("p")


def funnel(stages: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Per (name, rows in, rows out): counts, what was dropped, and whether the
    stage begins with what the stage before ended with."""
    out = None
    for i, (name, a, b) in enumerate(stages):
        one = a.agg(F.count(F.lit(1)).alias("rows_in")).crossJoin(b.agg(F.count(F.lit(1)).alias("rows_out"))).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows_in", "rows_out")
        out = one if out is None else out.unionByName(one)
    before = F.lag("rows_out").over(W.orderBy("step"))  # one row per stage
    return out.withColumn("dropped", F.col("rows_in") - F.col("rows_out")).withColumn("chained", before.isNull() | (before == F.col("rows_in")))


def balanced_account(rows_in: int, rows_out: int, dropped: dict[str, int]) -> bool:
    """Whether every row is accounted for by exactly one reason."""
    return rows_out + sum(dropped.values()) == rows_in


def straddling(df: DataFrame, group: str, split: str) -> DataFrame:
    """Groups whose rows are in more than one split, with the splits."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_set(split)).alias("splits")).where(F.size("splits") > 1)


def split_overlap(df: DataFrame, value: str, split: str) -> DataFrame:
    """Distinct values shared by each pair of splits."""
    v = df.where(F.col(value).isNotNull() & F.col(split).isNotNull()).select(F.xxhash64(value).alias("h"), split).distinct()
    a, b = v.toDF("h", "split_a"), v.toDF("h", "split_b")
    return a.join(b, "h").where("split_a < split_b").groupBy("split_a", "split_b").agg(F.count(F.lit(1)).alias("shared"))


def three_way(df: DataFrame, split: str, label: str, source: str) -> DataFrame:
    """Counts per split, label and source, with the subtotals by split and label, and by split."""
    t = df.rollup(split, label, source).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"))
    return t.where("level < 7")


def split_shares(df: DataFrame, split: str, label: str, source: str, names: Sequence[str]) -> DataFrame:
    """Per label and source: the share of rows in each split."""
    n = F.count(F.lit(1))
    return df.groupBy(label, source).agg(n.alias("n"), *((F.count_if(F.col(split) == s) / n).alias(s) for s in names))


def difference(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of either side that the other lacks, with the ``side`` that has them."""
    x, y = a.select(*columns), b.select(*columns)
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns (``name``) with their deviation, and whether they never vary."""
    wide = df.agg(*(F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(c) for c in columns))
    return wide.unpivot([], list(columns), "name", "deviation").withColumn("constant", F.col("deviation") == 0)


def id_collisions(df: DataFrame, source: str, doc: str) -> DataFrame:
    """One row: ids (of source and document) made, distinct ones, and those that
    different documents share. Rows with a null in either make none."""
    made = df.select(F.col(source).alias("s"), F.col(doc).cast("string").alias("d")).where("s is not null and d is not null").distinct()
    per = made.groupBy(example_id("s", "d").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("documents"), F.count(F.lit(1)).alias("ids"), F.count_if(F.col("n") > 1).alias("collisions"))


def shard_gaps(shards: DataFrame, expected: DataFrame, shard: str = "shard") -> DataFrame:
    """Shards whose number of rows isn't the one ``expected`` (``shard``,
    ``rows``) gives, with both; a shard missing or not expected has 0 there.
    A table is whole if none comes out."""
    have = shards.groupBy(shard).agg(F.count(F.lit(1)).alias("found"))
    both = have.join(expected.select(shard, F.col("rows").alias("wanted")), shard, "full")
    return both.select(shard, F.coalesce("wanted", F.lit(0)).alias("wanted"), F.coalesce("found", F.lit(0)).alias("found")).where("wanted <> found")


class Leak(ValueError):
    """Something that a model must not see is within its reach."""


def forbid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df``, if it has none of the columns (in any case of letters), else an error."""
    there = {c.lower() for c in df.columns} & {c.lower() for c in columns}
    if there:
        raise Leak(f"columns that a model must not see: {sorted(there)}")
    return df


def check_splits(df: DataFrame, value: str, split: str) -> None:
    """Raises if two splits share a value."""
    found = split_overlap(df, value, split).collect()  # one row per pair of splits
    if found:
        raise Leak("; ".join(f"{r.split_a} and {r.split_b} share {r.shared}" for r in found))


class SchemaMismatch(ValueError):
    """A frame lacks a column or has one of another type."""


def require(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` with the expected columns in their order; raises if one is missing
    or of another type. Further columns are dropped."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: {have.get(f.name, 'missing')} instead of {f.dataType}" for f in expected if have.get(f.name) != f.dataType]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(*(f.name for f in expected))


def drift(found: int, expected: int | None, tolerance: float = 0.0) -> str | None:
    """A warning if a count is off; none if nothing is expected."""
    if expected is None or abs(found - expected) <= tolerance * expected:
        return None
    return f"{found} rows instead of {expected}"
