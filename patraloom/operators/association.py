"""How much a source tells about a label: contingency, mutual information, Cramér's V."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def contingency(df: DataFrame, x: str, y: str) -> DataFrame:
    """``x``, ``y``, ``n`` with a row for every combination of values that occur
    (0 if together they don't). Rows with a null in either are left out."""
    counts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    grid = counts.select(x).distinct().crossJoin(counts.select(y).distinct())
    return grid.join(counts, [x, y], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def mutual_information(table: DataFrame, x: str, y: str) -> DataFrame:
    """One row: ``mi``, ``hx``, ``hy`` (nats), ``nmi_arithmetic``, ``nmi_min``,
    ``nmi_max``, ``cramers_v``, of a :func:`contingency` table. Zeros where undefined."""
    every = W.partitionBy()
    t = table.select(
        F.col("n").cast("double").alias("n"), F.sum("n").over(W.partitionBy(x)).alias("nx"), F.sum("n").over(W.partitionBy(y)).alias("ny"),
        F.sum("n").over(every).alias("total"), F.size(F.collect_set(x).over(every)).alias("r"), F.size(F.collect_set(y).over(every)).alias("c"), F.col(x).alias("x"), F.col(y).alias("y"),
    ).where("total > 0")
    p, px, py = F.col("n") / F.col("total"), F.col("nx") / F.col("total"), F.col("ny") / F.col("total")
    expected = F.col("nx") * F.col("ny") / F.col("total")
    terms = t.select(
        "total", "r", "c",
        F.when(F.col("n") > 0, p * F.ln(p / (px * py))).otherwise(0.0).alias("mi"),
        # Each marginal is counted once: in the row's share of it.
        F.when(F.col("n") > 0, -p * F.ln(px)).otherwise(0.0).alias("hx"),
        F.when(F.col("n") > 0, -p * F.ln(py)).otherwise(0.0).alias("hy"),
        F.coalesce(F.try_divide(F.pow(F.col("n") - expected, 2), expected), F.lit(0.0)).alias("chi2"),
    )
    s = terms.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("mi", "hx", "hy", "chi2")), F.max("total").alias("total"), F.max("r").alias("r"), F.max("c").alias("c"))
    zero = lambda e: F.coalesce(e, F.lit(0.0))
    k = F.least("r", "c") - 1
    return s.select(
        "mi", "hx", "hy",
        zero(F.try_divide(2 * F.col("mi"), F.col("hx") + F.col("hy"))).alias("nmi_arithmetic"),
        zero(F.try_divide("mi", F.least("hx", "hy"))).alias("nmi_min"),
        zero(F.try_divide("mi", F.greatest("hx", "hy"))).alias("nmi_max"),
        zero(F.sqrt(F.try_divide(F.col("chi2"), F.col("total") * k))).alias("cramers_v"),
    )


def association(df: DataFrame, x: str, y: str) -> DataFrame:
    return mutual_information(contingency(df, x, y), x, y)


def label_shares(df: DataFrame, source: str, label: str, alarm_pct: float = 95.0) -> DataFrame:
    """Per label and source: ``n``, ``pct`` of the label, whether it is the
    label's largest source (``top``; ties: the first by name) and ``alarm``."""
    counts = df.where(F.col(source).isNotNull() & F.col(label).isNotNull()).groupBy(label, source).agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(W.partitionBy(label)))
    out = out.withColumn("top", F.row_number().over(W.partitionBy(label).orderBy(F.desc("n"), source)) == 1)
    return out.withColumn("alarm", F.col("pct") >= alarm_pct)


def ranked(df: DataFrame, value: str, name: str, *by: str) -> DataFrame:
    """Adds ``place``: from the largest value down within each group, ties by name."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(value), name)))


def yields(df: DataFrame, source: str, label: str) -> DataFrame:
    """Per source, and in total (source null, ``is_total``): rows, labelled 1, 0
    and discarded, with percentages."""
    y = F.col(label)
    t = df.rollup(source).agg(
        F.grouping(source).cast("boolean").alias("is_total"), F.count(F.lit(1)).alias("total"), F.count_if(y == 1).alias("hate"), F.count_if(y == 0).alias("non_hate"), F.count_if(y.isNull()).alias("discarded"),
    )
    return t.select("*", *((F.try_divide(F.col(c) * 100.0, F.col("total"))).alias(f"{c}_pct") for c in ("hate", "non_hate", "discarded")))


def verdict(n):
    """What a yield of ``n`` rows allows."""
    return F.when(n >= 10_000, "FINE").when(n >= 2_000, "WORKABLE").otherwise("STOP")
