"""Two-sided banding of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HIGH, LOW = 0.90, 0.05
# Histogram edges, closed on the left, the last bin on both sides.
EDGES = (0.0, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(score: Column | str, places: int = 6) -> Column:
    """Half-even, in double, so that a stored float lands on its decimal."""
    return F.bround(_c(score).cast("double"), places)


def band(score: Column | str, high: float = HIGH, low: float = LOW) -> Column:
    """1 from ``high`` up, 0 up to ``low``, null between; bounds belong to the bands."""
    s = _c(score)
    s = F.when(~F.isnan(s), s)
    return F.when(s >= high, F.lit(1)).when(s <= low, F.lit(0)).cast("tinyint")


def near_bound(score: Column | str, high: float = HIGH, low: float = LOW, within: float = 1e-6) -> Column:
    s = _c(score)
    return (F.abs(s - high) <= within) | (F.abs(s - low) <= within)


def histogram(df: DataFrame, score: str, by: list[str] | None = None, edges: tuple[float, ...] = EDGES) -> DataFrame:
    """Counts per bin (empty bins too) and their percentage, overall or per group."""
    by = by or []
    s, last = F.col(score), len(edges) - 2
    number = F.lit(None).cast("int")
    for i in range(last + 1):
        inside = (s >= edges[i]) & ((s <= edges[i + 1]) if i == last else (s < edges[i + 1]))
        number = F.coalesce(number, F.when(inside, F.lit(i)))
    counts = df.select(*by, number.alias("bin")).where("bin is not null").groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(last + 1)], "bin int, lower double, upper double")
    frame = counts.select(*by).distinct().crossJoin(bins) if by else bins
    total = F.sum("n").over(W.partitionBy(*by))
    c = counts.select(*(F.col(b).alias(f"c_{b}") for b in by), F.col("bin").alias("c_bin"), "n")
    on = F.col("bin") == F.col("c_bin")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"c_{b}"))
    out = frame.join(c, on, "left").select(*by, "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n"))
    return out.withColumn("pct", F.coalesce(F.try_divide(F.col("n") * 100.0, total), F.lit(0.0)))
