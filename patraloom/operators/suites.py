"""Labelled suites of examples that a scorer must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patraloom.functions.bands import HIGH, LOW


def rollup(df: DataFrame, group: str, gold: str, score: str, high: float = HIGH, low: float = LOW) -> DataFrame:
    """Per functionality: rows, hateful rows, mean score, rows per band, and
    recall or correct rejection at the bands, whichever applies."""
    s, g = F.col(score), F.col(gold) == 1
    n = F.count(F.lit(1))
    out = df.groupBy(group).agg(
        n.alias("n"), F.count_if(g).alias("hateful"), F.avg(s).alias("mean_score"), F.count_if(s >= high).alias("band_hate"), F.count_if(s <= low).alias("band_non_hate"),
        F.count_if((s > low) & (s < high)).alias("band_discard"), F.coalesce(F.bool_and(g), F.lit(False)).alias("gold_is_hateful"),
    )
    return out.withColumns({
        "recall_at_band": F.when(F.col("gold_is_hateful"), F.col("band_hate") / F.col("n")),
        "correct_reject_at_band": F.when(~F.col("gold_is_hateful"), F.col("band_non_hate") / F.col("n")),
    })


def overall(df: DataFrame, gold: str, score: str, high: float = HIGH, low: float = LOW) -> DataFrame:
    """One row: recall of hateful rows, correct rejection and false alarms of the others."""
    s, g = F.col(score), F.col(gold) == 1
    share = lambda a, b: F.coalesce(F.try_divide(F.count_if(a).cast("double"), F.count_if(b).cast("double")), F.lit(0.0))
    return df.agg(share(g & (s >= high), g).alias("recall"), share(~g & (s <= low), ~g).alias("correct_reject"), share(~g & (s >= high), ~g).alias("false_hate"))


def orientation(df: DataFrame, tier: str, score: str, hate: str = "clear_hate", benign: str = "clear_benign", margin: float = 0.5) -> DataFrame:
    """One row: whether a scorer's high end means hate: the mean margin is above
    ``margin`` and the lowest hateful score above the highest benign one."""
    of = lambda t: F.when(F.col(tier) == t, F.col(score))
    s = df.agg(F.avg(of(hate)).alias("mean_hate"), F.avg(of(benign)).alias("mean_benign"), F.min(of(hate)).alias("min_hate"), F.max(of(benign)).alias("max_benign"))
    return s.withColumn("oriented", F.coalesce((F.col("mean_hate") - F.col("mean_benign") > margin) & (F.col("min_hate") > F.col("max_benign")), F.lit(False)))


def pinned(df: DataFrame, tier: str, score: str, known: str, bounds: dict[str, tuple[str, float]]) -> DataFrame:
    """Per tier: its lowest and highest score without documented failures, and
    whether it keeps its bound (``min`` or ``max``); null without a bound."""
    counted = df.where(~F.coalesce(F.col(known), F.lit(False)))
    out = counted.groupBy(tier).agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("lowest"), F.max(score).alias("highest"))
    ok: Column = F.lit(None).cast("boolean")
    for name, (side, bound) in bounds.items():
        ok = F.when(F.col(tier) == name, (F.col("lowest") >= bound) if side == "min" else (F.col("highest") <= bound)).otherwise(ok)
    return out.withColumn("passed", ok)


def probe(df: DataFrame, score: str, marks: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """One row: mean, maximum, and rows from each mark up, with a reading."""
    out = df.agg(F.avg(score).alias("mean"), F.max(score).alias("max"), F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(score) >= m).alias(f"from_{int(m * 100)}") for m in marks))
    return out.withColumn("reading", F.when(F.col("mean") >= 0.5, "responds").when(F.col("max") >= 0.5, "responds to some").otherwise("does not respond"))


class SuiteFailed(RuntimeError):
    """A scorer that must not see the corpus."""


def tiers(df: DataFrame, tier: str, score: str, known: str, bounds: dict[str, tuple[str, float]]) -> DataFrame:
    """``step``, ``name``, ``passed``, ``reached``: the probe (reported alone),
    the orientation, and the pinned bounds, in the order in which they are to be
    passed. A step is reached if all before it passed; what isn't reached has no result."""
    steps = [
        df.sparkSession.range(1).select(F.lit(0).alias("step"), F.lit("probe").alias("name"), F.lit(True).alias("ok")),
        orientation(df, tier, score).select(F.lit(1), F.lit("orientation"), "oriented"),
        pinned(df, tier, score, known, bounds).agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("ok")).select(F.lit(2), F.lit("pinned"), "ok"),
    ]
    out = steps[0].union(steps[1]).union(steps[2])
    before = F.coalesce(F.bool_and("ok").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)), F.lit(True))  # three rows
    return out.withColumn("reached", before).select("step", "name", F.when(F.col("reached"), F.col("ok")).alias("passed"), "reached")


def require(df: DataFrame, tier: str, score: str, known: str, bounds: dict[str, tuple[str, float]]) -> None:
    """Raises at the first step of :func:`tiers` that fails, before a corpus is scored."""
    for r in tiers(df, tier, score, known, bounds).orderBy("step").collect():
        if not r.passed:
            raise SuiteFailed(f"the scorer failed at {r.name}")
