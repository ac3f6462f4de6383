"""The ordered gate chain: every row gets all its failed gates and one primary reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patraloom.functions import text as X

# Gate names in their order of precedence.
SHAPE, EMPTY, LENGTH, PURITY = "turn_shape_invalid", "empty_after_strip", "length_out_of_bounds", "low_ory_script_purity"


@dataclass(frozen=True)
class Bounds:
    turn: int = 0
    least: int = 3
    most: int = 2000
    purity: float = 0.60


def _size(turns: Column) -> Column:
    return F.coalesce(F.size(turns), F.lit(0))


def _text_gates(df: DataFrame, shape: Column, b: Bounds) -> DataFrame:
    """Adds the gate columns to a frame with ``text_eng``, ``text_ory`` in composed form."""
    sides = {"eng": F.col("text_eng"), "ory": F.col("text_ory")}
    blank = [X.collapse_whitespace(t) == "" for t in sides.values()]
    outside = {k: ~F.length(t).between(b.least, b.most) for k, t in sides.items()}
    purity = X.script_purity("text_ory")
    usable = ~shape
    failed = {
        SHAPE: shape,
        EMPTY: usable & (blank[0] | blank[1]),
        LENGTH: usable & (outside["eng"] | outside["ory"]),
        PURITY: usable & (purity < b.purity),
    }
    flags = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in failed.items())), lambda x: x.isNotNull())
    long_sides = F.filter(F.array(*(F.when(usable & F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in outside.items())), lambda x: x.isNotNull())
    return (
        df.withColumn("ory_script_purity", F.when(usable, purity))
        .withColumn("failed", flags)
        .withColumn("reason", F.get("failed", F.lit(0)))
        .withColumn("all_failed_gates", F.array_join("failed", "+"))
        .withColumn("length_sides", F.array_join(long_sides, "+"))
        .drop("failed")
    )


def gate_turns(df: DataFrame, eng: str = "eng_latn", ory: str = "ory_orya", bounds: Bounds = Bounds()) -> DataFrame:
    """Gates conversations. Adds ``text_eng``, ``text_ory`` (composed prompts of
    the turn), ``ory_script_purity``, ``reason`` (null if kept),
    ``all_failed_gates`` and ``length_sides``. A null list counts as no turns."""
    e, o = X.turn_prompt(eng, bounds.turn), X.turn_prompt(ory, bounds.turn)
    shape = (_size(F.col(eng)) != _size(F.col(ory))) | F.coalesce(e, F.lit("")).eqNullSafe("") | F.coalesce(o, F.lit("")).eqNullSafe("")
    framed = df.withColumn("bad_shape", shape).withColumn("text_eng", X.nfc(e)).withColumn("text_ory", X.nfc(o))
    return _text_gates(framed, F.col("bad_shape"), bounds).drop("bad_shape")


def gate_texts(df: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Gates rows that already hold ``text_eng`` and ``text_ory``; a null text has no usable shape."""
    framed = df.withColumn("text_eng", X.nfc("text_eng")).withColumn("text_ory", X.nfc("text_ory"))
    return _text_gates(framed, F.col("text_eng").isNull() | F.col("text_ory").isNull(), bounds)


def kept(gated: DataFrame) -> DataFrame:
    return gated.where("reason is null")


def rejected(gated: DataFrame) -> DataFrame:
    return gated.where("reason is not null")


def drop_counts(gated: DataFrame, *by: str) -> DataFrame:
    """Rows per primary reason (``kept`` for none), per group."""
    return gated.groupBy(*by, F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def co_failures(gated: DataFrame) -> DataFrame:
    """Rows per combination of failed gates."""
    return gated.where("all_failed_gates <> ''").groupBy("all_failed_gates").agg(F.count(F.lit(1)).alias("n"))


def length_side_counts(gated: DataFrame) -> DataFrame:
    return gated.where("length_sides <> ''").groupBy("length_sides").agg(F.count(F.lit(1)).alias("n"))


def breaches(gated: DataFrame, by: str, most_pct: float = 2.0) -> DataFrame:
    """Groups and gates whose share of dropped rows is above ``most_pct`` percent."""
    per = gated.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col("reason") == g).alias(g) for g in (SHAPE, EMPTY, LENGTH, PURITY)))
    long = per.unpivot([by, "rows"], [SHAPE, EMPTY, LENGTH, PURITY], "gate", "dropped")
    return long.withColumn("pct", F.col("dropped") * 100.0 / F.col("rows")).where(F.col("pct") > most_pct)


class TooManyDropped(RuntimeError):
    """A gate drops more of a group than is allowed."""


def check_drops(gated: DataFrame, by: str, most_pct: float = 2.0, allow: bool = False) -> None:
    """Raises before anything is written, unless ``allow``."""
    found = breaches(gated, by, most_pct).orderBy(F.desc("pct")).limit(20).collect()
    if found and not allow:
        raise TooManyDropped("; ".join(f"{r[by]}/{r['gate']}: {r['pct']:.2f} %" for r in found))
