"""Scoring texts with a pluggable model, in Arrow batches.

A scorer is a picklable callable without arguments that, once per Python
worker, returns a function from a list of texts to probabilities of label 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patraloom.functions.ids import unit_fraction

Scorer = Callable[[], Callable[[Sequence[str]], Sequence[float]]]


def score_with(scorer: Scorer, batch: int = 64) -> Callable[[Column], Column]:
    """An Arrow function of a text column. Texts of a batch are scored in order
    of length; a batch that doesn't fit in memory is halved, down to four."""

    @F.pandas_udf("float")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = scorer()

        def some(texts: list[str], size: int) -> list[float]:
            out: list[float] = []
            for i in range(0, len(texts), size):
                part = texts[i : i + size]
                try:
                    out += list(model(part))
                except MemoryError:
                    if size <= 4:
                        raise
                    out += some(part, max(4, size // 2))
            return out

        for part in parts:
            known = part.dropna()
            order = known.str.len().sort_values(kind="stable").index
            yield pd.Series(some(list(known.loc[order]), batch), order, "float32").reindex(part.index)

    return run


def token_lengths(tokeniser: Callable[[], Callable[[str], Sequence]]) -> Callable[[Column], Column]:
    """An Arrow function of a text column: how many tokens a text has, without
    truncation; null for a null text. ``tokeniser`` is called once per worker."""

    @F.pandas_udf("int")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = tokeniser()
        for part in parts:
            yield part.map(lambda t: None if t is None else len(tokens(t))).astype("Int32")

    return run


def environment(spark: SparkSession) -> dict[str, str]:
    """What a run depends on, for its manifest: versions and the settings that shape results or plans."""
    import platform

    import numpy
    import pyarrow

    held = {"python": platform.python_version(), "spark": spark.version, "pyarrow": pyarrow.__version__, "numpy": numpy.__version__, "pandas": pd.__version__}
    names = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled", "spark.sql.files.maxPartitionBytes")
    return held | {n: spark.conf.get(n) for n in names}


def hash_score(key: Column | str, salt: str = "score") -> Column:
    """A deterministic stand-in for a model, uniform in [0, 1)."""
    return F.bround(unit_fraction(key, salt), 6)


def decide(prob_0: Column, prob_1: Column) -> Column:
    """The more probable label; on a tie 0."""
    return F.when(prob_1 > prob_0, F.lit(1)).otherwise(F.lit(0))


def resume(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows without a score yet."""
    return df.join(done.select(key), key, "left_anti")
