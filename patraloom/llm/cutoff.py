"""Problem 4: a score cutoff per source that keeps a target fraction.

Distributed quickselect: each partition gives the median of its active scores
per source, their weighted median is the source's pivot, counts around the
pivot discard one side, and the rounds repeat until the wanted place is found.
A round is one pass: it counts around the pivots and takes the medians on both
sides of them, of which the next round needs one. The driver holds one bound,
pivot and count per target, never scores; they travel to the tasks with the
code, so that scores are never joined or shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patraloom.session import cut, forget

#: A source with at most this many scores left is finished by sorting those.
FINISH = 4096
#: Targets that are broadcast at most; with more Spark chooses the join.
FEW = 100_000


@dataclass
class _State:
    """Where a source's cutoff may lie: between two bounds (exclusive), at a
    place from the top among the scores left there. No pivot yet: none is counted."""

    still: int
    left: int
    lo: float | None = None
    hi: float | None = None
    pivot: float | None = None


def _few(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= FEW else table


def _active(batch: pa.RecordBatch, states: dict[int, _State]) -> Iterator[tuple[int, np.ndarray]]:
    """The scores of each source of a batch that lie between its bounds."""
    code, score = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("code", "score"))
    order = np.argsort(code, kind="stable")
    code, score = code[order], score[order]
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else []
    for i, part in zip(starts, np.split(score, starts[1:]) if len(code) else [], strict=True):
        s = states.get(int(code[i]))
        if s is not None:
            if s.lo is not None:
                part = part[part > s.lo]
            if s.hi is not None:
                part = part[part < s.hi]
            if len(part):
                yield int(code[i]), part


def _median(x: np.ndarray) -> float | None:
    return float(np.partition(x, (len(x) - 1) // 2)[(len(x) - 1) // 2]) if len(x) else None


def _round(states: dict[int, _State]):
    """Per partition and source: counts around the pivot, and the lower medians of both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for code, part in _active(batch, states):
                held.setdefault(code, []).append(part)
        rows = []
        for code, parts in held.items():
            x, pivot = np.concatenate(parts), states[code].pivot
            above, below = (x, x[:0]) if pivot is None else (x[x > pivot], x[x < pivot])
            rows.append((code, len(above), len(x) - len(above) - len(below), len(below), _median(above), _median(below)))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["code", "above", "same", "below", "up", "down"])

    return run


def _left(states: dict[int, _State]):
    """The active scores alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for code, part in _active(batch, states):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), code, np.int32)), pa.array(part)], ["code", "score"])

    return run


def _weighted(median: str, weight: str) -> str:
    """SQL: the lowest median up to which lies half of the weight. There is one
    entry per partition, however many scores there are."""
    ordered = f"array_sort(collect_list(if({weight} > 0, struct({median} as m, {weight} as w), null)))"
    return (
        f"aggregate({ordered}, named_struct('upto', 0L, 'm', cast(null as double)), "
        f"(a, x) -> named_struct('upto', a.upto + x.w, 'm', if(a.m is null and (a.upto + x.w) * 2 >= sum({weight}), x.m, a.m)), a -> a.m)"
    )


def scored(df: DataFrame, targets: list[str], id_column: str, source: str, score: str) -> DataFrame:
    """Distinct records with a source that has a target, and a score that is
    neither null nor NaN: ``id``, ``code`` (the source's place in ``targets``),
    ``score`` (double). An id that stands there with different sources or scores
    counts once with each."""
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source}`").alias("source"), F.col(f"`{score}`").cast("double").alias("score"))
    rows = rows.where("id is not null and source is not null and score is not null and not isnan(score)")
    codes = df.sparkSession.createDataFrame(list(enumerate(targets)), "code int, source string")
    return rows.join(_few(codes, len(targets)), "source").select("id", "code", "score").distinct()


def cutoffs(values: DataFrame, fractions: list[tuple[str, float]], finish: int = FINISH) -> DataFrame:
    """``code``, ``source``, ``keep_fraction``, ``n``, ``place`` (ceil of
    fraction x n), ``cutoff``. A fraction of 0 or less keeps none (null cutoff),
    of 1 or more all. Sources without records have n 0."""
    spark = values.sparkSession
    n = {r[0]: r[1] for r in values.groupBy("code").count().collect()}
    place = {c: min(n.get(c, 0), max(0, math.ceil(f * n.get(c, 0)))) for c, (_, f) in enumerate(fractions)}
    found: dict[int, float] = {}
    states = {c: _State(k, n[c]) for c, k in place.items() if k > 0}
    active, size = values.select("code", "score"), sum(s.left for s in states.values())
    while todo := {c: s for c, s in states.items() if c not in found and s.left > finish}:
        rows = active.mapInArrow(_round(todo), "code int, above long, same long, below long, up double, down double")
        sums = rows.groupBy("code").agg(*(F.sum(c).alias(c) for c in ("above", "same", "below")), F.expr(_weighted("up", "above")).alias("up"), F.expr(_weighted("down", "below")).alias("down"))
        for code, above, same, below, up, down in sums.collect():
            s = states[code]
            if s.pivot is None:
                s.pivot = up
            elif s.still <= above:
                s.lo, s.left, s.pivot = s.pivot, above, up
            elif s.still <= above + same:
                found[code] = s.pivot
            else:
                s.hi, s.left, s.still, s.pivot = s.pivot, below, s.still - above - same, down
        left = {c: s for c, s in states.items() if c not in found}
        if (now := sum(s.left for s in left.values())) * 2 <= size:
            before, active, size = active, cut(active.mapInArrow(_left(left), "code int, score double")), now
            forget(before)
    if left := {c: s for c, s in states.items() if c not in found}:
        ranked = active.mapInArrow(_left(left), "code int, score double").withColumn("r", F.row_number().over(W.partitionBy("code").orderBy(F.desc("score"))))
        wanted = spark.createDataFrame([(c, s.still) for c, s in left.items()], "code int, r int")
        found |= {r[0]: r[1] for r in ranked.join(_few(wanted, len(left)), ["code", "r"]).select("code", "score").collect()}
    rows = [(c, s, f, n.get(c, 0), place[c], found.get(c)) for c, (s, f) in enumerate(fractions)]
    return spark.createDataFrame(rows, "code int, source string, keep_fraction double, n long, place long, cutoff double")


def keep_fraction(
    df: DataFrame, targets: DataFrame, id_column: str = "example_id", source: str = "source_config", score: str = "teacher_prob_hate", finish: int = FINISH
) -> tuple[DataFrame, DataFrame]:
    """(kept records, report). Kept are all records with at least the cutoff's
    score, so ties at the cutoff are kept together; the report has one row per
    target with ``source``, ``keep_fraction``, ``n``, ``place``, ``cutoff``,
    ``kept``. Targets with a null are left out; of a source named twice, the
    larger fraction holds."""
    asked = targets.where("source_config is not null and keep_fraction is not null").groupBy("source_config").agg(F.max("keep_fraction")).collect()
    fractions = sorted((r[0], r[1]) for r in asked)
    values = cut(scored(df, [s for s, _ in fractions], id_column, source, score))
    found = cutoffs(values, fractions, finish)
    kept = values.join(_few(found.select("code", "source", "cutoff"), len(fractions)), "code").where("score >= cutoff")
    report = found.join(_few(kept.groupBy("code").agg(F.count(F.lit(1)).alias("kept")), len(fractions)), "code", "left").drop("code")
    return kept.select(F.col("id").alias(id_column), F.col("source").alias(source)), report.withColumn("kept", F.coalesce("kept", F.lit(0)))
