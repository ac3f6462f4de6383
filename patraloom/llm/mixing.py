"""Problem 7: mixing sources to target weights, in tokens.

Sources overlap where the same text stands in several of them. Documents are
aggregated by membership pattern (the set of sources that hold their text) and
source. A min-cost flow routes token capacity from patterns to source quotas:
each use of a text beyond its first, be it another source's copy of it or the
same document again, costs more (convex), so nothing is repeated while something
unused would do. Then documents are selected in seeded order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patraloom.llm import flow
from patraloom.session import cut, forget

#: Buckets of the seeded order; each is sorted on its own.
BUCKET_BITS = 14
#: Cells (a pattern of several sources and one of them) that the driver routes; more are routed over a table.
CELLS = 20_000
#: Copied texts that are broadcast at most; with more Spark chooses the join.
FEW = 100_000

Pattern = tuple[str, ...]


def reach(quota: Fraction, repeats: int, held: int) -> Fraction:
    """What a source reaches of its quota: as the last level bounds no pattern,
    all of it or all its documents as often as they may be used."""
    return max(Fraction(0), min(quota, Fraction(max(repeats, 0) * held)))


def route(own: Mapping[tuple[Pattern, str], int], distinct: Mapping[Pattern, float], quotas: Mapping[str, Fraction], repeats: Mapping[str, int]) -> dict[tuple[Pattern, str], int]:
    """Whole tokens of each pattern that go to each source.

    ``own`` has the tokens of a source's documents of a pattern, ``distinct``
    those of a pattern's texts, each once. A source takes its own documents, at
    most ``repeats`` times. A path's cost is that of the repetition it starts
    with, so augmenting all paths of one repetition before those of the next is
    a minimum-cost flow: at level L a document is used at most L times, and a
    pattern's texts, by all sources together, L times; the last level lifts that.
    """
    cells = sorted((p, s) for p, s in own if s in quotas)
    if not cells:
        return {}
    names = sorted(quotas)
    number = {s: i for i, s in enumerate(names)}
    patterns = sorted({p for p, _ in cells})
    sizes = Counter(p for p, _ in cells)
    ptr = np.cumsum([0, *(sizes[p] for p in patterns)])
    each = [np.array(x, np.int64) for x in ([number[s] for _, s in cells], [own[e] for e in cells], [round(distinct[p]) for p in patterns])]
    block = flow.Block(ptr, *each, np.zeros((1, len(cells)), np.int64))
    times = np.array([[repeats[s] for s in names]], np.int64)
    held = Counter({s: 0 for s in names})
    for p, s in cells:
        held[s] += own[p, s]
    lack = [[round(reach(quotas[s], repeats[s], held[s])) for s in names]]
    flow.solve(lack, times, lambda now, moves, then: flow.sums(block.step(now, moves, then, times)))
    return dict(zip(cells, block.flow[0].tolist()))


def memberships(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``sources``, the sources that hold a document's text (its own
    alone where the text or the source is null), and ``copies``, how many
    documents have it. Texts are told apart by 128 bits of hashes; only texts
    that stand there several times are joined back."""
    hashed = docs.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)})
    known = hashed.where(F.col(text).isNotNull() & F.col(source).isNotNull())
    several = cut(known.groupBy("h1", "h2").agg(F.array_sort(F.collect_set(source)).alias("sources"), F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    both = hashed.join(F.broadcast(several) if several.count() <= FEW else several, ["h1", "h2"], "left").drop("h1", "h2")
    alone = F.when(F.col(source).isNull(), F.array().cast("array<string>")).otherwise(F.array(source))
    counts = F.col("sources").isNotNull() & F.col(source).isNotNull() & F.col(text).isNotNull()
    return both.withColumns({"sources": F.when(counts, F.col("sources")).otherwise(alone), "copies": F.when(counts, F.col("copies")).otherwise(F.lit(1).cast("long"))})


def with_patterns(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pattern``, the sources that hold a document's text."""
    return docs.withColumn("pattern", F.array_sort(F.array_distinct("sources")))


def plan_mix(docs: DataFrame, targets: DataFrame, most: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """(report, intervals). ``docs`` has ``source``, ``sources`` (array of
    string: where its text stands), ``copies`` and ``n_tokens``; documents
    without a source count for the total size alone.

    The report has one row per row of ``targets``: ``plan``, ``source``,
    ``target_share``, ``target_tokens``, ``tokens`` (reached), ``share`` (of
    what the plan reached), ``repetitions`` and ``short``. The intervals say
    how many tokens of its own documents of each pattern a source takes. Targets
    with a null are left out; a source named twice in a plan is an error. The
    driver routes at most ``most`` cells (a pattern of several sources and one of
    them); with more the flow runs over a table of them, to the same end.
    """
    spark = docs.sparkSession
    sums = with_patterns(docs).groupBy("source", F.when(F.col("source").isNotNull(), F.col("pattern")).alias("pattern"))
    cells = cut(sums.agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") / F.col("copies")).alias("distinct")).fillna(0, ["tokens", "distinct"]))
    held = {r["source"]: r["t"] for r in cells.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    total = sum(held.values())
    plans: dict[str, list] = {}
    for r in targets.select("plan", "source", "target_share", "max_repeats", "size_ratio").dropna().orderBy("plan", "source").collect():
        plans.setdefault(r["plan"], []).append(r)
    report, quotas, repeats = [], {}, {}
    for plan, each in plans.items():
        if len({r["source"] for r in each}) < len(each):
            raise ValueError(f"plan {plan!r} names a source twice")
        quotas[plan] = {r["source"]: Fraction(r["target_share"] * r["size_ratio"] * total) for r in each}
        repeats[plan] = {r["source"]: r["max_repeats"] for r in each}
        reached = {s: reach(q, repeats[plan][s], held.get(s, 0)) for s, q in quotas[plan].items()}
        size = float(sum(reached.values()))
        for r in each:
            s = r["source"]
            report.append((plan, s, r["target_share"], float(quotas[plan][s]), float(reached[s]), float(reached[s]) / size if size else None, float(reached[s] / held[s]) if held.get(s) else None, bool(reached[s] < quotas[plan][s])))
    known = cells.where("source is not null")
    taken = _spread(known, quotas, repeats, held) if known.where(F.size("pattern") > 1).count() > most else _routed(known, quotas, repeats)
    forget(cells)
    return spark.createDataFrame(report, "plan string, source string, target_share double, target_tokens double, tokens double, share double, repetitions double, short boolean"), taken


def _routed(cells: DataFrame, quotas: Mapping[str, Mapping[str, Fraction]], repeats: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The intervals of few cells, found on the driver."""
    own: dict[tuple[Pattern, str], int] = {}
    distinct: dict[Pattern, float] = {}
    for r in cells.collect():
        p = tuple(r["pattern"])
        own[p, r["source"]] = r["tokens"]
        distinct[p] = distinct.get(p, 0) + r["distinct"]
    intervals = [(plan, s, list(p), own[p, s], x) for plan, q in quotas.items() for (p, s), x in route(own, distinct, q, repeats[plan]).items() if x > 0]
    return cells.sparkSession.createDataFrame(intervals, "plan string, source string, pattern array<string>, own_tokens long, upto long")


def _spread(cells: DataFrame, quotas: Mapping[str, Mapping[str, Fraction]], repeats: Mapping[str, Mapping[str, int]], held: Mapping[str, int]) -> DataFrame:
    """The intervals of any number of cells, found over a table."""
    names = sorted({s for q in quotas.values() for s in q})
    numbers = cells.sparkSession.createDataFrame(list(enumerate(names)), "number int, source string")
    cell = F.when(F.col("number").isNotNull() & (F.col("tokens") > 0), F.struct("number", "tokens"))
    grouped = cells.join(F.broadcast(numbers), "source", "left").groupBy("pattern").agg(F.rint(F.sum("distinct")).cast("long").alias("distinct"), F.array_sort(F.collect_list(cell)).alias("cells"))
    patterns = grouped.where(F.size("cells") > 0).select("pattern", "distinct", F.col("cells.number").alias("src"), F.col("cells.tokens").alias("own"))
    lack = [[round(reach(q[s], repeats[plan][s], held.get(s, 0))) if s in q else 0 for s in names] for plan, q in quotas.items()]
    times = np.array([[repeats[plan].get(s, 0) for s in names] for plan in quotas], np.int64).reshape(len(quotas), len(names))
    return flow.spread(patterns, list(quotas), names, lack, times)


def choose(docs: DataFrame, intervals: DataFrame, id_column: str = "doc_id", seed: int = 42) -> DataFrame:
    """``plan``, ``source``, the id and ``times`` (at least 1) of each document used.

    A source's documents of a pattern stand in the order of a seeded hash (ties
    by id) on a line of their tokens, repeated end to end; a document is used as
    often as what the source takes covers its first token. The line is built
    from sums of hash buckets, and only within a bucket are rows sorted.
    """
    line = with_patterns(docs).where("n_tokens > 0 and source is not null").select(id_column, "n_tokens", "source", "pattern", F.xxhash64(F.lit(seed), id_column).alias("k"))
    line = line.withColumn("bucket", F.shiftrightunsigned("k", 64 - BUCKET_BITS).cast("int"))
    cell = ["source", "pattern"]
    before = W.partitionBy(*cell).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = line.groupBy(*cell, "bucket").agg(F.sum("n_tokens").alias("t")).withColumn("off", F.coalesce(F.sum("t").over(before), F.lit(0))).drop("t")
    within = W.partitionBy(*cell, "bucket").orderBy("k", id_column).rowsBetween(W.unboundedPreceding, -1)
    placed = line.withColumn("c", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(offsets, [*cell, "bucket"])
    placed = placed.select(id_column, *cell, (F.col("c") + F.col("off")).alias("c"))
    times = F.expr("cast(floor((upto - 1 - c) / own_tokens) + 1 as int)")
    return placed.join(intervals, cell).select("plan", "source", id_column, times.alias("times")).where("times > 0")


def mix(docs: DataFrame, targets: DataFrame, id_column: str = "doc_id", seed: int = 42, most: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """(selection, report) of :func:`choose` and :func:`plan_mix`. ``docs`` is
    read several times, so it should have been written before."""
    report, intervals = plan_mix(docs, targets, most)
    return choose(docs, intervals, id_column, seed), report


def actual(report: DataFrame, chosen: DataFrame, docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The report with the tokens and shares of the documents selected."""
    sizes = chosen.join(docs.select(id_column, "n_tokens"), id_column).groupBy("plan", "source").agg(F.sum(F.col("times") * F.col("n_tokens")).alias("actual_tokens"))
    joined = report.join(sizes, ["plan", "source"], "left").withColumn("actual_tokens", F.coalesce("actual_tokens", F.lit(0)))
    return joined.withColumn("actual_share", F.try_divide("actual_tokens", F.sum("actual_tokens").over(W.partitionBy("plan"))))
