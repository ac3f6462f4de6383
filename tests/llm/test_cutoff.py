import math
import random

from patraloom.llm.cutoff import keep_fraction

S = "example_id string, source_config string, teacher_prob_hate float"


def brute(rows, targets):
    once = {i: (s, x) for i, s, x in rows if i is not None and s is not None and x is not None and not math.isnan(x)}
    out = set()
    for source, f in targets:
        xs = sorted((x for s, x in once.values() if s == source), reverse=True)
        k = min(len(xs), math.ceil(f * len(xs)))
        if k:
            out |= {(i, s) for i, (s, x) in once.items() if s == source and x >= xs[k - 1]}
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"{i}", rng.choice("aaab"), rng.choice([0.25, 0.5, rng.randrange(64) / 64, rng.randrange(4096) / 4096])) for i in range(3000)]
    rows += rows[:50] + [("n1", "a", None), ("n2", "a", float("nan")), ("n3", None, 0.5), (None, "a", 0.5), ("i1", "a", float("inf")), ("i2", "b", float("-inf"))]
    targets = [("a", 0.1), ("b", 0.7), ("zz", 0.5)]
    df, t = spark.createDataFrame(rows, S), spark.createDataFrame(targets, "source_config string, keep_fraction double")
    for finish in (0, 16, 4096):
        kept, report = keep_fraction(df.repartition(5), t, finish=finish)
        assert {tuple(r) for r in kept.collect()} == brute(rows, targets)
        r = {x.source: x for x in report.collect()}
        assert r["zz"].n == 0 and r["zz"].cutoff is None and r["zz"].kept == 0
        assert r["a"].kept >= r["a"].place


def test_bounds_ties_and_empty(spark):
    rows = [(str(i), s, 0.5) for i in range(20) for s in "x"] + [(f"y{i}", "y", i / 8) for i in range(8)]
    t = spark.createDataFrame([("x", 0.01), ("y", 1.5), ("y", None), ("z", 0.0)], "source_config string, keep_fraction double")
    kept, _ = keep_fraction(spark.createDataFrame(rows, S), t, finish=2)
    assert kept.count() == 28
    none = spark.createDataFrame([(s, 0.0) for s in "xy"], t.schema)
    assert keep_fraction(spark.createDataFrame(rows, S), none)[0].count() == 0
    assert keep_fraction(spark.createDataFrame([], S), t)[0].count() == 0
