from hypothesis import given
from hypothesis import strategies as st

from patraloom.llm.sampling import allot, quotas, records, target_sample

CATS = st.lists(st.tuples(st.floats(0, 1), st.integers(0, 20), st.integers(0, 100)), min_size=1, max_size=8)


@given(CATS, st.integers(0, 200))
def test_allot(cats, total):
    shares, floors, caps = map(list, zip(*cats, strict=True))
    got = allot(shares, floors, caps, total)
    low = [min(f, c) for f, c in zip(floors, caps, strict=True)]
    assert all(a <= g <= c for a, g, c in zip(low, got, caps, strict=True))
    if sum(low) <= total and all(s > 0 for s in shares):
        assert sum(got) == min(total, sum(caps))


def test_allot_plain():
    assert allot([0.5, 0.3, 0.2], [0, 0, 0], [100, 100, 100], 10) == [5, 3, 2]
    assert allot([0.98, 0.02], [3, 3], [100, 100], 10) == [7, 3]
    assert allot([0.5, 0.5], [0, 0], [2, 100], 10) == [2, 8]


ROWS = [(f"{i:04d}", "a" if i % 3 else "b", i % 2) for i in range(300)] + [("0001", "a", 1)] * 5 + [(None, "a", 1), ("x", None, 1), ("y", "a", None)]
TARGETS = [("p", "a", 0, 0.4, 1, 0.5), ("p", "a", 1, 0.4, 1, 0.5), ("p", "b", 0, 0.1, 60, 0.5), ("p", "c", 1, 0.1, 2, 0.5), ("p", None, 1, 0.1, 2, 0.5)]
T = "plan string, source_config string, label tinyint, target_share double, min_rows int, sample_fraction double"


def test_sample_and_report(spark):
    df = spark.createDataFrame(ROWS, "example_id string, source_config string, label tinyint")
    targets = spark.createDataFrame(TARGETS, T)
    sample, report = target_sample(df, targets)
    r = {(x.source_config, x.label): x for x in report.collect()}
    assert set(r) == {("a", 0), ("a", 1), ("b", 0), ("c", 1)}
    assert r["a", 1].available == 100 and r["c", 1].available == 0 and r["c", 1].short == 15.0 and r["b", 0].short == 10.0
    assert r["c", 1].reason == r["b", 0].reason == "available"
    assert all((x.short > 0) == (x.reason is not None) and x.short == max(0, x.needed - x.quota) for x in r.values())
    rows = sample.collect()
    assert len(rows) == sum(x.quota for x in r.values()) and len({x.example_id for x in rows}) == len(rows)
    again = target_sample(df.repartition(7), targets)[0]
    assert {x.example_id for x in rows} == {x.example_id for x in again.collect()}


def test_reasons_and_several_categories(spark):
    df = spark.createDataFrame([(f"{i}", "a", i % 2) for i in range(200)] + [("0", "b", 0)], "example_id string, source_config string, label tinyint")
    t = [("p", "a", 0, 0.49, 1, 0.1), ("p", "a", 1, 0.5, 30, 0.1), ("p", "b", 0, 0.01, 0, 0.1)]
    r = {(x.source_config, x.label): x for x in quotas(records(df, ["source_config", "label"]), spark.createDataFrame(t, T)).collect()}
    assert r["a", 0].reason == "others" and r["a", 0].quota < 9 and r["a", 1].reason is None and r["a", 1].quota == 30
    assert r["b", 0].available == 1 and r["a", 0].available == 100


def test_empty(spark):
    df = spark.createDataFrame([], "example_id string, source_config string, label tinyint, quota int")
    sample, report = target_sample(df, spark.createDataFrame(TARGETS[:2], T))
    assert sample.collect() == [] and {x.quota for x in report.collect()} == {0}
    assert quotas(records(df, ["source_config", "label"]), spark.createDataFrame([], T)).collect() == []
