from fractions import Fraction
from itertools import combinations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from patraloom.llm import flow
from patraloom.llm.mixing import actual, memberships, mix, plan_mix, route

T = "plan string, source string, target_share double, max_repeats int, size_ratio double"


def test_route_takes_unshared_texts_first():
    a, b, ab = ("a",), ("b",), ("a", "b")
    own = {(a, "a"): 60, (ab, "a"): 100, (ab, "b"): 100, (b, "b"): 20}
    flow = route(own, {a: 60, b: 20, ab: 100}, {"a": Fraction(100), "b": Fraction(70)}, {"a": 1, "b": 1})
    # 170 of 180 distinct tokens: no text is used twice.
    assert flow[ab, "a"] + flow[ab, "b"] <= 100 and flow[a, "a"] + flow[ab, "a"] == 100 and flow[b, "b"] + flow[ab, "b"] == 70
    # More than there are distinct ones: the sources' copies serve both.
    flow = route(own, {a: 60, b: 20, ab: 100}, {"a": Fraction(150), "b": Fraction(120)}, {"a": 1, "b": 1})
    assert sum(flow.values()) == 270 and flow[ab, "a"] + flow[ab, "b"] > 100
    # A source that has something else gives way to one that hasn't.
    flow = route({(a, "a"): 100, (ab, "a"): 100, (ab, "b"): 100}, {a: 100, ab: 100}, {"a": Fraction(100), "b": Fraction(100)}, {"a": 2, "b": 2})
    assert flow[a, "a"] == 100 and flow[ab, "b"] == 100 and flow[ab, "a"] == 0


@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "ab", "bc", "abc"]), st.integers(1, 50)), min_size=1, max_size=6), st.tuples(*[st.integers(0, 200)] * 3), st.integers(1, 3))
def test_route_reaches_what_can_be_reached(cells, wanted, repeats):
    distinct, own = {}, {}
    for p, t in cells:
        distinct[tuple(p)] = t
        for s in p:
            own[tuple(p), s] = t
    quotas = {s: Fraction(w) for s, w in zip("abc", wanted)}
    flow = route(own, distinct, quotas, dict.fromkeys("abc", repeats))
    for s in "abc":
        have = repeats * sum(t for (_, x), t in own.items() if x == s)
        assert sum(x for (_, y), x in flow.items() if y == s) == min(quotas[s], have)
    assert all(0 <= x <= repeats * own[e] for e, x in flow.items())


def test_route_caps():
    flow = route({(("a",), "a"): 10}, {("a",): 10}, {"a": Fraction(100)}, {"a": 3})
    assert flow[("a",), "a"] == 30
    assert route({}, {}, {"a": Fraction(5)}, {"a": 2}) == {}


def docs(spark):
    """Forty texts of other stand in big as well."""
    rows = [(i, "big", ["big"], 1, 10 + i % 7) for i in range(400)] + [(1000 + i, "small", ["small"], 1, 20) for i in range(5)]
    rows += [(2000 + i, s, ["other", "big", "other"], 2, 11) for i in range(80) for s in [("big", "other")[i % 2]]]
    rows += [(3000, None, [], 1, 50), (3001, None, None, 1, 7), (3002, "big", ["big"], 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, source string, sources array<string>, copies long, n_tokens long")


def test_memberships(spark):
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "a", "x"), (4, "a", "y"), (5, None, "x"), (6, "a", None), (7, "b", None), (8, "b", "")]
    got = {r.doc_id: (r.sources, r.copies) for r in memberships(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got[1] == got[2] == got[3] == (["a", "b"], 3) and got[4] == (["a"], 1) and got[5] == ([], 1) and got[6] == (["a"], 1) and got[7] == (["b"], 1) and got[8] == (["b"], 1)


def test_mix(spark):
    d = docs(spark)
    t = spark.createDataFrame([("p", "big", 0.6, 2, 0.3), ("p", "small", 0.3, 4, 0.3), ("p", "other", 0.1, 1, 0.3), ("p", "none", 0.1, 1, 0.3), ("p", None, 0.1, 1, 0.3)], T)
    chosen, report = mix(d, t)
    r = {x.source: x for x in actual(report, chosen, d).collect()}
    assert r["none"].short and r["small"].short and not r["big"].short and r["small"].tokens == 400
    for s in ("big", "other", "small"):
        assert abs(r[s].actual_tokens - r[s].tokens) <= 20
    rows = chosen.collect()
    assert all(x.times == 4 for x in rows if x.source == "small") and max(x.times for x in rows if x.source == "big") == 1
    # What other needs of the shared texts, big leaves alone, as it has enough besides.
    assert not [x for x in rows if x.source == "big" and x.doc_id >= 2000]
    owner = {x.doc_id: x.source for x in d.collect()}
    assert all(owner[x.doc_id] == x.source for x in rows) and len({x.doc_id for x in rows}) == len(rows)
    assert {tuple(x) for x in rows} == {tuple(x) for x in mix(d.repartition(6), t)[0].collect()}
    # With no room for shared patterns every document is its source's alone, and the same sources fall short.
    assert {x.source: x.short for x in mix(d, t, most=0)[1].collect()} == {s: x.short for s, x in r.items()}


def test_bad_and_empty(spark):
    d = docs(spark)
    with pytest.raises(ValueError):
        plan_mix(d, spark.createDataFrame([("p", "big", 0.5, 1, 0.1)] * 2, T))
    chosen, report = mix(d.limit(0), spark.createDataFrame([("p", "big", 0.5, 1, 0.1)], T))
    assert chosen.collect() == [] and [x.short for x in report.collect()] == [False]
    assert mix(d, spark.createDataFrame([], T))[1].collect() == []


def overlapping(spark):
    """Each text of 12 tokens stands in one to three of four sources: enough for all without a repetition."""
    rows = [(10 * i + j, s, list(p), len(p), 12) for i in range(240) for p in [("a", "b", "c", "d", "ab", "bc", "abc", "ad", "cd", "bcd")[i % 10]] for j, s in enumerate(p)]
    return spark.createDataFrame(rows, "doc_id long, source string, sources array<string>, copies long, n_tokens long")


def test_many_patterns_repeat_no_more_than_few(spark, monkeypatch):
    """Patterns that the driver doesn't route are still told apart."""
    d = overlapping(spark)
    total = 12 * d.count()
    t = spark.createDataFrame([("p", s, tokens / total, 2, 1.0) for s, tokens in (("a", 720), ("b", 840), ("c", 720), ("d", 600))] + [("q", "b", 0.4, 3, 1.0), ("q", "c", 0.1, 1, 1.0)], T)
    monkeypatch.setattr(flow, "TASK", 4)
    monkeypatch.setattr(flow, "BLOCK", 6)

    def used(intervals):
        found = {}
        for r in intervals.collect():
            found[r.plan, tuple(r.pattern)] = found.get((r.plan, tuple(r.pattern)), 0) + r.upto
        return {p: [sum(min(x, 288 * level) for (q, _), x in found.items() if q == p) for level in (1, 2, 3)] for p in "pq"}

    few, many = plan_mix(d, t), plan_mix(d, t, most=0)
    assert sorted(map(tuple, few[0].collect())) == sorted(map(tuple, many[0].collect()))
    assert used(few[1]) == used(many[1])
    # All 240 texts are needed once, so none is used twice.
    assert used(many[1])["p"] == [2880, 2880, 2880]


def test_pairs_in_parts(monkeypatch):
    own = {(p, s): 10 + 3 * i for i, p in enumerate([("a", "b"), ("b", "c"), ("a", "b", "c"), ("c",)]) for s in p}
    call = own, {p: 10 + 3 * i for i, p in enumerate([("a", "b"), ("b", "c"), ("a", "b", "c"), ("c",)])}, dict.fromkeys("abc", Fraction(25)), dict.fromkeys("abc", 2)
    whole = route(*call)
    monkeypatch.setattr(flow, "PAIRS", 1)
    assert route(*call) == whole


def test_route_with_thousands_of_patterns():
    """20 sources and 4 845 patterns of four: every text is needed once."""
    patterns = list(combinations([f"s{i:02}" for i in range(20)], 4))
    own = {(p, s): 20 for p in patterns for s in p}
    quotas = dict.fromkeys({s for p in patterns for s in p}, Fraction(len(patterns)))
    flow = route(own, dict.fromkeys(patterns, 20), quotas, dict.fromkeys(quotas, 3))
    assert sum(flow.values()) == 20 * len(patterns) and all(sum(flow[p, s] for s in p) == 20 for p in patterns)


def test_tokens_of_rare_patterns_are_not_rounded_by_source(spark):
    """A text of 12 tokens in five sources has 12, not five times the 2 of 2.4: one source can take all of them once."""
    d = spark.createDataFrame([(i, s, list("abcde"), 5, 12) for i, s in enumerate("abcde")] + [(9, "a", ["a"], 1, 12)], "doc_id long, source string, sources array<string>, copies long, n_tokens long")
    t = spark.createDataFrame([("p", s, 1 / 6, 1, 1.0) for s in "ab"], T)
    for most in (100, 0):
        got = {(r.source, len(r.pattern)): r.upto for r in plan_mix(d, t, most)[1].collect()}
        assert got == {("a", 1): 12, ("b", 5): 12}
