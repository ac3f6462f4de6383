import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.operators import agreement, association, audit, dedup, gates, graph, metrics, native, sampling, scoring, suites

RAW = "doc_id string, eng_latn array<array<string>>, ory_orya array<array<string>>"
ODIA = "କଖଗଘଙଚ"


def gate(spark, eng, ory):
    return gates.gate_turns(spark.createDataFrame([("d", eng, ory)], RAW)).first()


@pytest.mark.parametrize(
    "eng, ory, reason",
    [
        ([["prompt", "RESP"]], [[ODIA, "RESP"]], None), (None, [[ODIA]], gates.SHAPE), ([["a b"]], [[]], gates.SHAPE), ([["abc"], ["d"]], [[ODIA]], gates.SHAPE),
        ([["   "]], [[ODIA]], gates.EMPTY), ([["ab"]], [[ODIA]], gates.LENGTH), ([["abc"]], [["କ" * 2000]], None), ([["abc"]], [["କ" * 2001]], gates.LENGTH),
        ([["abc"]], [["hello"]], gates.PURITY), ([["abc"]], [["କଖଗଘଙଚ abcd"]], None), ([["ab"]], [["x"]], gates.LENGTH),
    ],
)
def test_gates(spark, eng, ory, reason):
    r = gate(spark, eng, ory)
    assert r.reason == reason
    assert "RESP" not in str([r.text_eng, r.text_ory])


def test_gate_accounts(spark):
    rows = [("a", "abc", ODIA), ("a", "ab", "x"), ("b", None, ODIA), ("b", "abc", ODIA)]
    g = gates.gate_texts(spark.createDataFrame(rows, "source_config string, text_eng string, text_ory string"))
    assert {(r.source_config, r.reason): r.n for r in gates.drop_counts(g, "source_config").collect()} == {("a", "kept"): 1, ("a", gates.LENGTH): 1, ("b", gates.SHAPE): 1, ("b", "kept"): 1}
    assert gates.co_failures(g).count() == 2 and gates.length_side_counts(g).collect()[0].length_sides == "eng+ory"
    with pytest.raises(gates.TooManyDropped):
        gates.check_drops(g, "source_config")
    gates.check_drops(g, "source_config", 60)
    assert gates.kept(g).count() + gates.rejected(g).count() == 4


def table(spark, cells):
    rows = [(f"s{i}", j, n) for i, row in enumerate(cells) for j, n in enumerate(row)]
    return association.mutual_information(spark.createDataFrame(rows, "x string, y int, n long"), "x", "y").first()


def test_association(spark):
    r = table(spark, [[60436, 17351], [26683, 3593], [14813, 74]])
    assert round(r.nmi_arithmetic, 4) == 0.0417 and round(r.cramers_v, 4) == 0.2010 and r.nmi_min > r.nmi_arithmetic > r.nmi_max
    assert table(spark, [[0, 100], [0, 100], [100, 0]]).nmi_min == pytest.approx(1)
    flat = table(spark, [[50, 50], [100, 100], [25, 25]])
    assert flat.nmi_arithmetic == pytest.approx(0, abs=1e-12) and flat.cramers_v == pytest.approx(0, abs=1e-9)
    assert table(spark, [[0, 100], [100, 0]]).cramers_v == pytest.approx(1)
    assert set(table(spark, [[0, 0], [0, 0], [0, 0]])) == {0.0}


def cells(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")


def test_metrics(spark):
    r = metrics.metrics_of(cells(spark, 1717, 209, 181, 1673)).first()
    assert r.macro_f1 == pytest.approx(0.8968114153369231) and r.accuracy == pytest.approx(0.8968253968) and r.mcc == pytest.approx(0.7937212767)
    assert metrics.metrics_of(cells(spark, 906, 118, 6, 4)).first().macro_f1 == pytest.approx(0.4982782369)
    zero = metrics.metrics_of(cells(spark, 0, 0, 0, 0)).first()
    assert zero.macro_f1 == zero.mcc == zero.accuracy == 0
    g = metrics.gap(cells(spark, 1717, 209, 181, 1673), cells(spark, 906, 118, 6, 4)).first()
    assert round(g.expected_f1, 4) == 0.5404 and round(g.prevalence_gap, 4) == 0.3564 and round(g.behaviour_gap, 4) == 0.0421


def test_mood(spark):
    rows = [(q, w) for q, w, n in ((False, False, 1550), (False, True, 180), (True, False, 1840), (True, True, 210)) for _ in range(n)]
    r = metrics.mood_by_error(spark.createDataFrame(rows, "q boolean, w boolean"), "q", "w").first()
    assert round(r.chi2, 4) == 0.0117 and round(metrics.chi2_p(r.chi2), 4) == 0.9139 and r.applicable
    assert not metrics.mood_by_error(spark.createDataFrame([(True, True)], "q boolean, w boolean"), "q", "w").first().applicable


def test_kappa(spark):
    k = lambda rows: metrics.kappa(spark.createDataFrame(rows, "a int, b int"), "a", "b").first()
    assert k([(1, 1), (0, 0)] * 5).kappa == pytest.approx(1) and k([(1, 0), (0, 1)] * 5).kappa < 0
    half = k([(1, 1)] * 9 + [(0, 1)])
    assert half.po == pytest.approx(0.9) and half.kappa == pytest.approx(0)
    assert k([(1, 1)] * 4).kappa is None and k([(1, None)]).n is None


def test_resamples(spark):
    df = spark.createDataFrame([(1, 1)] * 40 + [(0, 0)] * 40 + [(1, 0)] * 10 + [(0, 1)] * 10, "g int, p int")
    b = metrics.resamples(df, "g", "p").cache()
    assert b.count() == b.where("tn + fp + fn + tp = 100").count() == 2000
    mean = b.agg(*(F.avg(c) for c in ("tn", "fp", "fn", "tp"))).first()
    assert all(abs(x - y) < 0.5 for x, y in zip(mean, (40, 10, 10, 40)))
    # Row by row: 2000 resamples of the hundred rows themselves.
    rng, truth = np.random.default_rng(1), np.repeat([0, 1, 2, 3], [40, 10, 10, 40])
    f1 = []
    for _ in range(2000):
        tn, fp, fn, tp = np.bincount(rng.choice(truth, 100), minlength=4)
        f1.append((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2)
    i, slots = metrics.interval(b).first(), np.quantile(f1, [0.025, 0.975])
    assert abs(i.low - slots[0]) < 0.02 and abs(i.high - slots[1]) < 0.02
    assert metrics.resamples(df.repartition(7), "g", "p").exceptAll(b).count() == 0
    assert metrics.resamples(df.limit(0), "g", "p").count() == 0


def test_floors(spark):
    df = spark.createDataFrame([(str(i), int(i < 300)) for i in range(1000)] + [("x", None)], "k string, g int")
    f = {r.floor: r.macro_f1 for r in metrics.floors(df, "k", "g").collect()}
    assert set(f) == {"always_1", "always_0", "majority", "random"}
    assert f["majority"] == f["always_0"] == pytest.approx(1400 / 1700 / 2) and f["always_1"] == pytest.approx(600 / 1300 / 2)
    assert abs(f["random"] - 0.48) < 0.02
    assert {r.macro_f1 for r in metrics.floors(df.limit(0), "k", "g").collect()} == {0.0}
    c = lambda *x: spark.range(1).select(metrics.covered(*map(F.lit, x)).alias("c")).first().c
    assert c(0.7, 0.5, 0.9) == pytest.approx(0.5) and c(0.7, 0.5, 0.5) is None


def test_gap_without_rows(spark):
    b = spark.createDataFrame([(5, 1, 1, 5)], "tn long, fp long, fn long, tp long")
    g = metrics.gap(b, b.select(*(F.lit(0).cast("long").alias(c) for c in b.columns))).first()
    assert g.benchmark_f1 and g.native_f1 is None and g.total_gap is None and g.behaviour_gap is None


def test_guards(spark):
    pairs = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), (None, "2")], "s string, d string")
    assert tuple(audit.id_collisions(pairs, "s", "d").first()) == (2, 2, 0)
    shards = spark.createDataFrame([(0,), (0,), (1,), (3,)], "shard int")
    gaps = audit.shard_gaps(shards, spark.createDataFrame([(0, 2), (1, 2), (2, 1)], "shard int, rows long"))
    assert {tuple(r) for r in gaps.collect()} == {(1, 2, 1), (2, 1, 0), (3, 0, 1)}
    with pytest.raises(audit.Leak):
        audit.forbid(pairs.withColumn("Text_Eng", F.lit("")), ["text_eng"])
    assert audit.forbid(pairs, ["text_eng"]) is pairs
    rows = spark.createDataFrame([("x", "train"), ("x", "test"), ("y", "test"), (None, "train")], "t string, part string")
    with pytest.raises(audit.Leak):
        audit.check_splits(rows, "t", "part")
    audit.check_splits(rows.where("t = 'y'"), "t", "part")


def test_tiers_stop(spark):
    rows = [("a", "clear_hate", 0.95, None), ("b", "clear_hate", 0.99, None), ("c", "clear_benign", 0.02, None), ("d", "hard_negative", 0.5, None), ("e", "hard_negative", 0.1, True)]
    df = spark.createDataFrame(rows, "id string, tier string, score double, known boolean")
    bounds = {"clear_hate": ("min", 0.9), "hard_negative": ("max", 0.2)}
    got = lambda d: [(r.name, r.passed, r.reached) for r in suites.tiers(d, "tier", "score", "known", bounds).orderBy("step").collect()]
    assert got(df) == [("probe", True, True), ("orientation", True, True), ("pinned", False, True)]
    assert got(df.withColumn("score", 1 - F.col("score")))[1:] == [("orientation", False, True), ("pinned", None, False)]
    with pytest.raises(suites.SuiteFailed):
        suites.require(df, "tier", "score", "known", bounds)
    suites.require(df.where("id <> 'd'"), "tier", "score", "known", {"clear_hate": ("min", 0.9)})


def test_metadata_and_environment(spark):
    p = spark.createDataFrame([("1", 0), ("2", 1)], "example_id string, pred int")
    m = spark.createDataFrame([("2", "s", "x"), ("2", "s", "x")], "example_id string, source string, more string")
    assert {tuple(r) for r in audit.with_metadata(p, m, ["source"]).collect()} == {("1", 0, None), ("2", 1, "s")}
    assert {"spark", "python", "spark.sql.shuffle.partitions"} <= set(scoring.environment(spark))
    n = spark.createDataFrame([("a b",), (None,), ("",)], "t string").select(scoring.token_lengths(lambda: str.split)(F.col("t")).alias("n"))
    assert sorted(r.n for r in n.dropna().collect()) == [0, 2] and n.where("n is null").count() == 1


def test_links_without_pairs(spark):
    """Clusters by linking pairs equal those by all pairs, also where a bucket holds very many."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [[word() for _ in range(30)] for _ in range(12)]
    rows = [(f"{i:04d}", " ".join(w if rng.random() > 0.02 * (i % 4) else word() for w in base[i % 12])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t string")
    groups, edges, roots = dedup.near_duplicates(df, "k", "t")
    for part in (2048, 5):
        some = dedup.linking_pairs(dedup.minhash(groups, "text_key", "norm"), "text_key", part=part)
        linked = dedup.clusters(groups, "text_key", some)
        assert {tuple(r) for r in roots.collect()} == {tuple(r) for r in linked.collect()}
        assert some.count() == edges.count() if part > 400 else some.count() < edges.count()
    sigs = dedup.minhash(groups, "text_key", "norm").collect()
    true = {(a.text_key, b.text_key) for a in sigs for b in sigs if a.text_key < b.text_key and sum(x == y for x, y in zip(a.sig, b.sig)) / 128 >= 0.85}
    assert {(r.a, r.b) for r in edges.collect()} == true
    swept = {r.threshold: (r.pairs, r.removed) for r in dedup.sweep(dedup.minhash(groups, "text_key", "norm"), "text_key").collect()}
    for t in dedup.SWEEP:
        some = dedup.candidate_pairs(dedup.minhash(groups, "text_key", "norm"), "text_key", t)
        gone = graph.components(some)
        assert swept[t] == (some.count(), gone.count() - gone.select("root").distinct().count())
    parts = dedup.candidate_pairs(dedup.minhash(groups, "text_key", "norm"), "text_key", part=5)
    assert {(r.a, r.b) for r in parts.collect()} == true


def test_label_columns_are_tried_in_order(spark):
    df = spark.createDataFrame([("x", 1, 0, 1)], "text string, hate int, class int, Final_Label int")
    assert native.label_column(df) == "class" and native.label_column(df.drop("class")) == "hate"
    assert native.label_column(df.drop("class", "hate")) == "Final_Label"


def test_quotas():
    assert sampling.largest_remainder({"a": 70.5, "b": 12.4, "c": 17.1}, 100) == {"a": 71, "b": 12, "c": 17}
    assert sampling.largest_remainder({"a": 1}, 0) == {"a": 0}
    major, minor = {"a": 59742, "b": 10477, "c": 14498}, {"a": 17082, "b": 1480, "c": 74}
    got = sampling.target_counts(major, minor, 18636, "proportional")
    assert abs(got["a"] - 13142) <= 2 and abs(got["c"] - 3189) <= 2 and sum(got.values()) == 18636
    assert sampling.target_counts(major, minor, 18636, "match_minority") == minor
    spill = sampling.target_counts({"a": 100, "b": 10, "c": 5}, {"a": 10, "b": 50, "c": 50}, 100, "match_minority")
    assert spill == {"a": 85, "b": 10, "c": 5}
    with pytest.raises(ValueError):
        sampling.target_counts(major, minor, 1, "x")


def test_sampling(spark):
    df = spark.range(900).select(F.format_string("%016x", "id").alias("example_id"), F.format_string("s%d", F.col("id") % 3).alias("source"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    a = sampling.stratified_sample(df, 100, "source", "example_id", 42)
    assert a.count() == 100 and a.exceptAll(sampling.stratified_sample(df.repartition(5), 100, "source", "example_id", 42)).count() == 0
    b = sampling.balance(df, "label", "source", "example_id", "match_minority")
    assert {r[0]: r[1] for r in b.groupBy("label").count().collect()} == {0: 180, 1: 180} and b.select("example_id").distinct().count() == 360
    quota = spark.createDataFrame([("s0", 7), ("s1", 10_000), ("s9", 3)], "source string, quota long")
    d = sampling.downsample(df, quota, "source", "example_id", 1)
    assert {r[0]: r[1] for r in d.groupBy("source").count().collect()} == {"s0": 7, "s1": 300}
    assert sampling.stratified_sample(df.limit(0), 10, "source", "example_id", 1).count() == 0


@pytest.mark.parametrize(
    "rows, key, cells",
    [
        ([("aaa", 0, "s"), ("bbb", 1, "s"), ("ccc", 1, "s"), ("ddd", 1, "s"), ("eee", 1, "s")], "bbb", 2), ([("ccc", 1, "s"), ("aaa", 1, "s"), ("bbb", 1, "s")], "aaa", 1),
        ([("aaa", 0, "s"), ("bbb", 1, "s")], "aaa", 2), ([("aaa", 1, "S2"), ("bbb", 1, "S1"), ("ccc", 1, "S1")], "bbb", 2),
    ],
)
def test_representatives(spark, rows, key, cells):
    df = spark.createDataFrame([("g", *r) for r in rows], "g string, example_id string, label int, source string")
    r = sampling.representatives(df, "g", "label", "source", "example_id").first()
    assert (r.example_id, r.cells, r.cluster_size) == (key, cells, len(rows))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert graph.components(spark.createDataFrame([], "a string, b string")).collect() == []
    star = spark.range(1, 2000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    assert graph.components(star).agg(F.count_distinct("root"), F.count("*")).first() == (1, 2000)


def test_dedup(spark):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [("zzz", base), ("aaa", base + " "), ("mmm", base.replace("word30", "wird30")), ("bbb", "something else altogether, not alike at all"), ("ccc", "ab"), ("ddd", ""), ("eee", None)]
    groups, edges, roots = dedup.near_duplicates(spark.createDataFrame(rows, "example_id string, t string"), "example_id", "t")
    got = {r.text_key: r.root for r in roots.collect()}
    assert got == {"aaa": "aaa", "mmm": "aaa", "bbb": "bbb", "ccc": "ccc", "ddd": "ddd"}
    assert dedup.cluster_stats(groups, edges, roots).first().asDict() == {"n_texts": 5, "n_clusters": 4, "multi_text_clusters": 1, "pairs": 1}
    sizes = spark.createDataFrame([(f"g{i}",) for i, n in enumerate((1, 1, 2, 4, 7, 20, 75, 500)) for _ in range(n)], "g string")
    assert {r.size: r.clusters for r in dedup.size_histogram(sizes, "g").collect()} == {"1": 2, "2": 1, "3-5": 1, "6-10": 1, "11-50": 1, "51-100": 1, "100+": 1}
    assert dedup.bands_for(0.85) == (8, 16) or dedup.bands_for(0.85)[0] * dedup.bands_for(0.85)[1] <= 128


@pytest.mark.parametrize("threshold", dedup.SWEEP)
def test_no_pair_of_signatures_is_lost(spark, threshold):
    """Pairs that agree in just as many slots as they must, and in one less."""
    rng = random.Random(7)
    least, rows, want = math.ceil(threshold * 128), [], set()
    for n in range(150):
        sig = [rng.randrange(2**32) for _ in range(128)]
        rows.append((f"a{n:03d}", sig))
        for kind, differ in (("b", 128 - least), ("c", 129 - least)):
            at = set(rng.sample(range(128), differ))
            rows.append((f"{kind}{n:03d}", [rng.randrange(2**32) if i in at else x for i, x in enumerate(sig)]))
        want.add((f"a{n:03d}", f"b{n:03d}"))
    got = dedup.candidate_pairs(spark.createDataFrame(rows, "k string, sig array<bigint>"), "k", threshold).collect()
    assert {(r.a, r.b) for r in got if r.a[0] == "a"} == want and all(r.similarity >= threshold for r in got)


def test_split_by_group_never_straddles(spark):
    from patraloom.functions.ids import assign_split

    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 200).cast("string").alias("g"))
    p = {"train": 0.8, "validation": 0.1, "test": 0.1}
    assert audit.straddling(df.withColumn("s", assign_split("g", p, "42")), "g", "s").count() == 0
    assert audit.straddling(df.withColumn("s", assign_split("id", p, "42")), "g", "s").count() > 0


def test_audit(spark):
    want, found = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "example_id string"), spark.createDataFrame([("b",), ("c",), ("c",)], "example_id string")
    assert audit.coverage(want, found).first().asDict() == {"wanted": 2, "found": 2, "missing": 1, "unexpected": 1, "repeated": 1}
    assert [r[0] for r in audit.still_to_do(want, found).collect()] == ["a"]
    p = audit.length_profile(spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "n int"), "n", (2,)).first()
    assert p.p50 == 2 and p.p95 == 3 and p.over_2 == 0.5
    assert {r.name: r.constant for r in audit.constant_columns(spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double"), ["a", "b"]).collect()} == {"a": True, "b": False}
    schema = T.StructType([T.StructField("a", T.StringType())])
    with pytest.raises(audit.SchemaMismatch):
        audit.require(spark.range(1), schema)
    assert audit.drift(5, None) is None and audit.drift(5, 6) and audit.balanced_account(5, 3, {"x": 2})


def test_agreement(spark):
    teacher = spark.createDataFrame([("1", "HATE"), ("2", "NON_HATE"), ("3", "HATE")], "example_id string, label_str string")
    human = spark.createDataFrame([("1", " hate "), ("2", ""), ("3", "non_hate")], "example_id string, h string")
    j = agreement.joined(human, teacher, "example_id", "h")
    assert {r.example_id: r.human for r in j.collect()} == {"1": "HATE", "3": "NON_HATE"}
    for bad in (("1", "maybe"), ("9", "HATE")):
        with pytest.raises(Exception, match="label"):
            agreement.joined(spark.createDataFrame([bad], human.schema), teacher, "example_id", "h").collect()


def test_suites(spark):
    df = spark.createDataFrame([("clear_hate", 1, 0.99, None), ("clear_hate", 1, 0.4, True), ("clear_benign", 0, 0.01, False)], "tier string, gold int, score double, known boolean")
    assert not suites.orientation(df, "tier", "score").where("min_hate > 0.5").first()
    r = {x.tier: x for x in suites.pinned(df, "tier", "score", "known", {"clear_hate": ("min", 0.9)}).collect()}
    assert r["clear_hate"].passed and r["clear_benign"].passed is None
    assert {x.tier: x.recall_at_band for x in suites.rollup(df, "tier", "gold", "score").collect()} == {"clear_hate": 0.5, "clear_benign": None}


def test_scoring(spark):
    def scorer():
        def model(texts):
            if len(texts) > 8:
                raise MemoryError
            return [len(t) / 100 for t in texts]

        return model

    df = spark.createDataFrame([("x" * i,) for i in range(60)] + [(None,)], "t string")
    got = df.select("t", scoring.score_with(scorer)(F.col("t")).alias("s")).collect()
    assert all(r.s is None if r.t is None else math.isclose(r.s, len(r.t) / 100, abs_tol=1e-6) for r in got)


def test_native(spark):
    df = spark.createDataFrame([("1", ODIA, "HATE"), ("2", ODIA + " a", "none")], "id string, body string, verdict string")
    assert native.text_column(df) == "body" and native.label_column(df) == "verdict"
    assert {r.label for r in native.load_gold(df).collect()} == {0, 1}
    with pytest.raises(ValueError):
        native.load_gold(df, "body", "id", {})
