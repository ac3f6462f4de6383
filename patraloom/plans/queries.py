"""Queries over whole tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patraloom.functions import bands, ids
from patraloom.functions import text as X
from patraloom.operators import agreement, association, audit, baseline, dedup, gates, metrics, native, sampling, scoring, suites
from patraloom.plans import frames, pipeline
from patraloom.plans.frames import pair_records, predictions, release_records, scored, table
from patraloom.session import cut

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, as sums of doubles depend on their order in the last digits."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c, t in df.dtypes if t in ("double", "float")})


# Scalar expressions


@query
def f1_turn0_prompt(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_conversations")
    return raw.select("doc_id", X.turn_prompt("eng_latn").alias("eng"), X.turn_prompt("ory_orya").alias("ory"))


@query
def f2_turn_display(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_conversations")
    return raw.select("doc_id", X.turn_display("eng_latn", 1).alias("eng"), X.turn_display("ory_orya", 1).alias("ory"))


@query
def f3_strip_zero_width(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", X.strip_zero_width("text_ory").alias("text"))


@query
def f4_collapse_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", X.collapse_whitespace("text_ory").alias("text"))


@query
def f5_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", X.normalise("text_ory").alias("text"))


@query
def f6_normalise_eval(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", X.normalise_eval("text_eng").alias("text"))


@query
def f7_script_purity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(table(spark, folder, "pairs").select("example_id", X.script_purity("text_ory").alias("purity")))


@query
def f8_script_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").groupBy("lang", X.script_of("text").alias("script")).agg(F.count(F.lit(1)).alias("n"))


@query
def f9_example_id(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", ids.example_id("source_config", "doc_id").alias("made"))


@query
def f10_unit_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", ids.unit_fraction("example_id", frames.SALT).alias("u"))


@query
def f11_assign_split(spark: SparkSession, folder: str) -> DataFrame:
    return frames.with_split(table(spark, folder, "pairs").select("example_id"))


@query
def f12_shingles(spark: SparkSession, folder: str) -> DataFrame:
    norm = table(spark, folder, "pairs").select("example_id", X.normalise("text_ory").alias("t"))
    return norm.select("example_id", F.size(X.shingles("t")).alias("n"))


@query
def f13_band(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "score_shards").groupBy(bands.band(bands.rounded("p_hate_raw")).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query
def f14_rounded(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "score_shards").select("example_id", "shard", bands.rounded("p_hate_raw").alias("p_hate"))


@query
def f15_near_bound(spark: SparkSession, folder: str) -> DataFrame:
    near = table(spark, folder, "score_shards").select("example_id", "shard", bands.rounded("p_hate_raw").alias("p"))
    return near.where(bands.near_bound("p", within=0.001)).select("example_id", "shard", "p")


@query
def f16_is_question(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id", X.is_question("text_eng").alias("question"))


@query
def f17_features(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pairs").where("text_ory is not null")
    return rounded(p.select("example_id", *(c.alias(n) for n, c in X.features("text_ory", X.script_purity("text_ory")).items())))


@query
def f18_surface_features(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pairs").where("text_ory is not null")
    return rounded(p.select("example_id", *(c.alias(n) for n, c in X.surface_features("text_ory").items())))


@query
def f19_coerced_label(spark: SparkSession, folder: str) -> DataFrame:
    named = release_records(spark, folder, "label", "label_str").select("example_id", F.coalesce(F.lower("label_str"), F.col("label").cast("string")).alias("raw"))
    return named.select("example_id", X.coerced_label("raw").alias("label"))


@query
def f20_length_sides(spark: SparkSession, folder: str) -> DataFrame:
    return gates.length_side_counts(gates.gate_texts(table(spark, folder, "rejects").select("example_id", "text_eng", "text_ory")))


@query
def f22_yield_verdict(spark: SparkSession, folder: str) -> DataFrame:
    counts = scored(spark, folder, "source_config").where("label is not null").groupBy("source_config").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("source_config", "n", association.verdict(F.col("n")).alias("verdict"))


@query
def f24_expected_macro_f1(spark: SparkSession, folder: str) -> DataFrame:
    r = metrics.rates(metrics.confusion(predictions(spark, folder, "source_config"), "gold", "pred", "source_config"))
    return rounded(r.select("source_config", "tpr", "fpr", "prevalence", "balanced_accuracy", metrics.expected_macro_f1(F.lit(0.01), F.col("tpr"), F.col("fpr")).alias("expected")))


@query
def f26_excerpt(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "rejects").select("example_id", F.substring("text_eng", 1, 150).alias("excerpt"))


# Gates


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    return gates.gate_turns(table(spark, folder, "raw_conversations"))


@query
def g1_gates(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder).select("doc_id", "text_eng", "text_ory", "reason", "all_failed_gates")


@query
def g2_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return gates.rejected(gates.gate_texts(table(spark, folder, "rejects").select("example_id", "text_eng", "text_ory"))).select("example_id", F.col("reason").alias("found"))


@query
def g3_drop_counts(spark: SparkSession, folder: str) -> DataFrame:
    return gates.drop_counts(gates.gate_texts(pair_records(spark, folder, "source_config", "text_eng", "text_ory")), "source_config")


@query
def g3_co_failures(spark: SparkSession, folder: str) -> DataFrame:
    return gates.co_failures(_gated(spark, folder))


@query
def g4_breaches(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(gates.breaches(gates.gate_texts(pair_records(spark, folder, "source_config", "text_eng", "text_ory")), "source_config", 1.0))


@query
def g5_discarded(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder).where("label is null").select("example_id", "p_hate")


@query
def g9_split_overlap(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.with_split(pair_records(spark, folder, "text_ory").withColumn("norm", X.normalise("text_ory")))
    return audit.split_overlap(rows, "norm", "part")


@query
def g10_straddling_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.with_split(pair_records(spark, folder, "text_ory").withColumn("g", F.sha2(X.normalise("text_ory"), 256)))
    return audit.straddling(rows, "g", "part").select("g", F.array_join("splits", ",").alias("splits"))


@query
def g10_straddling_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = pair_records(spark, folder, "text_ory").withColumn("g", F.sha2(X.normalise("text_ory"), 256)).where("g is not null")
    return audit.straddling(frames.with_split(rows, "g"), "g", "part").select("g", F.array_join("splits", ",").alias("splits"))


# Joins and sets


@query
def j1_attach_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scored(spark, folder, "source_config").select("example_id", "source_config", "p_hate_raw", "p_hate")


@query
def j2_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return audit.coverage(table(spark, folder, "pairs"), table(spark, folder, "score_shards"))


@query
def j3_still_to_do(spark: SparkSession, folder: str) -> DataFrame:
    return audit.still_to_do(table(spark, folder, "pairs"), audit.latest_scores(table(spark, folder, "score_shards")))


@query
def j6_agreement(spark: SparkSession, folder: str) -> DataFrame:
    teacher = release_records(spark, folder, "label_str").where("label_str is not null")
    human = teacher.select("example_id", F.when(ids.unit_fraction("example_id", "human") < 0.1, F.lit(" ")).when(ids.unit_fraction("example_id", "human") < 0.3, F.lit("hate")).otherwise(F.lower("label_str")).alias("human_label"))
    return agreement.per_class(agreement.joined(human, teacher, "example_id", "human_label"), "human", "teacher").withColumn("agreement", F.round("agreement", 6))


@query
def j8_variant_difference(spark: SparkSession, folder: str) -> DataFrame:
    rows = release_records(spark, folder, "label", "source_config")
    a = sampling.balance(rows, "label", "source_config", "example_id", "proportional")
    b = sampling.balance(rows, "label", "source_config", "example_id", "proportional", 7)
    return audit.difference(a, b, ["example_id"])


@query
def u2_unscored(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pairs").select("example_id").subtract(table(spark, folder, "score_shards").select("example_id"))


@query
def u3_shared_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.with_split(pair_records(spark, folder, "text_eng").withColumn("norm", X.normalise("text_eng"))).where("norm is not null")
    of = lambda s: rows.where(F.col("part") == s).select("norm")
    return of("train").intersect(of("test"))


# Aggregations


@query
def a1_yields(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(association.yields(scored(spark, folder, "source_config"), "source_config", "label"))


@query
def a2_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(bands.histogram(scored(spark, folder, "source_config"), "p_hate", ["source_config"]))


@query
def a3_contingency(spark: SparkSession, folder: str) -> DataFrame:
    return association.contingency(release_records(spark, folder, "label", "source_config"), "source_config", "label")


@query
def a4_mutual_information(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(association.association(release_records(spark, folder, "label", "source_config"), "source_config", "label"))


@query
def a6_label_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(association.label_shares(release_records(spark, folder, "label", "source_config"), "source_config", "label"))


@query
def a7_exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_groups(pair_records(spark, folder, "text_ory"), "example_id", "text_ory").select("text_key", "members")


def _grouped(spark: SparkSession, folder: str) -> DataFrame:
    return release_records(spark, folder, "label", "source_config", "text_ory").withColumn("g", F.sha2(X.normalise("text_ory"), 256)).where("g is not null")


@query
def a8_size_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.size_histogram(_grouped(spark, folder), "g")


@query
def a9_spanning(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.spanning(_grouped(spark, folder), "g", "label", "source_config")


@query
def a10_three_way(spark: SparkSession, folder: str) -> DataFrame:
    return audit.three_way(frames.with_split(release_records(spark, folder, "label", "source_config")), "part", "label", "source_config")


@query
def a11_split_shares(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(audit.split_shares(frames.with_split(release_records(spark, folder, "label", "source_config")), "part", "label", "source_config", list(frames.SPLITS)))


@query
def a12_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.metrics(predictions(spark, folder), "gold", "pred"))


@query
def a13_metrics_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.metrics(predictions(spark, folder, "source_config"), "gold", "pred", "source_config").select("source_config", "n", "accuracy", "macro_f1", "mcc"))


@query
def a13_metrics_by_mood(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.metrics(predictions(spark, folder, "text_eng"), "gold", "pred", "question").select("question", "n", "accuracy", "macro_f1", "mcc"))


@query
def a14_metrics_by_length(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.metrics_by_length(predictions(spark, folder, "text_eng"), "gold", "pred", "char_len").select("length_bin", "n", "macro_f1"))


@query
def a15_mood_by_error(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.mood_by_error(predictions(spark, folder, "text_eng").withColumn("wrong", ~F.col("correct")), "question", "wrong"))


@query
def a16_mood_prediction(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.mood_prediction(predictions(spark, folder, "text_eng"), "question", "gold", "pred"))


@query
def a17_confidence(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.confidence(predictions(spark, folder), "correct", "prob_hate"))


@query
def a18_kappa(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.kappa(predictions(spark, folder), "gold", "pred").withColumn("word", metrics.agreement_word(F.col("kappa"))))


def _suite(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "canary_items")
    hateful = F.col("tier") == "clear_hate"
    shift = F.when(hateful, 0.7).otherwise(0.0) + scoring.hash_score("id") * F.lit(0.3)
    return items.withColumn("gold", hateful.cast("int")).withColumn("score", F.round(shift, 6))


@query
def a19_suite_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(suites.rollup(_suite(spark, folder), "tier", "gold", "score"))


@query
def a19_suite_overall(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(suites.overall(_suite(spark, folder), "gold", "score"))


@query
def a20_orientation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(suites.orientation(_suite(spark, folder), "tier", "score"))


@query
def a21_pinned(spark: SparkSession, folder: str) -> DataFrame:
    bounds = {"clear_hate": ("min", 0.7), "clear_benign": ("max", 0.3), "hard_negative": ("max", 0.2)}
    return suites.pinned(_suite(spark, folder), "tier", "score", "documented_failure", bounds)


@query
def a22_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return audit.alignment(table(spark, folder, "raw_conversations"))


@query
def a22_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return audit.id_collisions(table(spark, folder, "pairs"), "source_config", "doc_id")


@query
def a22_turn_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return audit.turn_histogram(table(spark, folder, "raw_conversations"))


@query
def a23_length_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(audit.length_profile(table(spark, folder, "documents"), "n_chars", (64, 128, 256, 512, 1024, 2048, 4096), "source"))


@query
def a24_replicates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.resamples(predictions(spark, folder), "gold", "pred"))


@query
def a24_interval(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.interval(metrics.resamples(predictions(spark, folder), "gold", "pred")))


@query
def a25_floors(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.floors(predictions(spark, folder), "example_id", "gold"))


@query
def a26_question_rule(spark: SparkSession, folder: str) -> DataFrame:
    rule = predictions(spark, folder, "text_eng").withColumn("rule", F.when(F.col("question"), 0).otherwise(1))
    return rounded(metrics.metrics(rule, "gold", "rule"))


@query
def a27_probe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(suites.probe(_suite(spark, folder).where("tier = 'question_form'"), "score"))


@query
def a28_label_counts(spark: SparkSession, folder: str) -> DataFrame:
    return frames.with_split(release_records(spark, folder, "label", "source_config")).where("part = 'train'").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def a29_funnel(spark: SparkSession, folder: str) -> DataFrame:
    c = pipeline.curate(spark, folder)
    return audit.funnel([("gates", c.gated, c.kept), ("bands", c.kept, c.labelled), ("duplicates", c.labelled, c.survivors)])


@query
def a30_gap(spark: SparkSession, folder: str) -> DataFrame:
    p = predictions(spark, folder)
    other = p.where(~(F.col("gold") == 1) | (ids.unit_fraction("example_id", "native") < 0.05))
    return rounded(metrics.gap(metrics.confusion(p, "gold", "pred"), metrics.confusion(other, "gold", "pred")))


@query
def a31_constant_features(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pairs").where("text_ory is not null")
    f = {n: c.cast("double") for n, c in X.features("text_ory", X.script_purity("text_ory")).items()}
    return rounded(audit.constant_columns(p.select(*(c.alias(n) for n, c in f.items())), list(f)), 4)


# Samples and quotas


@query
def w1_largest_remainder(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "documents").where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return sampling.shares(counts, "source", "n", 1000)


@query
def w3_downsample(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("source is not null")
    quota = docs.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / 3).alias("quota"))
    return sampling.downsample(docs.select("doc_id", "source"), quota, "source", "doc_id", 42)


@query
def w4_stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stratified_sample(table(spark, folder, "documents").select("doc_id", "source"), 300, "source", "doc_id", 42)


@query
def w5_agreement_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.balanced_sample(release_records(spark, folder, "label", "source_config"), 200, "label", "source_config", "example_id", 42).select("example_id", "label", "source_config")


@query
def w6_representatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _grouped(spark, folder).where("label is not null")
    return sampling.representatives(rows, "g", "label", "source_config", "example_id")


@query
def w7_review_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "rejects").where("example_id is not null").select("example_id", "reason").distinct()
    return sampling.sample_per_group(rows, 5, "reason", "example_id", 42)


@query
def w9_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.simple_sample(table(spark, folder, "documents").select("doc_id"), 250, "doc_id", 42)


@query
def w8_balance(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.balance(release_records(spark, folder, "label", "source_config"), "label", "source_config", "example_id", "proportional").select("example_id", "label", "source_config")


@query
def w8_balance_match_minority(spark: SparkSession, folder: str) -> DataFrame:
    rows = sampling.balance(release_records(spark, folder, "label", "source_config"), "label", "source_config", "example_id", "match_minority")
    return rows.groupBy("source_config", "label").agg(F.count(F.lit(1)).alias("n"))


# Order and limits


@query
def o4_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Some rows to look at: the first of a table by its key."""
    return table(spark, folder, "canary_items").select("id", "tier", "text").orderBy("id").limit(13)


@query
def o5_ranked_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Each label's sources, the largest share first."""
    return rounded(association.ranked(association.label_shares(release_records(spark, folder, "label", "source_config"), "source_config", "label"), "pct", "source_config", "label"))


@query
def o2_largest_groups(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.largest(_grouped(spark, folder), "g", "example_id").withColumn("ids", F.array_join("ids", ","))


@query
def o3_confident_errors(spark: SparkSession, folder: str) -> DataFrame:
    p = predictions(spark, folder, "text_eng").where(~F.col("correct"))
    p = p.withColumn("confidence", F.greatest("prob_hate", 1 - F.col("prob_hate"))).withColumn("kind", F.when(F.col("pred") == 1, "FP").otherwise("FN"))
    return p.orderBy(F.desc("confidence"), "example_id").limit(25).select("example_id", "kind", F.substring("text_eng", 1, 400).alias("excerpt"))


# Deduplication


@query
def d1_exact_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_groups(pair_records(spark, folder, "text_eng"), "example_id", "text_eng").select(F.col("text_key").alias("example_id"))


@query
def d3_similar_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_duplicates(pair_records(spark, folder, "text_ory"), "example_id", "text_ory")[1]


@query
def d4_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_duplicates(pair_records(spark, folder, "text_ory"), "example_id", "text_ory", pairs=False)[2]


@query
def d4_components_of_links(spark: SparkSession, folder: str) -> DataFrame:
    """Records linked by an equal Odia or an equal English text, as components."""
    p = pair_records(spark, folder, "text_ory", "text_eng")
    rows = p.select("example_id", X.normalise("text_ory").alias("o"), X.normalise("text_eng").alias("e"))
    links = None
    for c in ("o", "e"):
        first = rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("example_id").alias("b"))
        one = rows.join(first, c).select(F.col("example_id").alias("a"), "b")
        links = one if links is None else links.unionByName(one)
    return dedup.clusters(p.select("example_id").distinct(), "example_id", links)


@query
def d5_cluster_stats(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.cluster_stats(*dedup.near_duplicates(pair_records(spark, folder, "text_ory"), "example_id", "text_ory"))


@query
def d6_threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    groups = dedup.exact_groups(pair_records(spark, folder, "text_ory"), "example_id", "text_ory")
    return dedup.sweep(cut(dedup.minhash(groups, "text_key", "norm")), "text_key")


@query
def d7_english_stats(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.cluster_stats(*dedup.near_duplicates(pair_records(spark, folder, "text_eng"), "example_id", "text_eng"))


@query
def d8_survivors(spark: SparkSession, folder: str) -> DataFrame:
    rows = release_records(spark, folder, "label", "source_config", "text_ory").where("label is not null")
    groups, _, roots = dedup.near_duplicates(rows, "example_id", "text_ory", pairs=False)
    return sampling.representatives(dedup.map_back(rows, "example_id", "text_ory", groups, roots), "dedup_group", "label", "source_config", "example_id")


# Models and inference of layout


@query
def m2_scored_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A toy scorer through the Arrow path: the share of upper-case letters."""

    def scorer():
        return lambda texts: [sum("A" <= c <= "Z" for c in t) / max(1, len(t)) for t in texts]

    p = table(spark, folder, "pairs").where("text_eng is not null")
    return p.select("example_id", F.round(scoring.score_with(scorer)(F.col("text_eng")).cast("double"), 5).alias("score"))


@query
def m4_token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Lengths by a tokeniser of single characters, through the Arrow path."""
    p = table(spark, folder, "pairs").where("text_eng is not null")
    return p.select("example_id", scoring.token_lengths(lambda: list)(F.col("text_eng")).alias("n_tokens"))


@query
def m5_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """The tiers in their order, each only if those before it passed."""
    bounds = {"clear_hate": ("min", 0.7), "clear_benign": ("max", 0.3), "hard_negative": ("max", 0.2)}
    return suites.tiers(_suite(spark, folder), "tier", "score", "documented_failure", bounds)


@query
def m6_surface_baseline(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.with_split(release_records(spark, folder, "label", "text_ory").where("label is not null and text_ory is not null"))
    model = baseline.fit(rows.where("part = 'train'"), "text_ory", "label")
    return metrics.metrics(baseline.predict(model, rows.where("part <> 'train'"), "text_ory"), "label", "prediction", "part")


@query
def m6_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """The surface model's features, the strongest first."""
    rows = frames.with_split(release_records(spark, folder, "label", "text_ory").where("label is not null and text_ory is not null"))
    ranked = baseline.coefficients(baseline.fit(rows.where("part = 'train'"), "text_ory", "label"))
    return rounded(spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(ranked, 1)], "place int, feature string, coefficient double"))


@query
def m6_transfer(spark: SparkSession, folder: str) -> DataFrame:
    """The surface model of English texts on the suite, which it wasn't fitted
    to: metrics, and how much of the way from chance to 0.9094 they cover."""
    rows = frames.with_split(release_records(spark, folder, "label", "text_eng").where("label is not null and text_eng is not null"))
    suite = table(spark, folder, "canary_items").withColumn("label", (F.col("tier") == "clear_hate").cast("int"))
    m = metrics.metrics(baseline.predict(baseline.fit(rows.where("part = 'train'"), "text_eng", "label"), suite, "text"), "label", "prediction")
    chance = metrics.floors(suite, "id", "label").where("floor = 'random'").select(F.col("macro_f1").alias("chance"))
    both = m.select("n", "accuracy", "macro_f1", "mcc").crossJoin(F.broadcast(chance))  # one row each
    return rounded(both.withColumn("covered", metrics.covered(F.col("macro_f1"), F.col("chance"), F.lit(0.9094))))


@query
def n1_text_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(native.text_scores(table(spark, folder, "pairs")), 4)


@query
def slice_three_way(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.three_way(spark, folder)


def queries() -> dict[str, Query]:
    return dict(QUERIES)
