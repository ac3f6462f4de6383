"""The queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patraloom.llm import canonical, cutoff, encoding, mixing, neardup, sampling, splitting, toxicity
from patraloom.session import cut


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records whose Odia texts differ but look the same."""
    return canonical.looks_the_same(_table(spark, folder, "pairs"), "example_id", "text_ory")


def p1_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """The consistent form of the Odia text of every record."""
    pairs = _table(spark, folder, "pairs").select("example_id", "text_ory").where("example_id is not null")
    formed = canonical.canonical_text(pairs, {"text_ory": "text"}, keep=["example_id"])
    return formed.groupBy("example_id").agg(F.max("text").alias("text"))


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of every record with an Odia text, and how many others look like it."""
    return canonical.look_classes(_table(spark, folder, "pairs"), "example_id", "text_ory")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Categories of each plan with too few records."""
    found = sampling.records(_table(spark, folder, "release"), ["source_config", "label"])
    report = sampling.quotas(found, _table(spark, folder, "sample_targets"))
    return report.where("available < needed").select("plan", "source_config", "label")


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    """Available, needed and allotted records of each category of each plan."""
    found = sampling.records(_table(spark, folder, "release"), ["source_config", "label"])
    return sampling.quotas(found, _table(spark, folder, "sample_targets"))


def p2_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The sample of each plan."""
    return sampling.target_sample(_table(spark, folder, "release"), _table(spark, folder, "sample_targets"))[0]


def _groups(spark: SparkSession, folder: str, links: bool = False) -> DataFrame:
    return neardup.similar_groups(_table(spark, folder, "pairs"), "example_id", ["text_ory", "text_eng"], links=links)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records in the same group of near-duplicates, per field."""
    return neardup.pairs_in_groups(cut(_groups(spark, folder)), "example_id")


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The group of every record and its similar texts, per field."""
    return _groups(spark, folder, links=True)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The records kept by their source's cutoff."""
    return cutoff.keep_fraction(_table(spark, folder, "release"), _table(spark, folder, "keep_targets"))[0]


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """The cutoff and the numbers kept of each source."""
    return cutoff.keep_fraction(_table(spark, folder, "release"), _table(spark, folder, "keep_targets"))[1]


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.record_scores(_table(spark, folder, "pairs"), _table(spark, folder, "release"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records with an abusive, hateful or sexual English text."""
    return _toxicity(spark, folder).where("toxic").select("example_id")


def p5_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The score of every record."""
    return _toxicity(spark, folder)


def p5_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The rate of such records per source."""
    return toxicity.rates(_toxicity(spark, folder))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of every document."""
    return encoding.token_ids(_table(spark, folder, "documents"))


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    documents = mixing.memberships(_table(spark, folder, "documents").select("doc_id", "source", "text"))
    return cut(encoding.token_counts(documents, ["doc_id", "source", "sources", "copies"]))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources of each plan that can't reach their share."""
    report, _ = mixing.plan_mix(_sized(spark, folder), _table(spark, folder, "mix_targets"))
    return report.where("short").select("plan", "source")


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The documents each plan takes for each source, and how often."""
    return mixing.mix(_sized(spark, folder), _table(spark, folder, "mix_targets"))[0]


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    """Target, reached and actual shares of each source of each plan."""
    docs = _sized(spark, folder)
    chosen, report = mixing.mix(docs, _table(spark, folder, "mix_targets"))
    return mixing.actual(report, chosen, docs)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are cut, as they have more than 512 tokens."""
    return splitting.split_texts(_table(spark, folder, "documents")).where("piece = 0").select("doc_id")


def p8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every document of more than 512 tokens."""
    return splitting.split_texts(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_canonical, p1_classes, p2_found, p2_report, p2_sample, p3_found, p3_groups, p4_found, p4_report, p5_found, p5_scores, p5_rates, p6_ids, p7_found, p7_mix, p7_report, p8_found, p8_pieces)}
