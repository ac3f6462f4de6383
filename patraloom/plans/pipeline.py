"""The curation pipeline as one chain of frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patraloom.functions.text import normalise
from patraloom.operators import gates, sampling
from patraloom.plans import frames


@dataclass(frozen=True)
class Curated:
    gated: DataFrame
    kept: DataFrame
    labelled: DataFrame
    survivors: DataFrame
    split: DataFrame


def curate(spark: SparkSession, folder: str) -> Curated:
    """Gate, attach scores, band, remove exact duplicates, split by group. A null
    source is a source of its own."""
    gated = gates.gate_texts(frames.scored(spark, folder, "source_config", "text_eng", "text_ory"))
    kept = gates.kept(gated)
    labelled = kept.where("label is not null")
    grouped = labelled.withColumn("dedup_group", F.sha2(normalise("text_ory"), 256))
    survivors = sampling.representatives(grouped, "dedup_group", "label", "source_config", "example_id")
    return Curated(gated, kept, labelled, survivors, frames.with_split(survivors, "dedup_group"))


def three_way(spark: SparkSession, folder: str) -> DataFrame:
    """Survivors per split, label and source: the flagship query."""
    split = curate(spark, folder).split
    return split.groupBy("part", "label", "source_config").agg(F.count(F.lit(1)).alias("n"), F.sum("cluster_size").alias("rows"))
