"""The row-wise stages as streams.

Gates, normalisation and banding hold no state and run on a stream as they are.
Deduplication within a stream keeps keys for as long as a watermark says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.functions.bands import band, rounded
from patraloom.functions.text import normalise


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def band_stream(scores: DataFrame, score: str = "p_hate_raw") -> DataFrame:
    """Adds ``p_hate`` and ``label`` to a stream of scores; unscored rows are dropped."""
    return scores.where(F.col(score).isNotNull()).withColumn("p_hate", rounded(score)).withColumn("label", band("p_hate"))


def first_texts(rows: DataFrame, text: str, at: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each normalised text; a text's repeat is dropped if it
    comes within the watermark."""
    return rows.withColumn("text_hash", F.sha2(normalise(text), 256)).withWatermark(at, delay).dropDuplicatesWithinWatermark(["text_hash"])


def band_counts(banded: DataFrame, at: str = "written_at", window: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Scores per window and band; rows later than ``delay`` don't count."""
    return banded.withWatermark(at, delay).groupBy(F.window(at, window), "label").agg(F.count(F.lit(1)).alias("n"))
