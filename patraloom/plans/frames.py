"""The frames most queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patraloom.functions.bands import band, rounded
from patraloom.functions.ids import assign_split, unit_fraction
from patraloom.functions.text import is_question
from patraloom.operators import audit

# The usual split, and the salt it is drawn with.
SPLITS, SALT = {"train": 0.8, "validation": 0.1, "test": 0.1}, "42"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _records(spark: SparkSession, folder: str, name: str, columns: tuple[str, ...]) -> DataFrame:
    return table(spark, folder, name).select("example_id", *columns).distinct()


def pair_records(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``pairs`` with repeated rows once, as ``example_id`` and the columns
    asked for: repeated rows are exact copies, so the others need not be read."""
    return _records(spark, folder, "pairs", columns)


def release_records(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``release`` likewise."""
    return _records(spark, folder, "release", columns)


def scored(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Records with their last score, rounded, and label."""
    scores = audit.latest_scores(table(spark, folder, "score_shards"))
    out = audit.attach_scores(pair_records(spark, folder, *columns), scores)
    return out.withColumn("p_hate", rounded("p_hate_raw")).withColumn("label", band("p_hate"))


def with_split(df: DataFrame, key: str = "example_id", name: str = "part") -> DataFrame:
    return df.withColumn(name, assign_split(key, SPLITS, SALT))


def predictions(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Gold labels of the release and a stand-in model's predictions: the label,
    turned around for about 15 % of the records. With ``text_eng`` among the
    columns also ``question`` and ``char_len``."""
    r = release_records(spark, folder, "label", *columns).where("label is not null")
    wrong = unit_fraction("example_id", "pred") < 0.15
    r = r.withColumn("gold", F.col("label").cast("int")).withColumn("pred", F.when(wrong, 1 - F.col("gold")).otherwise(F.col("gold")))
    r = r.withColumns({
        "prob_hate": F.when(F.col("pred") == 1, 0.5 + unit_fraction("example_id", "prob") / 2).otherwise(unit_fraction("example_id", "prob") / 2),
        "correct": F.col("gold") == F.col("pred"),
    })
    return r.withColumns({"question": is_question("text_eng"), "char_len": F.length("text_eng")}) if "text_eng" in columns else r
