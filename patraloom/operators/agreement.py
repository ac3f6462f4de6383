"""Human labels against a teacher's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patraloom.operators.metrics import kappa


def joined(human: DataFrame, teacher: DataFrame, key: str, value: str, names: tuple[str, str] = ("HATE", "NON_HATE")) -> DataFrame:
    """``key``, ``human``, ``teacher``: blank human labels are skipped; an
    unknown label or a row without a teacher's raises when it is read."""
    label = F.upper(F.trim(value))
    rows = human.withColumn("human", label).where("human is not null and human <> ''")
    out = rows.join(teacher.select(key, F.col("label_str").alias("teacher")), key, "left")
    bad = ~F.col("human").isin(*names)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("unknown label "), "human"))).when(F.col("teacher").isNull(), F.raise_error(F.concat(F.lit("no teacher's label for "), F.col(key)))).otherwise(F.col("human"))
    return out.select(key, checked.alias("human"), "teacher")


def per_class(df: DataFrame, human: str, teacher: str) -> DataFrame:
    """Per teacher's label: rows, and the share the human agrees with."""
    return df.groupBy(F.col(teacher).alias("teacher")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(human) == F.col(teacher)).alias("agreed"), F.avg((F.col(human) == F.col(teacher)).cast("double")).alias("agreement"))


def report(df: DataFrame, human: str = "human", teacher: str = "teacher") -> DataFrame:
    return kappa(df, human, teacher)
