"""A linear model on surface features, the floor any text model must beat."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patraloom.functions.text import surface_features


def with_features(df: DataFrame, text: str) -> DataFrame:
    return df.withColumns({f"f_{k}": F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in surface_features(text).items()})


def fit(train: DataFrame, text: str, label: str, strength: float = 1.0) -> PipelineModel:
    """Standardised features, L2 logistic regression. ``strength`` is the
    inverse penalty on the summed loss, hence 1 / (strength x rows) on the mean."""
    rows = with_features(train.where(F.col(label).isNotNull()), text)
    columns = [c for c in rows.columns if c.startswith("f_")]
    model = LogisticRegression(featuresCol="scaled", labelCol=label, regParam=1.0 / (strength * max(1, rows.count())), standardization=False, maxIter=100)
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="vector"), StandardScaler(inputCol="vector", outputCol="scaled", withMean=True), model]).fit(rows.withColumn(label, F.col(label).cast("double")))


def coefficients(model: PipelineModel) -> list[tuple[str, float]]:
    """The features with their coefficients, the strongest first (ties by name)."""
    names = [c.removeprefix("f_") for c in model.stages[0].getInputCols()]
    return sorted(zip(names, map(float, model.stages[-1].coefficients), strict=True), key=lambda x: (-abs(x[1]), x[0]))


def predict(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    out = model.transform(with_features(df, text))
    return out.drop("vector", "scaled", "rawPrediction", "probability", *(c for c in out.columns if c.startswith("f_"))).withColumn("prediction", F.col("prediction").cast("int"))
