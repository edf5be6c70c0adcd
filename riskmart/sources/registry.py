"""Model registry: fitted pipelines next to tables of metrics, metadata and the selected model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmart import config
from riskmart.operators.report import best_model, registry_long


#: Settings of each model, by the beginning of their names.
PARAMETERS = {"LogisticRegression": ("logistic_",), "RandomForest": ("trees", "forest_"), "GradientBoosting": ("boosting_",)}


def save_model(model: PipelineModel, root: str, name: str, features: Sequence[str],
               medians: Sequence[float], settings: config.ModelSettings, spark: SparkSession) -> None:
    """Save the fitted pipeline and its metadata row: features in matrix order, their training
    medians, parameters, time."""
    model.write().overwrite().save(f"{root}/models/{name}")
    own = PARAMETERS.get(name, ())
    parameters = {k: str(v) for k, v in asdict(settings).items() if k.startswith(own) or k == "seed"}
    spark.range(1).select(
        F.lit(name).alias("model_name"), F.array(*[F.lit(c) for c in features]).alias("features"),
        F.array(*[F.lit(m).cast("double") for m in medians]).alias("medians"),
        F.create_map(*[F.lit(x) for pair in parameters.items() for x in pair]).alias("params"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("trained_at"),
    ).write.mode("overwrite").parquet(f"{root}/metadata/{name}")


def save_registry(evaluated: DataFrame, root: str, names: Sequence[str]) -> DataFrame:
    """Write the metrics of all models and splits, and the selected model."""
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model_name")).cast("int")
    table = registry_long(evaluated).select(order.alias("ordinal"), "model_name", "split", "metric", "value")
    table.write.mode("overwrite").parquet(f"{root}/registry_metrics")
    spark = evaluated.sparkSession
    stored = read_registry(spark, root)
    best_model(stored).withColumn("updated_at", F.current_timestamp().cast("string")).write.mode(
        "overwrite").parquet(f"{root}/registry_best")
    return stored


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/registry_metrics")


def load_best_model(spark: SparkSession, root: str) -> tuple[str, PipelineModel, dict[str, float]]:
    """Name and pipeline of the selected model, and its features in order with their training medians."""
    name = spark.read.parquet(f"{root}/registry_best").first()["model_name"]
    meta = spark.read.parquet(f"{root}/metadata/{name}").first()
    return name, PipelineModel.load(f"{root}/models/{name}"), dict(zip(meta["features"], meta["medians"]))
