"""The predictions table: partitioned by model and inference date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskmart import config
from riskmart.functions.scores import hard_label
from riskmart.session import written
from riskmart.sources.snapshots import write_snapshots

MODEL = "model_name"
DATE = "inference_date"


def normalised(df: DataFrame) -> DataFrame:
    """Give the probability column its one name, ``prediction``."""
    if "prediction" in df.columns:
        return df
    if "prediction_proba" in df.columns:
        return df.withColumnRenamed("prediction_proba", "prediction")
    raise ValueError("predictions hold neither 'prediction' nor 'prediction_proba'")


def prediction_rows(scored: DataFrame, model_name: str | Column, date_col: str = "snapshot_date",
                    proba: str = "prediction_proba",
                    threshold: float = config.SCORE_THRESHOLD) -> DataFrame:
    """Scored loans in the layout of the predictions table."""
    model = F.lit(model_name) if isinstance(model_name, str) else model_name
    return scored.select(
        "loan_id", "Customer_ID",
        F.col(proba).cast("double").alias("prediction_proba"),
        hard_label(F.col(proba), threshold).alias("prediction_label"),
        F.lit(threshold).alias("threshold"),
        model.alias(MODEL),
        F.date_format(date_col, "yyyy-MM-dd").alias(DATE),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("inference_timestamp"),
    )


def write_predictions(rows: DataFrame, path: str) -> None:
    write_snapshots(rows, path, by=(MODEL, DATE))


def resolve(predictions: DataFrame, best_model: str) -> DataFrame:
    """Per date, the rows of one model only: unnamed predictions first, then the best model's, then
    the first model by name.

    The choice is made on the distinct (date, model) pairs; the rows then join it.
    """
    rank = (F.when(F.col(MODEL).isNull(), 0).when(F.col(MODEL) == best_model, 1).otherwise(2))
    chosen = (predictions.select(DATE, MODEL).distinct()
              .groupBy(F.col(DATE).alias("chosen_date"))
              .agg(F.min_by(F.struct(MODEL), F.struct(rank, MODEL)).alias("chosen")))
    chosen = chosen.select("chosen_date", F.col(f"chosen.{MODEL}").alias("chosen_model"))
    chosen = written(chosen, "chosen-model")
    same = (F.col(DATE) == F.col("chosen_date")) & F.col(MODEL).eqNullSafe(F.col("chosen_model"))
    return normalised(predictions).join(chosen, same, "left_semi")
