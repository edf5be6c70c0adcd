"""Roll-ups of the monitoring history. History rows are one per model, snapshot and run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskmart import config
from riskmart.functions.cleaning import nan_to_null
from riskmart.operators.drift import score_density
from riskmart.session import written
from riskmart.sources.snapshots import in_range

REPORTED = ("auc_roc", "accuracy", "precision", "recall", "f1_score", "psi")
FLOOR_CHECKS = ("check_auc_roc_check", "check_precision_check", "check_recall_check", "check_f1_score_check")


def history_in_period(history: DataFrame, start: str, end: str) -> DataFrame:
    """History of a closed period, in date order."""
    return in_range(history, start, end).orderBy("snapshot_date", "monitored_at")


def require_history(history: DataFrame, at_least: int = 2) -> DataFrame:
    """Raise where a report would have fewer records than it needs."""
    found = history.limit(at_least).count()
    if found < at_least:
        raise ValueError(f"a report needs {at_least} monitoring records, found {found}")
    return history


def latest_per_snapshot(history: DataFrame, keys: Sequence[str] = ("model_name", "snapshot_date")) -> DataFrame:
    """The newest record of every model and snapshot. An aggregate, so re-runs collapse before the
    shuffle."""
    newest = F.max_by(F.struct(*history.columns), "monitored_at").alias("r")
    return history.groupBy(*keys).agg(newest).select("r.*")


def latest_metrics(history: DataFrame) -> DataFrame:
    """Per model the record of its last snapshot, of the newest run."""
    last = F.max_by(F.struct("snapshot_date", "model_name", *REPORTED), F.struct("snapshot_date", "monitored_at"))
    return history.groupBy("model_name").agg(last.alias("r")).select("r.*")


def threshold_compliance(history: DataFrame) -> DataFrame:
    """Passed floor checks of every record, and their share in percent."""
    passed = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in FLOOR_CHECKS), F.lit(0))
    total = len(FLOOR_CHECKS)
    return history.select("snapshot_date", "model_name", "monitored_at", passed.alias("passed_checks"),
                          F.lit(total).alias("total_checks"), (passed / total * 100).alias("compliance_rate"))


def monitoring_summary(history: DataFrame) -> DataFrame:
    """Per model first and last snapshot, number of records, mean metrics and share of passed records."""
    return history.groupBy("model_name").agg(
        F.min("snapshot_date").alias("first_snapshot"), F.max("snapshot_date").alias("last_snapshot"),
        F.count("*").alias("records"),
        *[F.avg(nan_to_null(F.col(c))).alias(f"avg_{c}") for c in REPORTED],
        (F.avg(F.col("check_all_passed").cast("int")) * 100).alias("pass_rate"))


def monitoring_series(history: DataFrame, limits: config.Thresholds = config.Thresholds()) -> DataFrame:
    """Chart data in long form: (snapshot_date, model_name, monitored_at, series, value, threshold,
    warning). Only the stability index has a warning line beside its critical one."""
    metrics = ("auc_roc", "accuracy", "precision", "recall", "f1_score", "log_loss", "psi",
               "true_positives", "false_positives", "true_negatives", "false_negatives")
    keys = ["snapshot_date", "model_name", "monitored_at"]
    wide = history.select(*keys, *[F.col(c).cast("double").alias(c) for c in metrics])
    floors = {**limits.floors, "psi": limits.psi_critical}
    threshold = F.lit(None).cast("double")
    for name, value in floors.items():
        threshold = F.when(F.col("series") == name, F.lit(value)).otherwise(threshold)
    warning = F.when(F.col("series") == "psi", F.lit(limits.psi_warning))
    return wide.unpivot(keys, list(metrics), "series", "value").withColumns({"threshold": threshold, "warning": warning})


def even_period_sample(df: DataFrame, date_col: str = "snapshot_date", periods: int = config.PERIOD_SAMPLE) -> DataFrame:
    """Evenly spaced snapshots, first and last included; all of them where there are few.

    Works on the sorted array of distinct dates, which is as long as the calendar; a timestamp counts
    as its day.
    """
    moment = dict(df.dtypes)[date_col].startswith("timestamp")
    day = F.col(date_col).cast("date") if moment else F.col(date_col)
    days = df.agg(F.array_sort(F.collect_set(day)).alias("days")).withColumn("n", F.size("days"))
    step = (F.col("n") - 1) / F.lit(float(periods - 1))
    spaced = F.transform(F.sequence(F.lit(0), F.lit(periods - 1)), lambda k: F.when(
        k == periods - 1, F.col("n") - 1).otherwise(F.floor(k * step).cast("int")))
    every = F.sequence(F.lit(0), F.col("n") - 1)
    chosen = F.when(F.col("n") > periods, spaced).otherwise(every)
    picked = days.where("n > 0").select("days", F.explode(chosen).alias("position"))
    return picked.select("position", F.get("days", F.col("position")).alias(date_col))


def sampled_density(df: DataFrame, start: str, end: str, date_col: str = "snapshot_date",
                    proba: str = "prediction") -> DataFrame:
    """Score densities for the chart of distributions: an even sample of all snapshots, of which those
    inside a closed period are drawn."""
    chosen = written(even_period_sample(df, date_col).select(date_col), "periods")
    return score_density(in_range(df, start, end, date_col).join(chosen, date_col, "left_semi"), date_col, proba)


def best_model(registry: DataFrame, metric: str = config.SELECTION_METRIC, split: str = "validation",
               mode: str = "max") -> DataFrame:
    """The model with the best value of a metric on a split; the lower ordinal wins a tie.

    Undefined values never win. Registry rows: (ordinal, model_name, split, metric, value).
    """
    value = nan_to_null(F.col("value"))
    score = value if mode == "max" else -value
    rows = registry.where((F.col("split") == split) & (F.col("metric") == metric) & value.isNotNull())
    first = F.max_by(F.struct("model_name", "value"), F.struct(score, -F.col("ordinal"))).alias("r")
    return rows.agg(first).select("r.model_name", F.lit(metric).alias("selection_metric"),
                                  F.col("r.value").alias("selection_score"))


def registry_long(evaluated: DataFrame, keys: Sequence[str] = ("model_name", "split")) -> DataFrame:
    """Metrics of models and splits in long form: (keys, metric, value)."""
    metrics = ["accuracy", "precision", "recall", "f1_score", "auc_roc", "log_loss"]
    return evaluated.unpivot(list(keys), metrics, "metric", "value")
