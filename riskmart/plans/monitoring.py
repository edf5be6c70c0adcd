"""Monitoring of all models and snapshots in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskmart import config
from riskmart.functions.scores import stability_index
from riskmart.operators.checks import with_checks
from riskmart.operators.drift import score_histogram, with_baseline
from riskmart.operators.metrics import MATRIX, evaluate
from riskmart.sources.history import CHECKS, METRICS
from riskmart.sources.predictions import normalised
from riskmart.sources.snapshots import in_range

IDENTIFIERS = ("loan_id", "Customer_ID")
KEYS = ["model_name", "snapshot_date"]


def prediction_snapshots(predictions: DataFrame) -> DataFrame:
    """Predictions with one probability name, a date-typed snapshot and a model name."""
    df = normalised(predictions)
    if "snapshot_date" not in df.columns:
        df = df.withColumn("snapshot_date", F.to_date("inference_date"))
    model = F.coalesce(F.col("model_name"), F.lit("Unknown")) if "model_name" in df.columns else F.lit("Unknown")
    return df.withColumn("model_name", model)


def join_labels(predictions: DataFrame, labels: DataFrame, offset: int = config.LABEL_MOB) -> DataFrame:
    """Predictions with the label observed ``offset`` months later, on every identifier both have."""
    ids = [c for c in IDENTIFIERS if c in predictions.columns and c in labels.columns]
    if not ids:
        raise ValueError(f"predictions and labels share none of {IDENTIFIERS}")
    left = predictions.withColumn("label_date", F.add_months("snapshot_date", offset))
    right = labels.select(*ids, "label", F.col("snapshot_date").alias("label_date"))
    return left.join(right, [*ids, "label_date"], "inner")


def unmatched_keys(predictions: DataFrame, labels: DataFrame, key: str = "loan_id", n: int = 5) -> DataFrame:
    """The first ``n`` keys of either side without a partner, to explain an empty overlap."""
    def first(df, other, side):
        alone = df.select(key).join(other.select(key), key, "left_anti").distinct()
        return alone.orderBy(key).limit(n).select(F.lit(side).alias("side"), key)
    return first(predictions, labels, "predictions").unionByName(first(labels, predictions, "labels"))


def period_and_baseline(scored: DataFrame, start: str, end: str) -> DataFrame:
    """The predictions of a closed period and of each model's first snapshot.

    The first dates come from the two columns that a predictions table is partitioned by, so that
    scan reads no data column; one row per model is fetched and becomes part of a partition filter.
    """
    first = scored.groupBy("model_name").agg(F.min("snapshot_date").alias("day")).collect()
    wanted = F.col("snapshot_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    for row in first:
        if row["day"] is not None:
            wanted = wanted | ((F.col("model_name") == row["model_name"]) & (F.col("snapshot_date") == F.lit(row["day"])))
    return scored.where(wanted)


def empty_overlap_keys(predictions: DataFrame, labels: DataFrame, report: DataFrame, n: int = 5,
                       offset: int = config.LABEL_MOB) -> DataFrame:
    """For snapshots that have labels but share no row with them: sample keys without a partner, by side.

    Empty where every labelled snapshot of the report was measured on some row.
    """
    counted = F.col("true_negatives") + F.col("false_positives") + F.col("false_negatives") + F.col("true_positives")
    empty = report.where("has_labels").where(counted == 0).select("model_name", "snapshot_date").distinct()
    scored = prediction_snapshots(predictions).join(empty, KEYS, "left_semi")
    months = empty.select(F.add_months("snapshot_date", offset).alias("snapshot_date")).distinct()
    return unmatched_keys(scored, labels.join(months, "snapshot_date", "left_semi"), n=n)


def monitoring_report(predictions: DataFrame, labels: DataFrame, offset: int = config.LABEL_MOB,
                      limits: config.Thresholds = config.Thresholds(),
                      threshold: float = config.SCORE_THRESHOLD, strict_psi: bool = False,
                      period: tuple[str, str] | None = None) -> DataFrame:
    """One row per model and snapshot: metrics, stability index, checks and alert level.

    ``period`` reports a closed range of snapshots; the baseline stays the earliest of all.

    A snapshot whose label month exists is measured on the joined rows; one without labels has null
    metrics, zero counts and the index of all its predictions. The baseline of the index is every
    prediction of the model's earliest snapshot. Predictions are read twice (histogram, join);
    everything after the score aggregation has one row per model and snapshot.
    """
    scored = prediction_snapshots(predictions)
    if period:
        scored = period_and_baseline(scored, *period)
    everyone = with_baseline(score_histogram(scored, KEYS), ["model_name"], "snapshot_date")
    if period:
        everyone, scored = in_range(everyone, *period), in_range(scored, *period)
    observed = evaluate(join_labels(scored, labels, offset), KEYS, threshold=threshold)
    label_months = labels.select(F.col("snapshot_date").alias("label_date")).distinct().withColumn(
        "has_labels", F.lit(True))
    everyone = everyone.withColumn("label_date", F.add_months("snapshot_date", offset)).join(label_months, "label_date", "left")
    return assembled(everyone, observed, limits, threshold, strict_psi)


def assembled(everyone: DataFrame, observed: DataFrame, limits: config.Thresholds = config.Thresholds(),
              threshold: float = config.SCORE_THRESHOLD, strict_psi: bool = False) -> DataFrame:
    """The report from one row per model and snapshot: histograms with their baseline and ``has_labels``, and metrics."""
    rows = everyone.join(observed.withColumnsRenamed(
        {"bins": "joined_bins", "n_rows": "joined_rows", "threshold": "joined_threshold"}), KEYS, "left")
    has_labels = F.coalesce(F.col("has_labels"), F.lit(False))
    joined_rows = F.coalesce(F.col("joined_rows"), F.lit(0))
    rows = rows.withColumns({
        "has_labels": has_labels,
        "measured_bins": F.when(has_labels, F.col("joined_bins")).otherwise(F.col("bins")),
        "measured_rows": F.when(has_labels, joined_rows).otherwise(F.col("n_rows"))})
    psi = stability_index("baseline_bins", "baseline_rows", "measured_bins", "measured_rows")
    measured = rows.select(
        *KEYS, "has_labels", (F.col("measured_rows") == 0).alias("empty_overlap"),
        *[c for c in METRICS if c != "threshold"], F.lit(threshold).alias("threshold"),
        *[F.expr(f"coalesce({c}, 0L) as {c}") for c in MATRIX], psi.alias("psi"))
    return with_checks(measured, limits, strict_psi, "empty_overlap").drop("empty_overlap")


def monitoring_records(report: DataFrame, limits: config.Thresholds = config.Thresholds(),
                       monitored_at: Column | None = None) -> DataFrame:
    """Report rows as nested records: keys, metrics, threshold checks, thresholds."""
    if monitored_at is None:
        monitored_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return report.select(
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "model_name",
        monitored_at.alias("monitored_at"),
        F.struct(*METRICS, *MATRIX, "psi").alias("metrics"),
        F.struct(*CHECKS, "alert_level").alias("threshold_checks"),
        F.struct(*[F.lit(getattr(limits, name)).alias(name) for name in limits.__dataclass_fields__]).alias("thresholds"))
