"""Monitoring that reads predictions once: a state of distinct scores per model and snapshot.

Labels arrive half a year after the predictions they belong to. What a report needs of a snapshot is how many rows
have each score, and how many of them turned out good and bad; that state is kept, partitioned by model and snapshot, so
a month of new labels costs the predictions of one snapshot and a report costs none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskmart import config
from riskmart.functions.cleaning import nan_to_null
from riskmart.operators.drift import counted_histogram, with_baseline
from riskmart.operators.metrics import evaluate_counts
from riskmart.plans.monitoring import IDENTIFIERS, KEYS, assembled, empty_overlap_keys, prediction_snapshots
from riskmart.sources.snapshots import read_snapshots, write_snapshots

_KEYS = [T.StructField("model_name", T.StringType()), T.StructField("snapshot_date", T.DateType())]
COUNTS_SCHEMA = T.StructType([T.StructField("score", T.DoubleType()), *[T.StructField(c, T.LongType()) for c in ("n", "pos", "neg")], *_KEYS])
STATUS_SCHEMA = T.StructType([T.StructField("labelled", T.BooleanType()), T.StructField("n_rows", T.LongType()), *_KEYS])

Snapshot = tuple[str, date]


@dataclass(frozen=True)
class State:
    """Locations of the counts and of the status of each snapshot, below one root."""

    root: str

    @property
    def counts(self) -> str:
        return f"{self.root}/score_counts"

    @property
    def status(self) -> str:
        return f"{self.root}/status"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return read_snapshots(spark, path, schema)


def due(predictions: DataFrame, labels: DataFrame, state: State, offset: int = config.LABEL_MOB,
        again: Sequence[str] = ()) -> list[tuple[str, date, bool]]:
    """(model, snapshot, labelled) that the state lacks, that got labels since, or whose date is named in ``again``.

    Predictions and labels are asked for partition values only, so no data column is read; the driver gets one row per
    model and snapshot."""
    spark = predictions.sparkSession
    have = prediction_snapshots(predictions).select(*KEYS).distinct().where("snapshot_date is not null")
    months = labels.select(F.col("snapshot_date").alias("label_date")).distinct().withColumn("labelled", F.lit(True))
    now = (have.withColumn("label_date", F.add_months("snapshot_date", offset)).join(months, "label_date", "left")
           .select(*KEYS, F.coalesce("labelled", F.lit(False)).alias("labelled")))
    known = _stored(spark, state.status, STATUS_SCHEMA).select(*KEYS, F.col("labelled").alias("was_labelled"))
    named = F.col("snapshot_date").isin([F.lit(d).cast("date") for d in again]) if again else F.lit(False)
    wanted = now.join(known, KEYS, "left").where(
        F.col("was_labelled").isNull() | (F.col("labelled") & ~F.col("was_labelled")) | named)
    return sorted((r["model_name"], r["snapshot_date"], r["labelled"]) for r in wanted.select(*KEYS, "labelled").collect())


def counted(predictions: DataFrame, labels: DataFrame, wanted: Sequence[Snapshot], offset: int = config.LABEL_MOB) -> DataFrame:
    """(score, n, pos, neg, model, snapshot) of some snapshots: rows per distinct score, and labels of either kind.

    Both inputs are cut down by partition filters, predictions to the snapshots and labels to their months. Labels are
    counted per key before they meet predictions, on the partitioning of that join, so repeated labels count as often as
    there are and a prediction is one row all the same."""
    scored = prediction_snapshots(predictions)
    inside, months = F.lit(False), sorted({day for _, day in wanted})
    for model in sorted({m for m, _ in wanted}):
        days = [F.lit(str(day)).cast("date") for m, day in wanted if m == model]
        inside = inside | ((F.col("model_name") == model) & F.col("snapshot_date").isin(days))
    # the same in terms of the columns that a predictions table is partitioned by
    if "inference_date" in scored.columns:
        scored = scored.where(F.col("inference_date").isin([str(day) for day in months]))
    ids = [c for c in IDENTIFIERS if c in scored.columns and c in labels.columns]
    if not ids:
        raise ValueError(f"predictions and labels share none of {IDENTIFIERS}")
    of_months = labels.where(F.col("snapshot_date").isin([F.add_months(F.lit(str(day)).cast("date"), offset) for day in months]))
    truth = of_months.groupBy(*ids, F.col("snapshot_date").alias("label_date")).agg(
        F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros"))
    rows = scored.where(inside).select(*ids, *KEYS, nan_to_null(F.col("prediction").cast("double")).alias("score"),
                                       F.add_months("snapshot_date", offset).alias("label_date"))
    return rows.join(truth, [*ids, "label_date"], "left").groupBy(*KEYS, "score").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("ones"), F.lit(0)).alias("pos"), F.coalesce(F.sum("zeros"), F.lit(0)).alias("neg")
    ).select(*COUNTS_SCHEMA.names)


def update(predictions: DataFrame, labels: DataFrame, state: State, offset: int = config.LABEL_MOB,
           again: Sequence[str] = ()) -> list[Snapshot]:
    """Bring the state up to date and return the snapshots that were counted.

    Counts are replaced by snapshot and the status follows them, so a run that ends in between is done again by the next
    one. ``again`` names snapshot dates whose predictions or labels were written anew."""
    spark = predictions.sparkSession
    found = due(predictions, labels, state, offset, again)
    if not found:
        return []
    wanted = [(model, day) for model, day, _ in found]
    write_snapshots(counted(predictions, labels, wanted, offset), state.counts, by=tuple(KEYS))
    sizes = _of(_stored(spark, state.counts, COUNTS_SCHEMA), wanted).groupBy(*KEYS).agg(F.sum("n").alias("n_rows"))
    status = spark.createDataFrame(found, "model_name string, snapshot_date date, labelled boolean").join(sizes, KEYS, "left")
    write_snapshots(status.select(*STATUS_SCHEMA.names), state.status, by=tuple(KEYS))
    return wanted


def _of(table: DataFrame, wanted: Sequence[Snapshot]) -> DataFrame:
    return table.where(F.col("model_name").isin(sorted({m for m, _ in wanted}))
                       & F.col("snapshot_date").isin([F.lit(str(d)).cast("date") for d in sorted({d for _, d in wanted})]))


def report(spark: SparkSession, state: State, period: tuple[str, str] | None = None,
           limits: config.Thresholds = config.Thresholds(), threshold: float = config.SCORE_THRESHOLD,
           strict_psi: bool = False) -> DataFrame:
    """``monitoring_report`` from the state alone; ``period`` shows a closed range, the baseline stays the earliest of all."""
    counts, status = _stored(spark, state.counts, COUNTS_SCHEMA), _stored(spark, state.status, STATUS_SCHEMA)
    if period:
        shown = F.col("snapshot_date").between(*[F.lit(d).cast("date") for d in period])
        first = {r["model_name"]: r["day"] for r in status.groupBy("model_name").agg(F.min("snapshot_date").alias("day")).collect()}
        base = F.lit(False)
        for model, day in first.items():
            base = base | ((F.col("model_name") == model) & (F.col("snapshot_date") == F.lit(str(day)).cast("date")))
        counts = counts.where(shown | base)
    everyone = with_baseline(counted_histogram(counts, KEYS), ["model_name"], "snapshot_date")
    labelled = counts.where("pos > 0 or neg > 0")
    if period:
        everyone, labelled = everyone.where(shown), labelled.where(shown)
    observed = evaluate_counts(labelled.select(*KEYS, "score", "pos", "neg"), KEYS, threshold)
    everyone = everyone.join(status.select(*KEYS, F.col("labelled").alias("has_labels")), KEYS, "left")
    return assembled(everyone, observed, limits, threshold, strict_psi)


def monitor(predictions: DataFrame, labels: DataFrame, state: State, offset: int = config.LABEL_MOB,
            again: Sequence[str] = (), **options) -> tuple[DataFrame, DataFrame | None]:
    """Update, report, and sample keys of both sides where a labelled snapshot shares no row with its labels (else None).

    The samples read data only where an overlap is empty, and then the snapshots and months concerned."""
    update(predictions, labels, state, offset, again)
    shown = report(predictions.sparkSession, state, **options)
    counted_ = F.col("true_negatives") + F.col("false_positives") + F.col("false_negatives") + F.col("true_positives")
    if shown.where("has_labels").where(counted_ == 0).isEmpty():
        return shown, None
    return shown, empty_overlap_keys(predictions, labels, shown, offset=offset)
