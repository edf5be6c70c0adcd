"""Classification metrics per group, all from one pass over (truth, probability) rows.

Undefined metrics are null, never NaN: Spark orders NaN above every number, and a NaN would pass
each threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmart import config
from riskmart.functions.cleaning import nan_to_null
from riskmart.functions.scores import above, defined, hard_label, in_bins, row_log_loss

MATRIX = ("true_negatives", "false_positives", "false_negatives", "true_positives")


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def matrix_counts(label: Column, predicted: Column) -> list[Column]:
    """The four cells of the confusion matrix as aggregates."""
    cells = {
        "true_negatives": (label == 0) & (predicted == 0),
        "false_positives": (label == 0) & (predicted == 1),
        "false_negatives": (label == 1) & (predicted == 0),
        "true_positives": (label == 1) & (predicted == 1),
    }
    return [F.count_if(hit).alias(name) for name, hit in cells.items()]


def confusion_matrix(df: DataFrame, keys: Sequence[str] = (), label: str = "label",
                     proba: str = "prediction", threshold: float = config.SCORE_THRESHOLD,
                     zero_if_one_class: bool = False) -> DataFrame:
    """tn, fp, fn, tp per group.

    ``zero_if_one_class`` reports four zeros where truth and prediction together hold one class
    only, which is what unpacking a 1 x 1 matrix used to end in.
    """
    rows = df.where(F.col(label).isin(0, 1))
    matrix = rows.groupBy(*keys).agg(*matrix_counts(F.col(label), hard_label(F.col(proba), threshold)))
    if not zero_if_one_class:
        return matrix
    wrong = F.col("false_positives") + F.col("false_negatives")
    two_classes = (wrong > 0) | ((F.col("true_negatives") > 0) & (F.col("true_positives") > 0))
    return matrix.withColumns({c: F.when(two_classes, F.col(c)).otherwise(0) for c in MATRIX})


def with_rates(matrix: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four counts; null for a group without rows."""
    tn, fp, fn, tp = (F.col(c) for c in MATRIX)
    rows = tn + fp + fn + tp

    def of_rows(value):
        return F.when(rows > 0, value)

    return matrix.withColumns({
        "accuracy": of_rows((tn + tp) / rows),
        "precision": of_rows(_share(tp, tp + fp)),
        "recall": of_rows(_share(tp, tp + fn)),
        "f1_score": of_rows(_share(2 * tp, 2 * tp + fp + fn)),
    })


def log_loss(df: DataFrame, keys: Sequence[str] = (), label: str = "label",
             proba: str = "prediction") -> DataFrame:
    """Mean log loss per group; null where the truth holds one class only or a score is undefined."""
    rows = df.where(F.col(label).isin(0, 1))
    positive = F.col(label) == 1
    loss = F.avg(row_log_loss(F.col(proba), positive))
    usable = ((F.count_if(positive) > 0) & (F.count_if(~positive) > 0)
              & (F.count_if(~defined(F.col(proba))) == 0))
    return rows.groupBy(*keys).agg(F.when(usable, loss).alias("log_loss"))


def predicted_rates(df: DataFrame, keys: Sequence[str] = (), label: str = "label",
                    proba: str = "prediction", threshold: float = config.SCORE_THRESHOLD) -> DataFrame:
    """Actual default rate, mean probability and predicted default rates (>= and strictly >)."""
    p = F.col(proba)
    return df.groupBy(*keys).agg(
        F.avg(label).alias("actual_rate"),
        F.avg(nan_to_null(p)).alias("mean_probability"),
        F.avg(hard_label(p, threshold)).alias("predicted_rate"),
        F.avg(above(p, threshold)).alias("predicted_rate_strict"))


def score_counts(df: DataFrame, keys: Sequence[str], label: str, proba: str) -> DataFrame:
    """Positives and negatives per distinct score: ties, however many, leave as one row, and so do the
    undefined scores (null). A truth other than 0 and 1 does not count."""
    return (df.select(*keys, nan_to_null(F.col(proba)).alias("score"), F.col(label).alias("truth"))
            .where(F.col("truth").isin(0, 1))
            .groupBy(*keys, "score")
            .agg(F.count_if(F.col("truth") == 1).alias("pos"), F.count_if(F.col("truth") == 0).alias("neg")))


def _by_score_chunk(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cut the distinct scores into even value ranges, each with the negatives that lie below a row
    inside its own range.

    Range partitioning samples the data for its limits, so a range stays small whatever the shape
    of the scores and however large one group is.
    """
    chunked = (counts.repartitionByRange(*keys, "score")
               .withColumn("chunk", F.spark_partition_id()))
    upwards = Window.partitionBy(*keys, "chunk").orderBy("score").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return chunked.withColumn("neg_below", F.sum("neg").over(upwards) - F.col("neg"))


def _area(chunks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add to every chunk its share of the rank sum, over all lower chunks of its group.

    There are at most as many rows per group as there are range partitions.
    """
    lower = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("chunk_neg").over(lower), F.lit(0))
    return chunks.withColumn("area", F.col("area_inside") + F.col("chunk_pos") * below.cast("double"))


def _chunk_sums() -> list[Column]:
    return [F.sum("pos").alias("chunk_pos"), F.sum("neg").alias("chunk_neg"),
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("area_inside"),
            F.sum(F.when(F.col("score").isNull(), F.col("pos") + F.col("neg")).otherwise(0)).alias("undefined")]


def _auc_value() -> Column:
    pairs = F.sum("chunk_pos").cast("double") * F.sum("chunk_neg").cast("double")
    return F.when((pairs > 0) & (F.sum("undefined") == 0), F.sum("area") / pairs)


def auc(df: DataFrame, keys: Sequence[str] = (), label: str = "label",
        proba: str = "prediction") -> DataFrame:
    """Exact area under the ROC curve per group, ties counted half; null for a single class and for a
    group that holds an undefined score.

    Two-level rank sum: distinct scores are ranked inside even value ranges, then the ranges are
    ranked per group, so no task sorts a whole group.
    """
    counts = score_counts(df, keys, label, proba)
    chunks = _by_score_chunk(counts, keys).groupBy(*keys, "chunk").agg(*_chunk_sums())
    return _area(chunks, keys).groupBy(*keys).agg(_auc_value().alias("auc_roc"))


def evaluate(df: DataFrame, keys: Sequence[str] = (), label: str = "label", proba: str = "prediction",
             threshold: float = config.SCORE_THRESHOLD) -> DataFrame:
    """All metrics of a group at once, and its score histogram (``bins``, ``n_rows``), from the table
    of distinct scores.

    Confusion counts, log loss and histogram depend on a row only through (score, truth), so they
    ride along with the aggregation the exact AUC needs: one scan, no join of metric tables.

    A row with an undefined score (null or NaN) is predicted 0: it is in the confusion counts and in
    ``n_rows``, in no bin, and leaves its group without AUC and log loss.
    """
    return evaluate_counts(score_counts(df, keys, label, proba), keys, threshold)


def evaluate_counts(counts: DataFrame, keys: Sequence[str] = (), threshold: float = config.SCORE_THRESHOLD) -> DataFrame:
    """``evaluate`` of a table of distinct scores: keys, score, pos, neg. Several rows of one score are as good as one."""
    score, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    hit = hard_label(score, threshold) == 1
    extra = [
        F.sum(F.when(hit, 0).otherwise(neg)).alias("true_negatives"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("false_positives"),
        F.sum(F.when(hit, 0).otherwise(pos)).alias("false_negatives"),
        F.sum(F.when(hit, pos).otherwise(0)).alias("true_positives"),
        F.sum(pos * row_log_loss(score, F.lit(True)) + neg * row_log_loss(score, F.lit(False))).alias("loss"),
        F.expr(f"array({', '.join(f'sum(if({inside}, pos + neg, 0))' for inside in in_bins('score'))})").alias("chunk_bins"),
    ]
    chunks = _by_score_chunk(counts, keys).groupBy(*keys, "chunk").agg(*_chunk_sums(), *extra)
    pos_rows, neg_rows = F.sum("chunk_pos"), F.sum("chunk_neg")
    totals = _area(chunks, keys).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in MATRIX],
        _auc_value().alias("auc_roc"),
        F.when((pos_rows > 0) & (neg_rows > 0) & (F.sum("undefined") == 0),
               F.sum("loss") / (pos_rows + neg_rows)).alias("log_loss"),
        F.expr(f"array({', '.join(f'sum(chunk_bins[{i}])' for i in range(len(config.PSI_EDGES) - 1))})").alias("bins"),
        (pos_rows + neg_rows).alias("n_rows"))
    return with_rates(totals).select(
        *keys, "accuracy", "precision", "recall", "f1_score", F.lit(threshold).alias("threshold"),
        "auc_roc", "log_loss", *MATRIX, "bins", "n_rows")
