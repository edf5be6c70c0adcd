"""Score distributions: fixed-edge histograms, stability index, density."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmart import config
from riskmart.functions.cleaning import nan_to_null
from riskmart.functions.scores import bin_counts, grid_bin, in_bins, stability_index
from riskmart.session import written


def score_histogram(df: DataFrame, keys: Sequence[str] = (), proba: str = "prediction",
                    edges=config.PSI_EDGES) -> DataFrame:
    """Per group one row: array of bin counts and the number of rows, out-of-range rows included.

    All bins are aggregates of one pass, so tasks send one row per group.
    """
    return (df.select(*keys, nan_to_null(F.col(proba)).alias("p")).groupBy(*keys)
            .agg(bin_counts("p", edges).alias("bins"), F.count("*").alias("n_rows")))


def counted_histogram(counts: DataFrame, keys: Sequence[str] = (), edges=config.PSI_EDGES) -> DataFrame:
    """``score_histogram`` of a table of distinct scores: keys, score and how many rows have it (``n``)."""
    bins = ", ".join(f"sum(if({inside}, n, 0))" for inside in in_bins("score", edges))
    return counts.groupBy(*keys).agg(F.expr(f"array({bins})").alias("bins"), F.sum("n").alias("n_rows"))


def histogram_bins(histogram: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per group and bin: index, count and share."""
    long = histogram.select(*keys, "n_rows", F.posexplode("bins").alias("bin", "bin_count"))
    return long.select(*keys, "bin", "bin_count", (F.col("bin_count") / F.col("n_rows")).alias("share"))


def with_baseline(histogram: DataFrame, model: Sequence[str], date_col: str) -> DataFrame:
    """Put the histogram of each model's earliest date beside all of its dates.

    The table has one row per model and date, so the window is over dates, not over scores.
    """
    earliest = Window.partitionBy(*model).orderBy(date_col)
    return histogram.withColumns({
        "baseline_bins": F.first("bins").over(earliest),
        "baseline_rows": F.first("n_rows").over(earliest),
    })


def psi_column() -> Column:
    """Stability index of a row of ``with_baseline``."""
    return stability_index("baseline_bins", "baseline_rows", "bins", "n_rows")


def psi_by_snapshot(df: DataFrame, date_col: str = "snapshot_date", model: Sequence[str] = (),
                    proba: str = "prediction") -> DataFrame:
    """Stability index of every snapshot against the model's first one."""
    histogram = score_histogram(df, [*model, date_col], proba)
    compared = with_baseline(histogram, model or [F.lit(0)], date_col)
    return compared.select(*model, date_col, psi_column().alias("psi"))


def psi_between(expected: DataFrame, actual: DataFrame, proba: str = "prediction") -> DataFrame:
    """Stability index of two score tables (one row)."""
    one = F.lit(0).alias("k")
    base = score_histogram(expected, (), proba).select(
        one, F.col("bins").alias("baseline_bins"), F.col("n_rows").alias("baseline_rows"))
    now = score_histogram(actual, (), proba).select(one, "bins", "n_rows")
    return now.join(base, "k").select(psi_column().alias("psi"))


def score_density(df: DataFrame, date_col: str = "snapshot_date", proba: str = "prediction",
                  bins: int = config.DENSITY_BINS) -> DataFrame:
    """Density histogram of every snapshot over its own range of scores (non-empty bins).

    The ranges, one row per snapshot, are written once and then joined to the scores; a constant
    snapshot gets a range of width one around its value.
    """
    scores = df.select(date_col, nan_to_null(F.col(proba)).alias("p")).where(F.col("p").isNotNull())
    ranges = scores.groupBy(date_col).agg(F.min("p").alias("low"), F.max("p").alias("high"),
                                          F.count("*").alias("n"))
    flat = F.col("low") == F.col("high")
    ranges = written(ranges.withColumns({
        "low": F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")),
        "high": F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")),
    }), "score-ranges")
    placed = scores.join(ranges, date_col).withColumn(
        "bin", grid_bin(F.col("p"), F.col("low"), F.col("high"), bins))
    width = (F.col("high") - F.col("low")) / bins
    return (placed.groupBy(date_col, "bin", "low", "high", "n").agg(F.count("*").alias("bin_count"))
            .select(date_col, "bin", (F.col("low") + F.col("bin") * width).alias("bin_start"), "bin_count",
                    (F.col("bin_count") / (F.col("n") * width)).alias("density")))
