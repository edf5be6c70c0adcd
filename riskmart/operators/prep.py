"""Training and scoring matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskmart import config
from riskmart.functions.dates import rolling_split_name, split_name

IDS = ("loan_id", "Customer_ID")


def with_split(df: DataFrame, splits=config.SPLITS, date_col: str = "snapshot_date",
               offset_months: int = 0) -> DataFrame:
    """Rows of the named date ranges, with the name in ``split``.

    The range filter is stated on the date itself, so it prunes partitions.
    """
    inside = None
    for start, end in splits.values():
        hit = F.col(date_col).between(*[F.add_months(F.lit(d).cast("date"), offset_months) for d in (start, end)])
        inside = hit if inside is None else inside | hit
    return df.where(inside).withColumn("split", split_name(F.col(date_col), splits, offset_months))


def with_rolling_split(df: DataFrame, months=config.WINDOW_MONTHS, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of consecutive month windows that end with the table's last snapshot."""
    anchor = df.agg(F.max(date_col)).scalar()
    named = df.withColumn("split", rolling_split_name(F.col(date_col), anchor, months))
    return named.where(F.col("split").isNotNull())


def training_set(features: DataFrame, labels: DataFrame, splits=config.SPLITS,
                 label_offset: int = config.LABEL_MOB, how: str = "inner",
                 align_months: bool = False) -> DataFrame:
    """Features of every split with the labels of the same split, ``label_offset`` months on.

    All splits are joined at once on (loan_id, split). By default a loan's label may lie in any
    month of the split's label window; ``align_months`` demands exactly ``label_offset`` months
    after the feature row. ``how="left"`` keeps loans without a label. Both sides have a row per loan, so neither is
    broadcast, however small its files are.
    """
    left = with_split(features, splits)
    right = with_split(labels, splits, offset_months=label_offset).select(
        "loan_id", "split", "label", F.col("snapshot_date").alias("label_date"))
    keys = ["loan_id", "split"]
    if align_months:
        left = left.withColumn("label_date", F.add_months("snapshot_date", label_offset))
        keys.append("label_date")
    return left.join(right.hint("merge"), keys, how).drop("label_date")


def require_labels(df: DataFrame, splits: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """Labelled rows per split; raises where a split has none (one bounded row per split)."""
    counts = df.groupBy("split").agg(F.count("label").alias("n")).where(F.col("split").isin(*splits))
    found = {r["split"]: r["n"] for r in counts.collect()}
    empty = [s for s in splits if not found.get(s)]
    if empty:
        raise ValueError(f"no labelled rows in the windows {empty}")
    return df


def resolve_features(df: DataFrame, wanted: Sequence[str] = config.MODEL_FEATURES) -> tuple[list[str], list[str]]:
    """Wanted features the frame has, in the wanted order, and those it lacks."""
    return [c for c in wanted if c in df.columns], [c for c in wanted if c not in df.columns]


def train_matrix(df: DataFrame, wanted: Sequence[str] = config.MODEL_FEATURES) -> DataFrame:
    """Identifiers, split, label and the available features in their configured order."""
    available, _ = resolve_features(df, wanted)
    return df.select("loan_id", "split", "label", *available)


def inference_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Identifiers, snapshot and exactly the trained features: absent ones null, all coerced to
    double, infinities null."""
    lacking = [c for c in IDS if c not in df.columns]
    if lacking:
        raise ValueError(f"identifier columns missing from the feature snapshot: {lacking}")

    def number(c):
        value = f"try_cast(`{c}` as double)"
        return f"if(isnan({value}) or abs({value}) = double('Infinity'), null, {value}) as `{c}`"

    return df.selectExpr(*IDS, "snapshot_date", *[
        number(c) if c in df.columns else f"cast(null as double) as `{c}`" for c in features])
