"""Data-quality profiles. One pass per table, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskmart.functions.cleaning import cast_columns

_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def snapshot_counts(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot."""
    return df.groupBy(date_col).agg(F.count("*").alias("row_count"))


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percentage, worst first."""
    def is_missing(name, kind):
        c = F.col(name)
        return c.isNull() | F.isnan(c) if kind in ("float", "double") else c.isNull()

    missing = [F.struct(F.lit(name).alias("column_name"),
                        F.count_if(is_missing(name, kind)).alias("missing_count"))
               for name, kind in df.dtypes]
    totals = df.agg(F.count("*").alias("total"), F.array(*missing).alias("profile"))
    rows = totals.select("total", F.inline("profile")).where("missing_count > 0")
    percentage = F.round(F.col("missing_count") / F.col("total") * 100, 2)
    return (rows.select("column_name", "missing_count", percentage.alias("missing_percentage"))
            .orderBy(F.desc("missing_percentage"), "column_name"))


def _bad_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) of every entry that is present, not blank and no number."""
    present = [c for c in columns if c in df.columns]
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in present])
    long = cells.unpivot([], present, "column_name", "value")
    value = F.col("value")
    return long.where(value.rlike(r"\S") & ~value.rlike(_NUMBER))


def non_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of non-numeric entries per column that is expected to hold numbers."""
    return _bad_numbers(df, columns).groupBy("column_name").agg(F.count("*").alias("bad_count"))


def non_numeric_samples(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` distinct non-numeric values of every column, in value order.

    Each task keeps at most ``n`` values per column before anything is shuffled for the ranking.
    """
    distinct = _bad_numbers(df, columns).distinct()
    order = Window.partitionBy("column_name").orderBy("value")
    return distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key; nulls compare equal."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def shape(df: DataFrame) -> DataFrame:
    """Name, position and type of every column, with the table's row count."""
    listing = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"),
                                 F.lit(kind).alias("data_type")) for i, (name, kind) in enumerate(df.dtypes)])
    return df.agg(F.count("*").alias("row_count")).select("row_count", F.inline(listing))


def cast_losses(raw: DataFrame, types: dict[str, str], strip: Sequence[str] = ()) -> DataFrame:
    """Per typed column, how many entries are present as text and how many of them the cast loses.

    Raw and typed values sit side by side in one projection, so there is no join back.
    """
    names = [c for c in types if c in raw.columns]
    kept = {f"raw_{c}": F.col(c) for c in names}
    both = cast_columns(raw.withColumns(kept), types, strip=strip)
    report = [F.struct(F.lit(c).alias("column_name"),
                       F.count(f"raw_{c}").alias("present"),
                       F.count_if(F.col(f"raw_{c}").isNotNull() & F.col(c).isNull()).alias("lost"))
              for c in names]
    return both.agg(F.array(*report).alias("report")).select(F.inline("report"))
