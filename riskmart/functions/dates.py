"""Snapshot dates: tags in file names, month arithmetic and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_TAG_FORMAT = "yyyy_MM_dd"
_TAG_PATTERN = r"(\d{4}_\d{2}_\d{2})\D*$"


def snapshot_tag(c: Column) -> Column:
    """Date to its ``YYYY_MM_DD`` tag."""
    return F.date_format(c, _TAG_FORMAT)


def tag_date(c: Column) -> Column:
    """The date a file name or path ends with; null where there is none."""
    return F.try_to_date(F.regexp_extract(c, _TAG_PATTERN, 1), _TAG_FORMAT)


def month_floor(c: Column) -> Column:
    return F.trunc(c, "MM")


def months_between_closed(start: Column, end: Column) -> Column:
    """Array of month starts from the month of ``start`` to the month of ``end``."""
    return F.sequence(month_floor(start), month_floor(end), F.expr("interval 1 month"))


def month_calendar(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Every month start between the first and the last snapshot of a table."""
    span = df.agg(F.min(date_col).alias("first"), F.max(date_col).alias("last"))
    return span.select(F.explode(months_between_closed(F.col("first"), F.col("last"))).alias("month"))


def range_calendar(spark, start: str, end: str) -> DataFrame:
    """Every month start of a closed range of dates."""
    return spark.range(1).select(F.explode(months_between_closed(
        F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("month"))


def split_name(c: Column, splits: dict[str, tuple[str, str]], offset_months: int = 0) -> Column:
    """Name of the closed range that holds the date, null outside all of them.

    ``offset_months`` moves every range, which is how label snapshots find the split of the
    features they belong to.
    """
    result = None
    for name, (start, end) in splits.items():
        hit = c.between(*[F.add_months(F.lit(d).cast("date"), offset_months) for d in (start, end)])
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result


def rolling_split_name(c: Column, anchor: Column, months: dict[str, int]) -> Column:
    """Name of the month window that holds the date, counted back from the anchor's month.

    The windows follow each other in the given order and the last one ends with the anchor.
    """
    back = F.months_between(month_floor(anchor), month_floor(c)).cast("int")
    result, newest = None, 0
    for name, length in reversed(list(months.items())):
        hit = back.between(newest, newest + length - 1)
        result = F.when(hit, name) if result is None else result.when(hit, name)
        newest += length
    return result
