"""Raw feeds and snapshot tables.

A snapshot table is one Parquet (or CSV) table partitioned by ``snapshot_date``. Months are
partitions, never files of their own, so every job covers all of them in one pass and a range of
months is a partition filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskmart.session import remove
from riskmart.sources.feeds import accepted, bind_feed

SNAPSHOT = "snapshot_date"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text: a raw feed is typed by the silver rules, not by inference."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_feed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a raw CSV feed as text, every file bound by its own header; no inference pass over the data.

    Rows that do not match their header are left out here; ``feeds.rejected`` of ``feeds.bind_feed`` has them."""
    return accepted(bind_feed(spark, path, columns), columns)


#: Rows of a feed file. A compressed file is read by one task, so none may hold much more than a split does.
_FEED_ROWS = 1_000_000


def write_feed(df: DataFrame, path: str) -> None:
    """Write a table as a raw CSV feed, in parallel, compressed, in files of bounded size."""
    df.write.option("maxRecordsPerFile", _FEED_ROWS).csv(path, header=True, mode="overwrite", compression="gzip")


def write_snapshots(df: DataFrame, path: str, by: Sequence[str] = (SNAPSHOT,),
                    file_format: str = "parquet", gathered: bool = False,
                    covered: tuple[str, str] | None = None) -> None:
    """Replace exactly the partitions the frame holds; running twice leaves the same table.

    ``covered`` names the closed range of dates that this run answers for (``by`` then is one date
    column): partitions in it that got no rows are removed, so that a snapshot that has become empty
    does not keep its old rows.

    Rows in any order are rebalanced first: each partition's rows come together in few files, and a
    partition with a large share of the rows is split over several tasks. ``gathered`` says that the
    rows already lie by partition, as in the row-wise result of a table partitioned alike; then
    nothing is shuffled.
    """
    options = {"header": "true"} if file_format == "csv" else {}
    ((df if gathered else df.hint("rebalance", *by))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .options(**options)
       .partitionBy(*by)
       .format(file_format)
       .save(path))
    if covered:
        held = {str(r[0]) for r in df.select(*by).distinct().collect()}  # one row per partition
        _empty(df.sparkSession, path, by[0], covered, held)


def _empty(spark: SparkSession, path: str, by: str, covered: tuple[str, str], held: set[str]) -> None:
    """Remove the partitions of a closed range that are not among ``held``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(folder):
        column, _, value = status.getPath().getName().partition("=")
        if column == by and covered[0] <= value <= covered[1] and value not in held:
            remove(spark, status.getPath().toString())


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   file_format: str = "parquet") -> DataFrame:
    """All snapshots of a table. With a schema, no partition value is guessed."""
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", "true")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def _day(df: DataFrame, date_col: str) -> Column:
    """The date of a row; text that is no date, as raw feeds may hold, is null instead of an error."""
    return F.col(date_col).try_cast("date") if dict(df.dtypes)[date_col] == "string" else F.col(date_col)


def at_snapshot(df: DataFrame, day: str, date_col: str = SNAPSHOT) -> DataFrame:
    """One snapshot (partition pruning)."""
    return df.where(_day(df, date_col) == F.lit(day).cast("date"))


def in_range(df: DataFrame, start: str, end: str, date_col: str = SNAPSHOT) -> DataFrame:
    """Snapshots of a closed range of dates (partition pruning)."""
    return df.where(_day(df, date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns a frame lacks are null."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
