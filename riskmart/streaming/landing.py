"""Incremental landing: the monthly arrival of feed files as a stream that runs until it is up to date.

Each new file in the landing folder is read once; its rows land in bronze below their snapshot and the number
of the delivery, so a snapshot that arrives in several deliveries keeps them all. A trigger of
``availableNow`` makes the stream a batch job that remembers what it has read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from riskmart.sources.feeds import FILE, REASON, RECORD, accepted, bind_feed, feed_files, rejected
from riskmart.sources.snapshots import SNAPSHOT, read_snapshots, text_schema, write_snapshots

DELIVERY = "delivery"
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def land_feed(spark: SparkSession, landing: str, columns: Sequence[str], bronze_path: str, checkpoint: str,
              quarantine_path: str | None = None, files_per_delivery: int = 1000) -> StreamingQuery:
    """Start landing everything that has arrived since the last run; ``awaitTermination`` to finish.

    The stream carries the names of the files that arrived, at most ``files_per_delivery`` at once, and not their
    contents; each is then read by its own header. Rows that do not match it go to ``quarantine_path`` by delivery, or
    are left out where there is none. A micro-batch that is repeated after a failure has the same number and the same
    files, so it overwrites its own rows only.
    """
    arrivals = (spark.readStream.format("binaryFile").schema(_LISTING).option("maxFilesPerTrigger", files_per_delivery)
                .load(landing).select("path"))

    def replace(batch: DataFrame, number: int) -> None:
        files = feed_files(batch)
        if not files:
            return
        bound = bind_feed(spark, files, columns)
        write_snapshots(accepted(bound, columns).withColumn(DELIVERY, F.lit(number)), bronze_path, by=(SNAPSHOT, DELIVERY))
        if quarantine_path:
            (rejected(bound).withColumn(DELIVERY, F.lit(number)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(DELIVERY).parquet(quarantine_path))

    return (arrivals.writeStream.foreachBatch(replace)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def quarantined(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """What the deliveries so far had rejected."""
    return read_snapshots(spark, quarantine_path, text_schema([FILE, REASON, RECORD]).add(DELIVERY, T.IntegerType()))


def landed(spark: SparkSession, columns: Sequence[str], bronze_path: str) -> DataFrame:
    """What has landed so far: the union of all deliveries."""
    schema = text_schema(columns).add(DELIVERY, T.IntegerType())
    return read_snapshots(spark, bronze_path, schema).drop(DELIVERY)
