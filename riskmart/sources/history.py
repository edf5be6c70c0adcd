"""Monitoring records: nested JSON sink, flat Parquet sink, append-only history."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from riskmart.functions.cleaning import nan_to_null
from riskmart.session import ship
from riskmart.sources.snapshots import write_snapshots

METRICS = ("accuracy", "precision", "recall", "f1_score", "threshold", "auc_roc", "log_loss")
COUNTS = ("true_negatives", "false_positives", "false_negatives", "true_positives")
CHECKS = ("auc_roc_check", "precision_check", "recall_check", "f1_score_check",
          "psi_warning", "psi_critical", "all_passed")
KEYS = ("snapshot_date", "model_name", "monitored_at")


def _struct(names, kind) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


RECORD_SCHEMA = T.StructType(_struct(KEYS, T.StringType()) + [
    T.StructField("metrics", T.StructType(
        _struct(METRICS, T.DoubleType()) + _struct(COUNTS, T.LongType()) + _struct(("psi",), T.DoubleType()))),
    T.StructField("threshold_checks", T.StructType(
        _struct(CHECKS, T.BooleanType()) + _struct(("alert_level",), T.StringType()))),
    T.StructField("thresholds", T.StructType(_struct(
        ("auc_roc_min", "precision_min", "recall_min", "f1_score_min", "psi_warning", "psi_critical",
         "performance_degradation_threshold"), T.DoubleType()))),
])


def flat(records: DataFrame) -> DataFrame:
    """One column per metric (``metric_*``) and check (``check_*``), then the record's keys."""
    return records.select(
        *[F.col(f"metrics.{c}").alias(f"metric_{c}") for c in records.schema["metrics"].dataType.names],
        *[F.col(f"threshold_checks.{c}").alias(f"check_{c}")
          for c in records.schema["threshold_checks"].dataType.names],
        *KEYS)


def history_rows(records: DataFrame) -> DataFrame:
    """Flat history: metrics under their own names, checks prefixed, NaN as null."""
    fields = records.schema["metrics"].dataType.fields

    def metric(f):
        source = F.col(f"metrics.{f.name}")
        return (nan_to_null(source) if isinstance(f.dataType, T.DoubleType) else source).alias(f.name)

    return records.select(
        F.to_date("snapshot_date").alias("snapshot_date"), "model_name", "monitored_at",
        *[metric(f) for f in fields],
        *[F.col(f"threshold_checks.{c}").alias(f"check_{c}")
          for c in records.schema["threshold_checks"].dataType.names])


def append_history(records: DataFrame, path: str) -> None:
    """Append records as JSON lines. There is no key: a re-run adds its records again."""
    records.write.mode("append").json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Records of an append-only history."""
    return spark.read.schema(RECORD_SCHEMA).json(path)


_MARKS = re.compile(r'\\.|["{}\[\]]')
_DEPTH = {"{": 1, "[": 1, "}": -1, "]": -1}
#: Depth of a record: inside the document, its list, and its own braces.
_RECORD = 3


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    """(file, start, text) of each byte range, its comma-separated pieces put together again."""
    held, key = [], None
    for batch in batches:
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value"))):
            if (file, start) != key:
                if key:
                    yield *key, ",".join(held)
                held, key = [], (file, start)
            held.append(value)
    if key:
        yield *key, ",".join(held)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per byte range how far its brackets go in, counted as if it began outside of a string and inside of one, and whether
    it has an odd number of quotes."""
    for file, start, text in _splits(batches):
        inside, depth = False, [0, 0]
        for mark in _MARKS.finditer(text):
            if mark[0] == '"':
                inside = not inside
            else:
                depth[inside] += _DEPTH.get(mark[0], 0)
        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "outside": [depth[0]], "within": [depth[1]], "odd": [inside]})


def _cut(begins: dict[tuple[str, int], tuple[int, bool]]):
    def run(batches):
        for file, start, text in _splits(batches):
            depth, inside = begins[file, start]
            first, whole, open_ = 0 if depth >= _RECORD else None, [], depth >= _RECORD
            parts = []
            for mark in _MARKS.finditer(text):
                if mark[0] == '"':
                    inside = not inside
                elif not inside and mark[0] in _DEPTH:
                    depth += _DEPTH[mark[0]]
                    if mark[0] == "{" and depth == _RECORD:
                        first = mark.start()
                    elif mark[0] == "}" and depth == _RECORD - 1 and first is not None:
                        (parts if open_ else whole).append(("end" if open_ else "whole", text[first:mark.end()]))
                        first, open_ = None, False
            if first is not None:
                parts.append(("middle" if open_ else "begin", text[first:]))
            rows = whole + parts
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), pa.array([start] * len(rows), pa.int64()),
                                              *[pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]],
                                             names=["file", "start", "kind", "text"])
    return run


def import_history(spark: SparkSession, path: str) -> DataFrame:
    """Records of history documents that hold their list under ``monitoring_history``.

    A document is one JSON value, but it is read in byte ranges by many tasks: a first pass measures how deep each range
    goes, so that the second knows in which depth each begins and cuts out whole records; a record that ranges share is
    put together from its parts, of which a range has two at most. The driver gets a row per range. NaN stays NaN here and
    is null in ``history_rows``. The document must have no other list of objects at that depth with the keys of a record.
    """
    ship(spark)
    pieces = spark.read.text(path, lineSep=",", recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    measured = pieces.mapInArrow(_measured, "file string, start long, outside long, within long, odd boolean").collect()
    begins, last, depth, inside = {}, None, 0, False
    for r in sorted(measured, key=lambda r: (r["file"], r["start"])):
        if r["file"] != last:
            last, depth, inside = r["file"], 0, False
        begins[r["file"], r["start"]] = depth, inside
        depth, inside = depth + (r["within"] if inside else r["outside"]), inside ^ r["odd"]
    cut = pieces.mapInArrow(_cut(begins), "file string, start long, kind string, text string")
    upto = Window.partitionBy("file").orderBy("start", F.expr("kind = 'begin'"))  # two rows of a range at most
    parts = cut.where("kind <> 'whole'").withColumn("record", F.sum(F.expr("int(kind = 'begin')")).over(upto))
    joined = parts.groupBy("file", "record").agg(F.array_join(F.array_sort(F.collect_list(F.struct("start", "text"))).getField("text"), ",").alias("text"))
    texts = cut.where("kind = 'whole'").select("text").unionByName(joined.select("text"))
    return (texts.select(F.from_json("text", RECORD_SCHEMA, {"allowNonNumericNumbers": "true"}).alias("r")).select("r.*")
            .where("snapshot_date is not null and model_name is not null"))


def write_records(records: DataFrame, path: str) -> None:
    """Nested records as JSON, one partition per model and snapshot; a re-run replaces its own."""
    write_snapshots(records, path, by=("model_name", "snapshot_date"), file_format="json")


def write_flat(records: DataFrame, path: str) -> None:
    """Flat Parquet records, one partition per model and snapshot."""
    write_snapshots(flat(records), path, by=("model_name", "snapshot_date"))
