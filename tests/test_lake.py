"""Feeds, partitioned tables, readiness, predictions, quality."""

import os
import time

import pytest
from pyspark.sql import functions as F

from riskmart.functions.dates import range_calendar, snapshot_tag, tag_date
from riskmart.operators import quality, readiness
from riskmart.plans.monitoring import join_labels, prediction_snapshots, unmatched_keys
from riskmart.session import MART_SETTINGS, new_path, scratch, shared_dir, tune, written
from riskmart.sources import predictions, snapshots
from riskmart.streaming.landing import land_feed, landed


def rows(spark, data):
    return spark.createDataFrame(data, "k string, v int, snapshot_date string").withColumn("snapshot_date", F.to_date("snapshot_date"))


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_overwrite_replaces_only_its_partitions(spark):
    path = new_path(spark, "test")
    first = rows(spark, [("a", 1, "2023-01-01"), ("b", 2, "2023-02-01")])
    for _ in range(2):
        snapshots.write_snapshots(first, path)
    snapshots.write_snapshots(rows(spark, [("c", 3, "2023-02-01")]), path)
    table = snapshots.read_snapshots(spark, path, first.schema)
    assert {(r.k, str(r.snapshot_date)) for r in table.collect()} == {("a", "2023-01-01"), ("c", "2023-02-01")}
    assert snapshots.at_snapshot(table, "2023-02-01").count() == 1
    closed = snapshots.in_range(table, "2023-01-01", "2023-02-01")
    assert closed.count() == 2
    plan = snapshots.at_snapshot(table, "2023-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_hot_partition_is_written_by_several_tasks(spark):
    """Rebalancing splits a snapshot that holds a third of the rows."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    try:
        df = spark.range(90000, numPartitions=6).select(
            F.sha2(F.col("id").cast("string"), 256).alias("k"),
            F.when(F.col("id") % 3 == 0, "2023-01-01").otherwise(F.concat(F.lit("2023-"), F.lpad((2 + F.col("id") % 10).cast("string"), 2, "0"), F.lit("-01"))).alias("snapshot_date"))
        path = new_path(spark, "hot")
        snapshots.write_snapshots(df, path)
        files = [f for f in os.listdir(f"{path}/snapshot_date=2023-01-01") if f.endswith(".parquet")]
        assert len(files) > 1
        assert spark.read.parquet(path).count() == 90000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_feed_keeps_text_as_it_is(spark):
    path = new_path(spark, "feed")
    snapshots.write_feed(spark.createDataFrame([("C1", "41_", "#F%$D@*&8"), ("C2", "007", None)], "Customer_ID string, Age string, SSN string"), path)
    got = {tuple(r) for r in snapshots.read_feed(spark, path, ["Customer_ID", "Age", "SSN"]).collect()}
    assert got == {("C1", "41_", "#F%$D@*&8"), ("C2", "007", None)}


def test_range_of_text_dates_survives_dirt(spark):
    raw = spark.createDataFrame([("2023-01-01",), ("not a date",), (None,), ("2023-03-01",)], "snapshot_date string")
    assert [r.snapshot_date for r in snapshots.in_range(raw, "2023-01-01", "2023-02-01").collect()] == ["2023-01-01"]
    assert snapshots.at_snapshot(raw, "2023-03-01").count() == 1


def test_landing_reads_each_delivery_once(spark):
    landing, bronze, checkpoint = (new_path(spark, n) for n in ("landing", "bronze", "progress"))
    columns = ["k", "v", "snapshot_date"]
    for day, value in (("2023-01-01", "1"), ("2023-02-01", "2_")):
        spark.createDataFrame([("a", value, day)], "k string, v string, snapshot_date string").write.mode("append").csv(landing, header=True)
        land_feed(spark, landing, columns, bronze, checkpoint).awaitTermination()
    land_feed(spark, landing, columns, bronze, checkpoint).awaitTermination()
    table = landed(spark, columns, bronze)
    assert {tuple(r[c] for c in columns) for r in table.collect()} == {("a", "1", "2023-01-01"), ("a", "2_", "2023-02-01")}
    spark.createDataFrame([("b", "3", "2023-02-01"), ("c", "4", "2023-02-01")], "k string, v string, snapshot_date string").write.mode("append").csv(landing, header=True)
    land_feed(spark, landing, columns, bronze, checkpoint).awaitTermination()
    assert sorted(r.k for r in landed(spark, columns, bronze).where("snapshot_date = '2023-02-01'").collect()) == ["a", "b", "c"]


def test_covered_range_is_emptied(spark):
    path = new_path(spark, "test")
    first = rows(spark, [(f"k{m}", m, f"2023-{m:02d}-01") for m in (1, 2, 3, 4)])
    snapshots.write_snapshots(first, path)
    snapshots.write_snapshots(rows(spark, [("new", 9, "2023-03-01")]), path, covered=("2023-02-01", "2023-03-01"))
    table = snapshots.read_snapshots(spark, path, first.schema)
    assert {(r.k, str(r.snapshot_date)) for r in table.collect()} == {("k1", "2023-01-01"), ("new", "2023-03-01"), ("k4", "2023-04-01")}
    snapshots.write_snapshots(first.limit(0), path, covered=("2023-04-01", "2023-04-01"))
    assert snapshots.read_snapshots(spark, path, first.schema).count() == 2


class _Context:
    """As much of a context as choosing the folder looks at."""

    applicationId = "app-1"

    def __init__(self, master, folder=None):
        self.master, self._folder = master, folder

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self._folder


class _Session:
    def __init__(self, *context):
        self.sparkContext = _Context(*context)
        self.conf = self

    def get(self, _key, default=None):
        return default


def test_several_machines_need_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("local-cluster[2,1,1024]"))
    assert shared_dir(_Session("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"


def test_scratch_tables_go(spark):
    import os
    with scratch(spark):
        held = written(spark.range(3), "gone")
        path = held.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert held.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_tune_keeps_what_the_session_sets(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        tune(spark)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, before)


def test_union_fills_absent_columns(spark):
    both = snapshots.union_all(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string"))
    assert {tuple(r) for r in both.collect()} == {(1, None), (None, "x")}


def test_tags_and_calendar(spark):
    df = spark.createDataFrame([("/x/predictions_My_Model_2024_05_01.parquet",), ("no date",)], "f string")
    assert [str(r.d) for r in df.select(tag_date(F.col("f")).alias("d")).collect()] == ["2024-05-01", "None"]
    assert spark.range(1).select(snapshot_tag(F.to_date(F.lit("2024-05-01")))).first()[0] == "2024_05_01"
    months = [str(r.month) for r in range_calendar(spark, "2023-11-17", "2024-02-01").collect()]
    assert months == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]


def test_readiness(spark):
    splits = {"train": ("2023-01-01", "2023-02-01"), "validation": ("2023-03-01", "2023-03-01"), "test": ("2023-04-01", "2023-04-01"),
              "oot": ("2023-05-01", "2023-05-01")}
    features = rows(spark, [("a", 1, f"2023-{m:02d}-01") for m in (1, 2, 3, 5)])
    labels = rows(spark, [("a", 1, f"2023-{m:02d}-01") for m in (7, 8, 9, 10)])
    got = {(r.store, str(r.month)) for r in readiness.training_readiness(features, labels, splits).collect()}
    assert got == {("feature_store", "2023-04-01")}
    assert {(r.store, str(r.month)) for r in readiness.oot_readiness(features, labels, splits).collect()} == {("label_store", "2023-11-01")}
    same_date = readiness.oot_readiness(features, labels, splits, offset=0).collect()
    assert {(r.store, str(r.month)) for r in same_date} == {("label_store", "2023-05-01")}
    assert [str(r.month) for r in readiness.missing_snapshots(features, "2023-01-01", "2023-06-01").orderBy("month").collect()] == ["2023-04-01", "2023-06-01"]


def test_prediction_names_and_resolution(spark):
    with pytest.raises(ValueError, match="prediction"):
        predictions.normalised(spark.createDataFrame([(1,)], "x int"))
    rows_ = spark.createDataFrame([
        ("1", "zeta", 0.1, "2024-01-01"), ("1", "best", 0.2, "2024-01-01"), ("1", None, 0.3, "2024-01-01"),
        ("1", "zeta", 0.4, "2024-02-01"), ("1", "best", 0.5, "2024-02-01"), ("1", "zeta", 0.6, "2024-03-01"), ("1", "alpha", 0.7, "2024-03-01")],
        "loan_id string, model_name string, prediction_proba double, inference_date string")
    got = {r.inference_date: r.prediction for r in predictions.resolve(rows_, "best").collect()}
    assert got == {"2024-01-01": 0.3, "2024-02-01": 0.5, "2024-03-01": 0.7}


def test_label_join_keys(spark):
    scored = spark.createDataFrame([("1", "c", 0.5, "2024-01-31")], "loan_id string, Customer_ID string, prediction double, inference_date string")
    labels = rows(spark, [("x", 1, "2024-07-31")]).select(F.lit("1").alias("loan_id"), F.col("v").alias("label"), "snapshot_date")
    joined = join_labels(prediction_snapshots(scored), labels).first()
    assert (joined.label, joined.model_name) == (1, "Unknown")
    with pytest.raises(ValueError, match="share none"):
        join_labels(prediction_snapshots(scored), labels.drop("loan_id"))
    other = labels.withColumn("loan_id", F.lit("2"))
    assert {(r.side, r.loan_id) for r in unmatched_keys(scored, other).collect()} == {("predictions", "1"), ("labels", "2")}


def test_quality_profiles(spark):
    df = spark.createDataFrame([("C1", "41_", 1.0), ("C1", " 7 ", None), (None, "", float("nan")), (None, "x", 2.0)], "id string, n string, f double")
    missing = [(r.column_name, r.missing_count, r.missing_percentage) for r in quality.missing_values(df).collect()]
    assert missing == [("f", 2, 50.0), ("id", 2, 50.0)]
    assert [tuple(r) for r in quality.non_numeric(df, ["n", "absent"]).collect()] == [("n", 2)]
    assert [(r.value, r["rank"]) for r in quality.non_numeric_samples(df, ["n"], 1).collect()] == [("41_", 1)]
    assert quality.duplicate_count(df, ["id"]).first().duplicates == 2
    assert quality.duplicate_count(df.limit(0), ["id"]).first().duplicates == 0
    assert {(r.column_name, r.data_type, r.row_count) for r in quality.shape(df).collect()} == {("id", "string", 4), ("n", "string", 4), ("f", "double", 4)}
    lost = {r.column_name: (r.present, r.lost) for r in quality.cast_losses(df, {"n": "int"}, ["n"]).collect()}
    assert lost == {"n": (4, 2)}


def test_samples_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a_",)], "n string")
    plan = quality.non_numeric_samples(df, ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_package_is_shipped_once_by_whatever_threads_and_operators_ask():
    from concurrent.futures import ThreadPoolExecutor
    from time import sleep
    from types import SimpleNamespace

    from riskmart.llm import common
    from riskmart.session import ship

    sent = []

    def add(path):
        sleep(0.1)
        sent.append(path)

    fake = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-of-its-own", addPyFile=add))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda f: f(fake), [ship, common.ship, ship, common.ship]))
    assert len(sent) == 1


def test_feed_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "_FEED_ROWS", 400)
    path = new_path(spark, "feed")
    snapshots.write_feed(spark.range(0, 1000, 1, 1).selectExpr("cast(id as string) as k", "'the same words in every row' as words"), path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    back = snapshots.read_feed(spark, path, ["k", "words"])
    assert back.count() == 1000 and back.select("k").distinct().count() == 1000


def test_shuffle_files_of_a_write_go_when_it_ends(spark):
    own = tune(spark.newSession(), MART_SETTINGS)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f.getName() for f in (held.apply(i) for held in [blocks.getAllFiles().toIndexedSeq()] for i in range(held.size()))
                if f.getName().startswith("shuffle_")}
    before, path = files(), new_path(spark, "tidy")
    snapshots.write_snapshots(own.range(1000).selectExpr("id", "cast(date'2023-01-01' + cast(id % 3 as int) as date) as snapshot_date"), path)
    until = time.time() + 20  # the removal is asked for, not awaited
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert own.read.parquet(path).count() == 1000
    assert all(f.endswith(".zstd.parquet") or not f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)
