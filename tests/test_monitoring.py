"""Periods, models side by side, schedules, empty overlaps."""

import re

import pytest
from pyspark.sql import functions as F

from riskmart.operators import checks, report
from riskmart.plans import monitoring
from riskmart.session import new_path
from riskmart.sources.predictions import write_predictions
from riskmart.sources.snapshots import read_snapshots


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.range(600).selectExpr(
        "cast(id as string) loan_id", "cast(id % 40 as string) Customer_ID", "(id * 37 % 101) / 101D prediction_proba",
        "if(id % 2 = 0, 'a', 'b') model_name", "date_format(add_months(date'2024-01-01', cast(id % 6 as int)), 'yyyy-MM-dd') inference_date")
    path = new_path(spark, "predictions")
    write_predictions(rows, path)
    labels = rows.selectExpr("loan_id", "Customer_ID", "cast(cast(loan_id as int) % 3 = 0 as int) label",
                             "add_months(to_date(inference_date), 6) snapshot_date")
    return read_snapshots(spark, path, rows.schema), labels


def test_period_equals_cut_of_whole(tables):
    whole = monitoring.monitoring_report(*tables).where("snapshot_date between date'2024-03-01' and date'2024-04-01'")
    part = monitoring.monitoring_report(*tables, period=("2024-03-01", "2024-04-01"))
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect())) and part.count() == 2


def test_period_reads_its_partitions_only(tables):
    plan = monitoring.monitoring_report(*tables, period=("2024-03-01", "2024-04-01"))._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in re.findall(r"FileScan parquet.*", plan) if "prediction" in s]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*inference_date", s) for s in scans)


def test_latest_metrics_of_models_with_equal_times(spark):
    columns = ["snapshot_date", "model_name", "monitored_at", *report.REPORTED]
    rows = [("2024-01-01", m, "t", *[v] * len(report.REPORTED)) for m, v in (("beta", 0.2), ("alpha", 0.1))]
    for order in (rows, rows[::-1]):
        got = report.latest_metrics(spark.createDataFrame(order, columns)).collect()
        assert {r.model_name: r.auc_roc for r in got} == {"alpha": 0.1, "beta": 0.2}


def test_schedule(spark):
    days = [f"2024-{m:02d}-01" for m in (1, 2, 3, 4, 7, 8)]
    rows = spark.createDataFrame([("m", d, 0.9, 0.9, 0.9, 0.9, 0.0) for d in days],
                                 "model_name string, d string, auc_roc double, precision double, recall double, f1_score double, psi double")
    rows = rows.withColumn("snapshot_date", F.to_date("d"))
    got = {str(r.snapshot_date): r.scheduled for r in checks.retrain_trigger(rows, every_months=2).collect()}
    assert [got[d] for d in days] == [False, False, True, False, True, False]
    assert "scheduled" not in checks.retrain_trigger(rows).columns


def test_degradation_from_validation_score(spark):
    history = spark.createDataFrame([("m", "2024-01-01", 0.8), ("m", "2024-02-01", 0.75), ("n", "2024-01-01", 0.5)], "model_name string, snapshot_date string, auc_roc double")
    registry = spark.createDataFrame([("m", "validation", "auc_roc", 0.8), ("m", "test", "auc_roc", 0.1)], "model_name string, split string, metric string, value double")
    got = {(r.model_name, r.snapshot_date): (r.baseline, r.degraded) for r in checks.performance_degradation(history, registry=registry).collect()}
    assert got == {("m", "2024-01-01"): (0.8, False), ("m", "2024-02-01"): (0.8, True), ("n", "2024-01-01"): (None, False)}


def test_empty_overlap_shows_keys(tables):
    predictions, labels = tables
    assert monitoring.empty_overlap_keys(predictions, labels, monitoring.monitoring_report(predictions, labels)).count() == 0
    other = labels.withColumn("loan_id", F.when(F.month("snapshot_date") == 8, F.concat(F.lit("x"), "loan_id")).otherwise(F.col("loan_id")))
    found = monitoring.empty_overlap_keys(predictions, other, monitoring.monitoring_report(predictions, other), n=2).collect()
    assert sorted({r.side for r in found}) == ["labels", "predictions"] and len(found) == 4
