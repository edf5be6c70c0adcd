"""Monitoring end to end, history and report; published numbers of eleven records are typed in."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from riskmart import config
from riskmart.operators import checks, report
from riskmart.plans.monitoring import monitoring_records, monitoring_report
from riskmart.session import new_path
from riskmart.sources import history

NAN = float("nan")
APRIL = (290, 81, 54, 88, 0.7595573440643864, 0.5406547937065754)
MAY = (268, 74, 56, 93, 0.7730876408022294, 0.5369040373947243)
JUNE = (281, 62, 52, 103, 0.8219505313646196, 0.4837182811747803)
NONE = (0, 0, 0, 0, NAN, NAN)
RECORDS = [
    ("2024-06-01", "2025-11-07T17:09:15.788705", JUNE, 0.0),
    ("2024-07-01", "2025-11-08T02:15:50.992461", NONE, 1.380984602588345),
    ("2024-08-01", "2025-11-08T02:15:51.161978", NONE, 1.4965253055361638),
    ("2024-09-01", "2025-11-08T02:15:51.338970", NONE, 1.2913060736664301),
    ("2024-06-01", "2025-11-08T02:19:35.455342", JUNE, 0.0),
    ("2024-04-01", "2025-11-08T02:33:52.156842", APRIL, 0.0),
    ("2024-05-01", "2025-11-08T02:33:52.228301", MAY, 0.017756915667625606),
    ("2024-06-01", "2025-11-08T02:33:52.290380", JUNE, 0.040144473646522516),
    ("2024-04-01", "2025-11-08T07:10:01.112508", APRIL, 0.0),
    ("2024-05-01", "2025-11-08T07:10:01.171825", MAY, 0.017756915667625606),
    ("2024-06-01", "2025-11-08T07:10:01.231054", JUNE, 0.040144473646522516),
]
ALERTS = ["NO_PSI", "CRITICAL", "CRITICAL", "CRITICAL", "NO_PSI", "NO_PSI", "OK", "OK", "NO_PSI", "OK", "OK"]


def share(a, b):
    return a / b if b else NAN


def document():
    records = []
    for (day, at, (tn, fp, fn, tp, auc, loss), psi), alert in zip(RECORDS, ALERTS):
        passed = day == "2024-06-01"
        records.append({
            "snapshot_date": day, "model_name": "Boosted", "monitored_at": at,
            "metrics": {"accuracy": share(tn + tp, tn + fp + fn + tp), "precision": share(tp, tp + fp), "recall": share(tp, tp + fn),
                        "f1_score": share(2 * tp, 2 * tp + fp + fn), "threshold": 0.5, "auc_roc": auc, "log_loss": loss, "true_negatives": tn,
                        "false_positives": fp, "false_negatives": fn, "true_positives": tp, "psi": psi},
            "threshold_checks": {"auc_roc_check": auc >= 0.7, "precision_check": passed, "recall_check": auc >= 0.7, "f1_score_check": auc >= 0.7,
                                 "psi_warning": psi < 0.1, "psi_critical": psi < 0.2, "all_passed": passed, "alert_level": alert},
            "thresholds": {"auc_roc_min": 0.7}})
    return {"monitoring_history": records}


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("history")), "history.json")
    with open(path, "w") as f:
        json.dump(document(), f)
    return history.history_rows(history.import_history(spark, path))


def test_import_turns_nan_into_null(published):
    assert published.count() == 11
    july = published.where("snapshot_date = '2024-07-01'").first()
    assert july.auc_roc is None and july.accuracy is None and july.psi == pytest.approx(1.380984602588345)


@pytest.mark.parametrize("indent", [None, 2])
def test_a_document_is_read_by_many_tasks(spark, tmp_path, indent):
    """Byte ranges far smaller than a record, brackets and quotes in texts, several documents and further keys."""
    wanted = []
    for name in ("one", "two"):
        held = document()
        for k, record in enumerate(held["monitoring_history"]):
            record["model_name"] = rf'{name} }}]", {{[ \" \\ é{k}'
            wanted.append((record["snapshot_date"], record["model_name"], record["metrics"]["true_positives"], record["thresholds"]["auc_roc_min"]))
        whole = {"version": {"list": [1, 2, {"a": []}]}, **held, "models": [{"name": "x, y"}]}
        (tmp_path / f"{name}.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "empty.json").write_text('{"monitoring_history": []}')
    for size in (97, 1500, 1 << 20):
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        own.conf.set("spark.sql.files.openCostInBytes", "1")
        found = history.import_history(own, str(tmp_path))
        assert sorted((r.snapshot_date, r.model_name, r.metrics.true_positives, r.thresholds.auc_roc_min) for r in found.collect()) == sorted(wanted)


def test_checks_reproduce_published_alerts(published):
    metrics = published.select("monitored_at", "auc_roc", "precision", "recall", "f1_score", "psi", "check_alert_level", "check_all_passed")
    for r in checks.with_checks(metrics).collect():
        assert (r.alert_level, r.all_passed) == (r.check_alert_level, r.check_all_passed)


def test_published_report(published):
    rows = report.history_in_period(published, "2024-04-01", "2024-06-01")
    got = report.monitoring_summary(report.require_history(rows)).first()
    assert (str(got.first_snapshot), str(got.last_snapshot), got.records, got.model_name) == ("2024-04-01", "2024-06-01", 8, "Boosted")
    averages = (got.avg_auc_roc, got.avg_accuracy, got.avg_precision, got.avg_recall, got.avg_f1_score, got.avg_psi, got.pass_rate)
    assert [round(x, 4) for x in averages] == [0.7941, 0.7536, 0.5815, 0.6432, 0.6105, 0.0145, 50.0]
    latest = report.latest_metrics(rows).first()
    assert [round(latest[c], 4) for c in ("auc_roc", "accuracy", "precision", "recall", "f1_score", "psi")] == [0.8220, 0.7711, 0.6242, 0.6645, 0.6438, 0.0401]
    newest = report.latest_per_snapshot(rows)
    assert newest.count() == 3 and newest.where("snapshot_date = '2024-06-01'").first().monitored_at.startswith("2025-11-08T07")


def test_compliance_and_series(published):
    rates = {str(r.snapshot_date): (r.passed_checks, r.compliance_rate) for r in report.threshold_compliance(published).collect()}
    assert rates["2024-06-01"] == (4, 100.0) and rates["2024-04-01"] == (3, 75.0) and rates["2024-07-01"] == (0, 0.0)
    series = report.monitoring_series(published)
    assert series.count() == 11 * 11
    assert series.where("series = 'precision'").first().threshold == 0.6
    psi = series.where("series = 'psi'").first()
    assert (psi.warning, psi.threshold) == (0.1, 0.2)
    with pytest.raises(ValueError, match="2 monitoring records"):
        report.require_history(published.limit(1))


def test_retraining_and_degradation(published):
    latest = report.latest_per_snapshot(published)
    got = {str(r.snapshot_date): (r.repeated_failure, r.drifted, r.retrain) for r in checks.retrain_trigger(latest).collect()}
    assert got == {"2024-04-01": (False, False, False), "2024-05-01": (True, False, True), "2024-06-01": (False, False, False),
                   "2024-07-01": (False, True, True), "2024-08-01": (True, True, True), "2024-09-01": (True, True, True)}
    falling = latest.withColumn("auc_roc", F.when(F.col("snapshot_date") == "2024-06-01", 0.72).otherwise(F.col("auc_roc")))
    worse = {str(r.snapshot_date): r.degraded for r in checks.performance_degradation(falling).collect()}
    assert worse["2024-06-01"] and not worse["2024-05-01"] and not worse["2024-07-01"]


def test_even_sample(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    df = spark.createDataFrame([(d,) for d in days], "snapshot_date string")
    import numpy as np
    want = [days[i] for i in np.linspace(0, 29, 10, dtype=int)]
    assert [r.snapshot_date for r in report.even_period_sample(df).orderBy("position").collect()] == want
    assert report.even_period_sample(df.limit(4)).count() == 4
    assert report.even_period_sample(df.limit(0)).count() == 0


def test_best_model(spark):
    rows = [(1, "a", 0.7), (2, "b", 0.8), (3, "c", 0.8), (4, "d", NAN), (5, "e", None)]
    registry = spark.createDataFrame([(o, m, s, "auc_roc", v) for o, m, v in rows for s in ("validation", "test")],
                                     "ordinal int, model_name string, split string, metric string, value double")
    best = report.best_model(registry).first()
    assert (best.model_name, best.selection_score) == ("b", 0.8)
    assert report.best_model(registry, mode="min").first().model_name == "a"


def world(spark):
    scored = [(str(i), f"c{i}", (i % 10) / 10, m, f"2024-0{mo}-01") for m in ("one", "two") for mo in (1, 2, 3) for i in range(40)]
    predictions = spark.createDataFrame(scored, "loan_id string, Customer_ID string, prediction_proba double, model_name string, inference_date string")
    labels = [(str(i), f"c{i}", int(i % 10 > 4), "2024-07-01") for i in range(40)] + [("none", "none", 1, "2024-08-01")]
    return predictions, spark.createDataFrame(labels, "loan_id string, Customer_ID string, label int, day string").select(
        "loan_id", "Customer_ID", "label", F.to_date("day").alias("snapshot_date"))


def test_monitoring_cases(spark):
    got = {(r.model_name, str(r.snapshot_date)): r for r in monitoring_report(*world(spark)).collect()}
    assert len(got) == 6
    first = got["one", "2024-01-01"]
    assert (first.has_labels, first.auc_roc, first.true_positives, first.true_negatives, first.psi, first.alert_level, first.all_passed) == (
        True, 1.0, 20, 20, 0.0, "NO_PSI", True)
    empty = got["two", "2024-02-01"]
    assert (empty.has_labels, empty.accuracy, empty.psi, empty.alert_level, empty.psi_critical) == (True, None, None, "CRITICAL", False)
    unlabelled = got["two", "2024-03-01"]
    assert (unlabelled.has_labels, unlabelled.auc_roc, unlabelled.true_positives, unlabelled.psi, unlabelled.all_passed) == (False, None, 0, 0.0, False)


def test_monitoring_period_keeps_the_baseline(spark):
    predictions, labels = world(spark)
    moved = predictions.withColumn("prediction_proba", F.when(F.col("inference_date") == "2024-01-01", F.col("prediction_proba") / 2).otherwise(F.col("prediction_proba")))
    def psi(**options):
        return {(r.model_name, str(r.snapshot_date)): r.psi for r in monitoring_report(moved, labels, **options).collect()}
    whole, part = psi(), psi(period=("2024-03-01", "2024-03-01"))
    assert part == {k: v for k, v in whole.items() if k[1] == "2024-03-01"} and min(part.values()) > 0.2


def test_records_survive_the_history(spark):
    path, flat_path = new_path(spark, "history"), new_path(spark, "flat")
    records = monitoring_records(monitoring_report(*world(spark)))
    for _ in range(2):
        history.append_history(records, path)
    back = history.read_history(spark, path)
    assert back.count() == 12 and back.schema["metrics"].dataType["psi"].dataType.simpleString() == "double"
    rows = history.history_rows(back)
    assert report.latest_per_snapshot(rows).count() == 6
    history.write_flat(records, flat_path)
    columns = spark.read.parquet(flat_path).columns
    assert {"metric_auc_roc", "metric_true_positives", "check_all_passed", "check_alert_level"} < set(columns)
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows.collect() for v in r)
