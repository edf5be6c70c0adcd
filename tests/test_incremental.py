"""Incremental monitoring: the same reports, and what is read for them."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.plans import incremental, monitoring
from riskmart.plans.incremental import State
from riskmart.session import new_path
from riskmart.sources.predictions import write_predictions
from riskmart.sources.snapshots import read_snapshots, write_snapshots


def prediction_frame(spark, where="true"):
    return spark.range(900).selectExpr(
        "id", "cast(id as string) loan_id", "cast(id % 40 as string) Customer_ID",
        "case when id % 97 = 0 then double('NaN') when id % 89 = 1 then null else (id * 37 % 11) / 11D end prediction_proba",
        "if(id % 7 < 3, 'a', 'b') model_name", "date_format(add_months(date'2024-01-31', cast(id % 6 as int)), 'yyyy-MM-dd') inference_date").where(where)


@pytest.fixture
def tables(spark):
    rows, path, label_path = prediction_frame(spark), new_path(spark, "predictions"), new_path(spark, "labels")
    write_predictions(rows.drop("id"), path)
    labels = rows.selectExpr("loan_id", "Customer_ID", "case when id % 50 = 7 then 2 else cast(id % 4 = 0 as int) end label",
                             "add_months(to_date(inference_date), 6) snapshot_date").where("cast(loan_id as int) % 5 > 0")
    labels = labels.unionByName(labels.where("cast(loan_id as int) % 31 = 2"))  # some labels twice
    write_snapshots(labels, label_path)
    return read_snapshots(spark, path, rows.drop("id").schema), read_snapshots(spark, label_path, labels.schema)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_reports_equal_the_full_ones_as_labels_arrive(spark, tables):
    predictions, labels = tables
    state, seen = State(new_path(spark, "state")), []
    for until in ("2024-06-30", "2024-08-29", "2024-09-30", "2024-12-31"):
        known = labels.where(f"snapshot_date <= date'{until}'")
        seen.append(incremental.update(predictions, known, state))
        assert rows_of(incremental.report(spark, state)) == rows_of(monitoring.monitoring_report(predictions, known))
    assert len(seen[0]) == 6 * 2 and incremental.update(predictions, labels, state) == []
    assert {d for _, d in seen[1]} == {date(2024, 1, 31), date(2024, 2, 29)} and {d for _, d in seen[2]} == {date(2024, 3, 31)}
    period = ("2024-03-01", "2024-05-01")
    assert rows_of(incremental.report(spark, state, period)) == rows_of(monitoring.monitoring_report(predictions, labels, period=period))


def test_a_month_of_labels_reads_one_snapshot(spark, tables):
    predictions, labels = tables
    state = State(new_path(spark, "state"))
    incremental.update(predictions, labels.where("snapshot_date <= date'2024-08-31'"), state)
    more = labels.where("snapshot_date <= date'2024-09-30'")
    found = incremental.due(predictions, more, state)
    assert found == [("a", date(2024, 3, 31), True), ("b", date(2024, 3, 31), True)]
    plan = incremental.counted(predictions, more, [f[:2] for f in found])
    read = {re.search(r"(inference_date|snapshot_date)=([0-9-]+)", f).groups() for f in plan.inputFiles()}
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*", text)
    assert len(scans) == 2 and read
    assert any("inference_date#" in s and "2024-03-31" in s for s in scans) and any("19996" in s or "2024-09-30" in s for s in scans)
    assert all("PartitionFilters: [" in s and "PartitionFilters: []" not in s for s in scans)


def test_state_is_asked_for_partitions_only(spark, tables):
    predictions, labels = tables
    scored = monitoring.prediction_snapshots(predictions).select(*monitoring.KEYS).distinct()
    assert "ReadSchema: struct<>" in scored._jdf.queryExecution().executedPlan().toString()


def test_snapshots_written_anew_and_new_ones(spark, tables):
    predictions, labels = tables
    state = State(new_path(spark, "state"))
    first = predictions.where("inference_date < '2024-05-01'")
    assert len(incremental.update(first, labels, state)) == 8
    assert {d for _, d in incremental.update(predictions, labels, state)} == {date(2024, 5, 31), date(2024, 6, 30)}
    changed = labels.withColumn("label", F.when(F.col("snapshot_date") == F.lit("2024-08-29").cast("date"), 1 - F.col("label")).otherwise(F.col("label")))
    assert incremental.update(predictions, changed, state) == []
    assert {d for _, d in incremental.update(predictions, changed, state, again=["2024-02-29"])} == {date(2024, 2, 29)}
    assert rows_of(incremental.report(spark, state)) == rows_of(monitoring.monitoring_report(predictions, changed))


def test_a_run_that_ends_early_is_done_again(spark, tables, monkeypatch):
    predictions, labels = tables
    state, write, calls = State(new_path(spark, "state")), incremental.write_snapshots, []

    def once(df, path, **options):
        calls.append(path)
        if path == state.status:
            raise RuntimeError("lost")
        write(df, path, **options)
    monkeypatch.setattr(incremental, "write_snapshots", once)
    with pytest.raises(RuntimeError, match="lost"):
        incremental.update(predictions, labels, state)
    monkeypatch.setattr(incremental, "write_snapshots", write)
    assert len(incremental.update(predictions, labels, state)) == 12
    assert rows_of(incremental.report(spark, state)) == rows_of(monitoring.monitoring_report(predictions, labels))


def test_empty_overlap_is_explained(spark, tables):
    predictions, labels = tables
    shown, samples = incremental.monitor(predictions, labels, State(new_path(spark, "state")))
    assert samples is None and shown.count() == 12
    other = labels.withColumn("loan_id", F.when(F.month("snapshot_date") == 8, F.concat(F.lit("x"), "loan_id")).otherwise(F.col("loan_id")))
    shown, samples = incremental.monitor(predictions, other, State(new_path(spark, "state")))
    assert {r.side for r in samples.collect()} == {"labels", "predictions"}
    empty = shown.where("has_labels and snapshot_date = date'2024-02-29'").collect()
    assert len(empty) == 2 and all(r.auc_roc is None and r.true_positives == 0 for r in empty)


def test_nothing_to_monitor(spark, tables):
    predictions, labels = tables
    shown, samples = incremental.monitor(predictions.limit(0), labels, State(new_path(spark, "state")))
    assert shown.collect() == [] and samples is None
