"""Feature store, label store, training sets, skewed keys."""

import pytest
from pyspark.sql import functions as F

from riskmart import config
from riskmart.operators.gold import feature_store, label_store
from riskmart.operators.prep import inference_matrix, require_labels, resolve_features, train_matrix, training_set, with_rolling_split, with_split

COLUMNS = config.FeatureColumns(financials=("Annual_Income",), clickstream=("fe_1",))


def loans(spark, rows):
    df = spark.createDataFrame(rows, "loan_id string, Customer_ID string, snapshot_date string, mob int, dpd int")
    return df.select("loan_id", "Customer_ID", F.to_date("snapshot_date").alias("snapshot_date"), "mob", "dpd",
                     F.to_date("snapshot_date").alias("loan_start_date"), F.lit(10).alias("tenure"), F.lit(1.0).alias("loan_amt"),
                     F.lit(5.0).alias("balance"), F.lit(0.0).alias("overdue_amt"))


def sides(spark, keys):
    keyed = spark.createDataFrame(keys, "Customer_ID string, day string").select("Customer_ID", F.to_date("day").alias("snapshot_date"))
    people = keyed.select("*", F.lit(30).alias("Age"), F.lit("Doctor").alias("Occupation"), F.lit("25-34").alias("age_group"),
                          F.lit("Professional").alias("occupation_category"), F.lit("n").alias("Name"), F.lit("s").alias("SSN"))
    return people, keyed.withColumn("Annual_Income", F.lit(1.0)), keyed.withColumn("fe_1", F.lit(2.0))


def test_feature_store_is_point_in_time(spark):
    base = loans(spark, [("L1", "C1", "2023-01-01", 0, 0), ("L2", "C1", "2023-02-01", 0, 0), ("L3", "C1", "2023-01-01", 1, 0),
                         ("L4", None, "2023-01-01", 0, 0)])
    got = feature_store(base, *sides(spark, [("C1", "2023-01-01"), (None, "2023-01-01")]), columns=COLUMNS)
    assert {(r.loan_id, r.customer_age, r.fe_1) for r in got.collect()} == {("L1", 30, 2.0), ("L2", None, None), ("L4", None, None)}
    assert not set(got.columns) & {"Name", "SSN", "balance", "overdue_amt", "mob", "dpd", "installment_num", "due_amt", "paid_amt"}


def test_repeated_right_rows_fan_out(spark):
    base = loans(spark, [("L1", "C1", "2023-01-01", 0, 0)])
    got = feature_store(base, *sides(spark, [("C1", "2023-01-01")] * 2), columns=COLUMNS)
    assert got.count() == 8


def test_hot_customer_is_split_over_tasks(spark):
    """A third of the loans belong to one customer: every row survives, and the joins split the key."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(60000, numPartitions=8)
        customer = F.when(F.col("id") % 3 == 0, F.lit("C0")).otherwise(F.concat(F.lit("C"), F.col("id")))
        base = ids.select(F.concat(F.lit("L"), F.col("id")).alias("loan_id"), customer.alias("Customer_ID"),
                          F.to_date(F.lit("2023-01-01")).alias("snapshot_date"), F.lit(0).alias("mob"), F.lit(0).alias("dpd"),
                          F.to_date(F.lit("2023-01-01")).alias("loan_start_date"), F.lit(1).alias("tenure"), F.lit(1.0).alias("loan_amt"))
        keyed = base.select("Customer_ID", "snapshot_date").distinct()
        people = keyed.select("*", F.lit(30).alias("Age"), F.lit("Doctor").alias("Occupation"), F.lit("25-34").alias("age_group"),
                              F.lit("Professional").alias("occupation_category"))
        store = feature_store(base, people, keyed.withColumn("Annual_Income", F.lit(1.0)),
                              keyed.withColumn("fe_1", F.lit(2.0)), columns=COLUMNS)
        rows = store.agg(F.count("*").alias("n"), F.count("customer_age").alias("a"), F.count("fe_1").alias("f"),
                         F.countDistinct("loan_id").alias("d"))
        got = rows.collect()[0]
        assert tuple(got) == (60000, 60000, 60000, 60000)
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_label_store(spark):
    got = label_store(loans(spark, [("a", "C", "2023-07-01", 6, 29), ("b", "C", "2023-07-01", 6, 30),
                                    ("c", "C", "2023-07-01", 6, None), ("d", "C", "2023-07-01", 5, 90)]))
    assert {(r.loan_id, r.label, r.label_def) for r in got.collect()} == {("a", 0, "30dpd_6mob"), ("b", 1, "30dpd_6mob"), ("c", 0, "30dpd_6mob")}
    other = label_store(loans(spark, [("a", "C", "2023-07-01", 3, 60)]), dpd=60, mob=3).first()
    assert (other.label, other.label_def) == (1, "60dpd_3mob")


SPLITS = {"train": ("2023-01-01", "2023-02-01"), "validation": ("2023-03-01", "2023-03-01"), "test": ("2023-04-01", "2023-04-01")}


def dated(spark, rows, extra=""):
    df = spark.createDataFrame(rows, f"loan_id string, day string{extra}")
    return df.withColumn("snapshot_date", F.to_date("day")).drop("day")


def test_training_set_alignment(spark):
    features = dated(spark, [("a", "2023-01-01"), ("b", "2023-02-01"), ("c", "2023-03-01"), ("d", "2023-04-01"), ("e", "2023-05-01")])
    labels = dated(spark, [("a", "2023-08-01", 1), ("b", "2023-08-01", 0), ("c", "2023-08-01", 1), ("d", "2023-10-01", 0)], ", label int")
    got = {(r.loan_id, r.split, r.label) for r in training_set(features, labels, SPLITS).collect()}
    assert got == {("a", "train", 1), ("b", "train", 0), ("d", "test", 0)}
    strict = {r.loan_id for r in training_set(features, labels, SPLITS, align_months=True).collect()}
    assert strict == {"b", "d"}
    left = {(r.loan_id, r.label) for r in training_set(features, labels, SPLITS, how="left").collect()}
    assert left == {("a", 1), ("b", 0), ("c", None), ("d", 0)}
    with pytest.raises(ValueError, match="validation"):
        require_labels(training_set(features, labels, SPLITS))


def test_splits(spark):
    df = dated(spark, [("a", f"2023-{m:02d}-01") for m in range(1, 13)])
    assert {r.split: r["count"] for r in with_split(df, SPLITS).groupBy("split").count().collect()} == {"train": 2, "validation": 1, "test": 1}
    rolling = with_rolling_split(df, {"train": 3, "validation": 2, "test": 1})
    assert {r.split: r["count"] for r in rolling.groupBy("split").count().collect()} == {"train": 3, "validation": 2, "test": 1}
    assert str(rolling.where("split = 'train'").agg(F.min("snapshot_date")).first()[0]) == "2023-07-01"


def test_matrices(spark):
    df = spark.createDataFrame([("L", "C", "2023-01-01", "x", float("inf"), 3)], "loan_id string, Customer_ID string, snapshot_date string, a string, b double, c int")
    assert resolve_features(df, ("c", "zz", "a")) == (["c", "a"], ["zz"])
    row = inference_matrix(df, ["c", "zz", "a", "b"]).first()
    assert tuple(row)[3:] == (3.0, None, None, None)
    with pytest.raises(ValueError, match="Customer_ID"):
        inference_matrix(df.drop("Customer_ID"), ["a"])
    labelled = df.withColumns({"split": F.lit("train"), "label": F.lit(1)})
    assert train_matrix(labelled, ("c", "zz", "b")).columns == ["loan_id", "split", "label", "c", "b"]


def test_no_input_of_the_feature_store_passes_the_driver(spark):
    """Small files may hold many customers, so their size alone is no reason to broadcast them."""
    base = loans(spark, [("L1", "C1", "2023-01-01", 0, 0), ("L2", "C2", "2023-01-01", 0, 0)])
    got = feature_store(base, *sides(spark, [("C1", "2023-01-01")]), columns=COLUMNS)
    assert {(r.loan_id, r.fe_1) for r in got.collect()} == {("L1", 2.0), ("L2", None)}
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_training_set_broadcasts_no_labels(spark):
    """Labels have a row per loan; their small files would pass the driver many times as large."""
    features = spark.createDataFrame([("L1", "2023-01-01"), ("L2", "2023-02-01")], "loan_id string, d string").selectExpr("loan_id", "date(d) as snapshot_date")
    labels = spark.createDataFrame([("L1", 1, "2023-07-01")], "loan_id string, label int, d string").selectExpr("loan_id", "label", "date(d) as snapshot_date")
    for how, n in (("inner", 1), ("left", 2)):
        joined = training_set(features, labels, how=how)
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == n
