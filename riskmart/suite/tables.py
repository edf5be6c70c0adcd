"""Mart inputs derived from the driver's tables (see FIXTURES.md). They grow with those tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmart import config
from riskmart.operators.gold import feature_store, label_store
from riskmart.operators.silver import (silver_attributes, silver_clickstream, silver_financials,
                                       silver_loan_daily)
from riskmart.plans.monitoring import monitoring_records, monitoring_report
from riskmart.session import new_path, written
from riskmart.sources.predictions import write_predictions
from riskmart.sources.snapshots import read_snapshots, union_all, write_feed, write_snapshots

SPLITS = {
    "train": ("1995-01-01", "1998-12-01"),
    "validation": ("1999-01-01", "1999-12-01"),
    "test": ("2000-01-01", "2000-12-01"),
    "oot": ("2001-01-01", "2001-08-01"),
}
FINANCIALS_PRESENT = ("Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_of_Loan",
                      "Total_EMI_per_month", "Monthly_Balance", "debt_to_income_ratio", "income_category")
COLUMNS = config.FeatureColumns(financials=FINANCIALS_PRESENT)
FEATURES = ("tenure", "loan_amt", "customer_age", "Annual_Income", "Monthly_Inhand_Salary",
            "Num_Bank_Accounts", "Num_of_Loan", "Total_EMI_per_month", "Monthly_Balance",
            "debt_to_income_ratio") + config.CLICK_FEATURES


_sources: dict[tuple, DataFrame] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _sources:
        _sources[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _sources[key]


_stored: dict[tuple, DataFrame] = {}


def stored(spark, sf_dir, name, build, by_snapshot: bool = False) -> DataFrame:
    """A derived table that later queries of the session read instead of deriving it again."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        if by_snapshot:
            df, path = build(), new_path(spark, name)
            write_snapshots(df, path)
            _stored[key] = read_snapshots(spark, path, df.schema)
        else:
            _stored[key] = written(build(), name)
    return _stored[key]


def loans(spark, sf_dir) -> DataFrame:
    """Eleven monthly instalments per order, some of them overdue."""
    start = F.expr("cast(date_trunc('month', o_orderdate) as date)")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", start.alias("d0"))
    panel = orders.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(10))))
    late = F.expr("case when i > 0 and (o_orderkey * 7 + o_custkey) % 5 = 0 "
                  "then least(i, cast(1 + o_orderkey % 4 as int)) else 0 end")
    part = F.col("o_totalprice") / 10
    return panel.withColumn("m", late).select(
        F.concat(F.lit("L"), F.col("o_orderkey").cast("string")).alias("loan_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("Customer_ID"),
        F.col("d0").alias("loan_start_date"), F.lit(10).alias("tenure"), F.col("i").alias("installment_num"),
        F.col("o_totalprice").alias("loan_amt"),
        F.when(F.col("i") == 0, 0.0).otherwise(part).alias("due_amt"),
        F.when((F.col("i") > 0) & (F.col("m") == 0), part).otherwise(0.0).alias("paid_amt"),
        F.when((F.col("o_orderkey") % 53 == 0) & (F.col("i") == 6), None)
         .otherwise(F.col("m") * part).alias("overdue_amt"),
        (F.col("o_totalprice") * (10 - F.col("i") + F.col("m")) / 10).alias("balance"),
        F.add_months("d0", F.col("i")).alias("snapshot_date"))


def _customer_dates(spark, sf_dir) -> DataFrame:
    """Customers with the month of their first order, written once for the three tables that start from it. Both sides have
    a row per customer, so neither is broadcast."""
    def build():
        first = (read(spark, sf_dir, "orders").groupBy("o_custkey")
                 .agg(F.expr("min(cast(date_trunc('month', o_orderdate) as date))").alias("snapshot_date")))
        joined = read(spark, sf_dir, "customer").join(first.hint("merge"), F.col("c_custkey") == F.col("o_custkey"))
        return joined.select("c_custkey", "c_name", "c_acctbal", "snapshot_date")
    return stored(spark, sf_dir, "customer-dates", build)


def attributes(spark, sf_dir) -> DataFrame:
    """One dirty row per customer, at the month of the customer's first order."""
    return _customer_dates(spark, sf_dir).selectExpr(
        "concat('C', cast(c_custkey as string)) as Customer_ID", "c_name as Name",
        """case when c_custkey % 39 = 0 then '-500' when c_custkey % 41 = 0 then '8678_'
                when c_custkey % 20 = 0 then concat(cast(15 + c_custkey % 55 as string), '_')
                else cast(15 + c_custkey % 55 as string) end as Age""",
        """case when c_custkey % 18 = 0 then '#F%$D@*&8'
                else concat('900-00-', cast(1000 + c_custkey % 9000 as string)) end as SSN""",
        """case c_custkey % 8 when 0 then 'Engineer' when 1 then 'Doctor' when 2 then 'Manager'
                when 3 then 'Teacher' when 4 then '_______' when 5 then 'Media_Manager' when 6 then 'Lawyer'
                else 'Scientist' end as Occupation""",
        "snapshot_date")


def financials(spark, sf_dir) -> DataFrame:
    """Text numbers with stray underscores, a lone underscore, a decimal count, a balance placeholder."""
    return _customer_dates(spark, sf_dir).selectExpr(
        "concat('C', cast(c_custkey as string)) as Customer_ID",
        """case when c_custkey % 17 = 0 then concat(cast(cast(floor(c_acctbal * 15) as int) as string), '_')
                else cast(cast(floor(c_acctbal * 15) as int) as string) end as Annual_Income""",
        """case when c_custkey % 23 = 0 then null
                else cast(cast(floor(c_acctbal) as int) as string) end as Monthly_Inhand_Salary""",
        "cast(c_custkey % 11 as string) as Num_Bank_Accounts",
        """case when c_custkey % 19 = 0 then '_' when c_custkey % 13 = 0 then concat(cast(c_custkey % 9 as string), '.0')
                else concat(cast(c_custkey % 9 as string), '_') end as Num_of_Loan""",
        """case when c_custkey % 29 = 0 then '__-333333333333333333333333333__'
                else cast(cast(floor(c_acctbal) as int) as string) end as Monthly_Balance""",
        "cast(c_custkey % 400 as string) as Total_EMI_per_month", "snapshot_date")


def clickstream(spark, sf_dir) -> DataFrame:
    """Mean event values of the customers that have events; the others have no row."""
    means = [F.expr(f"avg(case when event_id % 20 = {k - 1} then value end) as fe_{k}") for k in range(1, 21)]
    users = read(spark, sf_dir, "events").groupBy("user_id").agg(*means)
    dates = _customer_dates(spark, sf_dir).select("c_custkey", "snapshot_date")
    return users.join(dates.hint("merge"), F.col("user_id") == F.col("c_custkey")).select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("Customer_ID"),
        *config.CLICK_FEATURES, "snapshot_date")


def silver_loans(spark, sf_dir) -> DataFrame:
    return silver_loan_daily(loans(spark, sf_dir))


def features(spark, sf_dir) -> DataFrame:
    return feature_store(silver_loans(spark, sf_dir), silver_attributes(attributes(spark, sf_dir)),
                         silver_financials(financials(spark, sf_dir)),
                         silver_clickstream(clickstream(spark, sf_dir)), columns=COLUMNS)


def labels(spark, sf_dir) -> DataFrame:
    return label_store(silver_loans(spark, sf_dir))


def gold_features(spark, sf_dir) -> DataFrame:
    """The feature store as a stored table, as training and scoring find it."""
    return stored(spark, sf_dir, "feature-store", lambda: features(spark, sf_dir), by_snapshot=True)


def gold_labels(spark, sf_dir) -> DataFrame:
    return stored(spark, sf_dir, "label-store", lambda: labels(spark, sf_dir), by_snapshot=True)


_LABEL = "case when (event_id * 37 + user_id * 11) % 10 < 3 then 1 else 0 end"


def scores(spark, sf_dir) -> DataFrame:
    """Scores with their truth; one snapshot per day of events."""
    return read(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) as loan_id", "cast(user_id as string) as Customer_ID",
        "value / (value + 50.0D) as prediction", f"{_LABEL} as label", "cast(ts as date) as snapshot_date")


# some of alpha's scores are undefined, as those of a model that failed on a row
_ALPHA = ("case when event_id % 997 = 5 then double('NaN') when event_id % 991 = 7 then null "
          "else value / (value + 50.0D) end")


def predictions(spark, sf_dir) -> DataFrame:
    """Two models' predictions: one ignorant of the truth, one that leans towards it."""
    events = read(spark, sf_dir, "events")
    models = F.array(
        F.struct(F.lit("alpha").alias("model_name"), F.expr(_ALPHA).alias("prediction_proba")),
        F.struct(F.lit("beta").alias("model_name"),
                 F.expr(f"0.3D * {_LABEL} + 0.7D * ((event_id * 7919) % 1000 / 1000.0D)").alias("prediction_proba")))
    return events.select(
        F.col("event_id").cast("string").alias("loan_id"), F.col("user_id").cast("string").alias("Customer_ID"),
        F.date_format("ts", "yyyy-MM-dd").alias("inference_date"), F.inline(models))


def feeds(spark, sf_dir) -> dict[str, tuple[str, list[str]]]:
    """The four raw CSV feeds, written once per session: path and columns."""
    key = (spark.sparkContext.applicationId, sf_dir, "feeds")
    if key not in _stored:
        found = {}
        for name, build in (("loan_daily", loans), ("attributes", attributes), ("financials", financials), ("clickstream", clickstream)):
            rows, path = build(spark, sf_dir), new_path(spark, f"feed-{name}")
            write_feed(rows, path)
            found[name] = (path, rows.columns)
        _stored[key] = found
    return _stored[key]


def mixed_feed(spark, sf_dir) -> str:
    """The loan feed as several systems deliver it: plain files, files with their columns backwards and in capitals, files
    without the balance, files with a further column; rows cut short, rows with a cell too many, and files whose header
    names a column twice. Written once per session; returns its folder."""
    key = (spark.sparkContext.applicationId, sf_dir, "mixed-feed")
    if key not in _stored:
        path = new_path(spark, "mixed-feed")
        rows = loans(spark, sf_dir).withColumn("k", F.expr("cast(substr(loan_id, 2) as bigint)"))
        names = [c for c in rows.columns if c != "k"]
        kind = F.expr("case when k % 29 = 0 then 'short' when k % 31 = 0 then 'long' when k % 37 = 0 then 'twice' "
                      "else cast(k % 4 as string) end")
        rows = rows.withColumn("kind", kind)
        cells = {"0": names, "1": [F.col(c).alias(c.upper()) for c in reversed(names)], "2": [c for c in names if c != "balance"],
                 "3": [*names[:3], F.concat(F.lit("branch "), F.col("k") % 7).alias("branch"), *names[3:]]}
        for own, columns in cells.items():
            write_feed(rows.where(F.col("kind") == own).select(*columns), f"{path}/kind={own}")
        text = [F.col(c).cast("string") for c in names]
        lines = {"short": (names, F.array_join(F.array(*text[:5]), ",", "")), "long": (names, F.array_join(F.array(*text, F.lit("x")), ",", "")),
                 "twice": ([*names[:-1], names[0]], F.array_join(F.array(*text), ",", ""))}
        for own, (header, line) in lines.items():  # one column without quotes, whose name is the header
            (rows.where(F.col("kind") == own).select(line.alias(",".join(header)))
             .write.csv(f"{path}/kind={own}", header=True, sep="\u0001", quote="\u0000"))
        _stored[key] = path
    return _stored[key]


def stored_predictions(spark, sf_dir) -> DataFrame:
    """The predictions as the partitioned table that scoring writes."""
    def build():
        rows, path = predictions(spark, sf_dir), new_path(spark, "predictions-table")
        write_predictions(rows, path)
        return read_snapshots(spark, path, rows.schema)
    key = (spark.sparkContext.applicationId, sf_dir, "predictions-table")
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def observed_labels(spark, sf_dir) -> DataFrame:
    """Truth six months on. Loans that ended in an error never get a label, and the last days have
    none yet."""
    labelled = read(spark, sf_dir, "events").where("event_type <> 'error' and cast(ts as date) <= date'2024-01-25'")
    return labelled.selectExpr(
        "cast(event_id as string) as loan_id", "cast(user_id as string) as Customer_ID", f"{_LABEL} as label",
        "add_months(cast(ts as date), 6) as snapshot_date")


def document_scores(spark, sf_dir) -> DataFrame:
    """Length-based scores of labelled documents: unbalanced truth, one global group."""
    length = F.expr("n_chars / (n_chars + 2000.0D)")
    return (read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
            .select("doc_id", length.alias("prediction"), F.col("quality").alias("label")))


def vectors(spark, sf_dir) -> DataFrame:
    """Embedding components as features, a binary label, and a split by identifier."""
    part = F.col("vec_id") % 10
    split = F.when(part <= 6, "train").when(part <= 8, "validation").otherwise("test")
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("loan_id"), split.alias("split"),
        (F.col("label") < 3).cast("int").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(f"x_{i + 1}") for i in range(64)])


VECTOR_FEATURES = [f"x_{i + 1}" for i in range(64)]

def report(spark, sf_dir) -> DataFrame:
    return monitoring_report(predictions(spark, sf_dir), observed_labels(spark, sf_dir))


def records(spark, sf_dir) -> DataFrame:
    """Monitoring records of all snapshots, and a later re-run of the even days."""
    rows = report(spark, sf_dir)
    first = monitoring_records(rows, monitored_at=F.date_format("snapshot_date", "yyyy-MM-dd'T'08:00:00"))
    again = monitoring_records(rows.where(F.dayofmonth("snapshot_date") % 2 == 0),
                               monitored_at=F.date_format("snapshot_date", "yyyy-MM-dd'T'20:00:00"))
    return stored(spark, sf_dir, "records", lambda: union_all(first, again))
