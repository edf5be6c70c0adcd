"""The registered queries: each binds one operator to the driver's tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskmart import config
from riskmart.functions.cleaning import nan_to_null
from riskmart.functions.dates import month_calendar, snapshot_tag, tag_date
from riskmart.operators import checks, drift, metrics, models, prep, quality, readiness, report, silver, stats
from riskmart.operators.imputer import MedianImputer, MedianImputerModel
from riskmart.operators.trees import HistogramTrees
from riskmart.plans import incremental, medallion, monitoring, scoring, training
from riskmart.session import MART_SETTINGS, new_path, tune, written
from riskmart.sources import feeds, history, predictions as prediction_table, registry, snapshots
from riskmart.sources.versions import VersionedTable
from riskmart.suite import tables

REGISTRY = {}


def presented(df: DataFrame) -> DataFrame:
    """Result columns in a form both engines print alike: dates as text, floats as doubles, doubles
    to six places."""
    def show(f: T.StructField) -> str:
        c = f"`{f.name}`"
        if isinstance(f.dataType, T.DateType):
            return f"date_format({c}, 'yyyy-MM-dd') as {c}"
        if isinstance(f.dataType, T.FloatType):
            return f"double({c}) as {c}"
        if isinstance(f.dataType, T.DoubleType):
            return f"round({c}, 6) + 0D as {c}"
        return c
    return df.selectExpr(*[show(f) for f in df.schema.fields])


def query(f):
    def operator(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(tune(spark, MART_SETTINGS), sf_dir)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(operator(spark, sf_dir))

    run.operator = operator
    run.__name__ = f.__name__
    run.__doc__ = f.__doc__
    REGISTRY[f.__name__] = run
    return f


# --- lake -------------------------------------------------------------------------------------

LOAN_COLUMNS = list(config.LOAN_TYPES)
_AMOUNTS = ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")


def _loan_feed(spark, sf_dir) -> DataFrame:
    path = new_path(spark, "loan-feed")
    snapshots.write_feed(tables.loans(spark, sf_dir), path)
    return snapshots.read_feed(spark, path, LOAN_COLUMNS)


@query
def bronze_snapshot(spark, sf_dir):
    """Raw CSV feed, one snapshot of it."""
    rows = snapshots.at_snapshot(_loan_feed(spark, sf_dir), "1998-06-01")
    return rows.select("loan_id", "Customer_ID", "loan_start_date", "installment_num", "snapshot_date",
                       *[F.col(c).cast("double").alias(c) for c in _AMOUNTS])


@query
def bronze_roundtrip(spark, sf_dir):
    """CSV feed -> partitioned bronze -> rows and sums per snapshot."""
    path = new_path(spark, "bronze")
    snapshots.write_snapshots(_loan_feed(spark, sf_dir), path)
    bronze = snapshots.read_snapshots(spark, path, snapshots.text_schema(LOAN_COLUMNS))
    return bronze.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.countDistinct("loan_id").alias("loan_count"),
        F.sum(F.round(F.col("balance").cast("double") * 1000).cast("bigint")).alias("balance_mills"),
        F.count("overdue_amt").alias("overdue_present"))


@query
def bronze_reordered(spark, sf_dir):
    """A feed of files with different headers, bound by name: what lands per snapshot."""
    bound = feeds.bind_feed(spark, tables.mixed_feed(spark, sf_dir), LOAN_COLUMNS)
    landed = bound.where(F.col(feeds.REASON).isNull())
    return landed.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.countDistinct("loan_id", "Customer_ID").alias("loan_count"),
        F.sum(F.col("installment_num").cast("int")).alias("installments"), F.count("balance").alias("with_balance"),
        F.sum(F.round(F.col("balance").cast("double") * 1000).cast("bigint")).alias("balance_mills"),
        F.count(feeds.RESCUED).alias("rescued"), F.max(F.get_json_object(feeds.RESCUED, "$.branch")).alias("last_branch"))


@query
def bronze_quarantine(spark, sf_dir):
    """Rows of the same feed that do not match their header, by reason, with the loans they speak of."""
    rows = feeds.rejected(feeds.bind_feed(spark, tables.mixed_feed(spark, sf_dir), LOAN_COLUMNS))
    return rows.groupBy(feeds.REASON).agg(
        F.count("*").alias("n_rows"), F.countDistinct(F.split(feeds.RECORD, ",")[0]).alias("n_loans"),
        F.sum(F.size(F.split(feeds.RECORD, ","))).alias("n_cells"))


@query
def overwrite_idempotent(spark, sf_dir):
    """Writing a year again, with other rows, replaces that year and leaves the rest."""
    return _rerun(spark, sf_dir, "true")


def _rerun(spark, sf_dir, kept, covered=None):
    path = new_path(spark, "silver")
    loans = tables.silver_loans(spark, sf_dir)
    snapshots.write_snapshots(loans, path)
    year = snapshots.in_range(loans, "1997-01-01", "1997-12-01").withColumn("dpd", F.expr("cast(dpd + 1000 as int)"))
    snapshots.write_snapshots(year.where(kept), path, covered=covered)
    again = snapshots.read_snapshots(spark, path, loans.schema)
    return again.groupBy("snapshot_date").agg(F.count("*").alias("row_count"), F.sum("dpd").alias("dpd_sum"))


@query
def rerun_covered_range(spark, sf_dir):
    """A re-run of a year in which one month has no rows any more empties that month."""
    return _rerun(spark, sf_dir, "snapshot_date <> date'1997-03-01'", ("1997-01-01", "1997-12-01"))


@query
def atomic_rerun(spark, sf_dir):
    """The same re-run in a versioned table: rows per snapshot before and after it."""
    loans = tables.silver_loans(spark, sf_dir)
    held = VersionedTable(spark, new_path(spark, "versioned"), loans.schema)
    held.replace(loans)
    year = snapshots.in_range(loans, "1997-01-01", "1997-12-01").where("snapshot_date <> date'1997-03-01'")
    held.replace(year.where("mob % 2 = 0"), covered=("1997-01-01", "1997-12-01"))
    return held.counts()


@query
def snapshot_row_counts(spark, sf_dir):
    return quality.snapshot_counts(tables.loans(spark, sf_dir))


@query
def union_snapshots(spark, sf_dir):
    """Feature rows and label rows in one frame, columns aligned by name."""
    both = snapshots.union_all(tables.features(spark, sf_dir).select("loan_id", "snapshot_date", "loan_amt"),
                               tables.labels(spark, sf_dir).select("loan_id", "snapshot_date", "label"))
    return both.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.count("loan_amt").alias("feature_rows"),
        F.count("label").alias("label_rows"))


@query
def snapshot_tag_roundtrip(spark, sf_dir):
    days = tables.loans(spark, sf_dir).select("snapshot_date").distinct()
    named = days.withColumn("file_name", F.concat(F.lit("predictions_alpha_"), snapshot_tag(F.col("snapshot_date")), F.lit(".parquet")))
    return named.withColumn("parsed_date", tag_date(F.col("file_name")))


@query
def month_calendar_span(spark, sf_dir):
    return month_calendar(tables.loans(spark, sf_dir))


@query
def missing_snapshots(spark, sf_dir):
    """Months of a range in which no loan starts."""
    return readiness.missing_snapshots(tables.gold_features(spark, sf_dir), "1994-09-01", "2001-12-01")


@query
def training_readiness(spark, sf_dir):
    splits = {**tables.SPLITS, "train": ("1994-10-15", "1998-12-01"), "test": ("2000-01-01", "2002-03-01")}
    return readiness.training_readiness(tables.gold_features(spark, sf_dir), tables.gold_labels(spark, sf_dir), splits)


@query
def oot_readiness(spark, sf_dir):
    splits = {"oot": ("2001-06-01", "2001-12-01")}
    return readiness.oot_readiness(tables.gold_features(spark, sf_dir), tables.gold_labels(spark, sf_dir), splits)


# --- silver and gold --------------------------------------------------------------------------

@query
def silver_loan_daily(spark, sf_dir):
    return tables.silver_loans(spark, sf_dir)


@query
def silver_attributes(spark, sf_dir):
    return silver.silver_attributes(tables.attributes(spark, sf_dir))


@query
def silver_financials(spark, sf_dir):
    return silver.silver_financials(tables.financials(spark, sf_dir))


@query
def silver_clickstream(spark, sf_dir):
    return silver.silver_clickstream(tables.clickstream(spark, sf_dir))


@query
def feature_store(spark, sf_dir):
    return tables.features(spark, sf_dir)


@query
def label_store(spark, sf_dir):
    return tables.labels(spark, sf_dir)


@query
def label_distribution(spark, sf_dir):
    return tables.labels(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n_rows")).orderBy("label")


@query
def default_rate(spark, sf_dir):
    """Defaults per snapshot of the label store."""
    return tables.labels(spark, sf_dir).groupBy("snapshot_date").agg(
        F.count("label").alias("n_rows"), F.sum("label").alias("defaults"), F.avg("label").alias("default_rate"))


@query
def medallion_backfill(spark, sf_dir):
    """Four raw CSV feeds through bronze, silver and gold; what the gold tables then hold per snapshot."""
    built = medallion.backfill(spark, medallion.Mart(new_path(spark, "mart")), tables.feeds(spark, sf_dir), tables.COLUMNS)
    cents = F.expr("cast(sum(cast(round(cast(loan_amt as double) * 100) as bigint)) as bigint)")
    features = built["feature_store"].groupBy("snapshot_date").agg(
        F.count("*").alias("feature_rows"), F.count("customer_age").alias("with_age"),
        F.count("Annual_Income").alias("with_income"), cents.alias("amount_cents"),
        F.sum("customer_age").alias("age_sum"), F.count_if(F.col("age_group").isNotNull()).alias("with_band"),
        F.sum("Num_of_Loan").alias("loan_count_sum"),
        F.expr("cast(sum(cast(round(cast(fe_1 as double) * 100) as bigint)) as bigint)").alias("fe_1_cents"))
    labels = built["label_store"].groupBy("snapshot_date").agg(
        F.count("*").alias("label_rows"), F.sum("label").alias("defaults"))
    return features.join(labels, "snapshot_date", "full")


@query
def medallion_counts(spark, sf_dir):
    """What each write of a build put into its table, as counted while writing."""
    log: list[medallion.Written] = []
    medallion.backfill(spark, medallion.Mart(new_path(spark, "mart")), tables.feeds(spark, sf_dir), tables.COLUMNS, log=log)
    rows = [(w.layer, w.table, w.n_rows, w.undated, w.first, w.last) for w in log]
    return spark.createDataFrame(rows, "layer string, table_name string, n_rows long, undated long, first_day string, last_day string")


# --- data quality -----------------------------------------------------------------------------

@query
def cast_report(spark, sf_dir):
    return quality.cast_losses(tables.financials(spark, sf_dir), config.FINANCIAL_TYPES, config.FINANCIAL_DIRTY)


@query
def dq_missing(spark, sf_dir):
    return quality.missing_values(tables.gold_features(spark, sf_dir))


@query
def dq_non_numeric(spark, sf_dir):
    return quality.non_numeric(tables.attributes(spark, sf_dir), config.NUMERIC_ATTRIBUTES).unionByName(
        quality.non_numeric(tables.financials(spark, sf_dir), config.NUMERIC_FINANCIALS))


@query
def dq_non_numeric_samples(spark, sf_dir):
    return quality.non_numeric_samples(tables.financials(spark, sf_dir), config.NUMERIC_FINANCIALS)


@query
def dq_duplicates(spark, sf_dir):
    def of(name, df, keys):
        return quality.duplicate_count(df, keys).select(F.lit(name).alias("check_name"), "duplicates")
    loans, people = tables.loans(spark, sf_dir), tables.attributes(spark, sf_dir)
    return (of("attributes by customer", people, ["Customer_ID"])
            .unionByName(of("loans by loan and snapshot", loans, ["loan_id", "snapshot_date"]))
            .unionByName(of("loans by loan", loans, ["loan_id"]))
            .unionByName(of("loans by customer and snapshot", loans, ["Customer_ID", "snapshot_date"])))


@query
def dq_shape(spark, sf_dir):
    return quality.shape(tables.financials(spark, sf_dir)).select("column_name", "position", "data_type", "row_count")


# --- preparation ------------------------------------------------------------------------------

@query
def split_features(spark, sf_dir):
    """Feature rows of one closed range of snapshots."""
    rows = snapshots.in_range(tables.gold_features(spark, sf_dir), *tables.SPLITS["validation"])
    return rows.select("loan_id", "Customer_ID", "snapshot_date", "loan_amt", "customer_age", "Annual_Income")


@query
def temporal_split_counts(spark, sf_dir):
    split = prep.with_split(tables.silver_loans(spark, sf_dir).where("mob = 0"), tables.SPLITS)
    return split.groupBy("split").agg(F.count("*").alias("n_rows"), F.min("snapshot_date").alias("first_day"),
                                      F.max("snapshot_date").alias("last_day"))


@query
def rolling_split_counts(spark, sf_dir):
    split = prep.with_rolling_split(tables.silver_loans(spark, sf_dir).where("mob = 0"))
    return split.groupBy("split").agg(F.count("*").alias("n_rows"), F.min("snapshot_date").alias("first_day"),
                                      F.max("snapshot_date").alias("last_day"))


def _training(spark, sf_dir, **options):
    return prep.training_set(tables.gold_features(spark, sf_dir), tables.gold_labels(spark, sf_dir), tables.SPLITS, **options)


@query
def training_set(spark, sf_dir):
    return _training(spark, sf_dir).select("loan_id", "split", "snapshot_date", "loan_amt", "Annual_Income", "label")


@query
def training_set_aligned(spark, sf_dir):
    return _training(spark, sf_dir, align_months=True).groupBy("split", "snapshot_date").agg(
        F.count("*").alias("n_rows"), F.sum("label").alias("defaults"))


@query
def training_set_left(spark, sf_dir):
    """Loans without a label stay, here with labels of one month too early a window."""
    rows = _training(spark, sf_dir, how="left", label_offset=4)
    return rows.groupBy("split", "snapshot_date").agg(
        F.count("*").alias("n_rows"), F.count("label").alias("labelled"), F.sum("label").alias("defaults"))


@query
def train_matrix(spark, sf_dir):
    return prep.train_matrix(_training(spark, sf_dir))


@query
def inference_matrix(spark, sf_dir):
    return prep.inference_matrix(tables.gold_features(spark, sf_dir), ("Interest_Rate",) + tables.FEATURES)


@query
def feature_medians(spark, sf_dir):
    """Exact medians of every feature in every snapshot."""
    return stats.exact_medians(tables.gold_features(spark, sf_dir), tables.FEATURES, ["snapshot_date"])


@query
def imputed_features(spark, sf_dir):
    """Scoring matrix, missing values filled per snapshot."""
    rows = written(prep.inference_matrix(tables.gold_features(spark, sf_dir), tables.FEATURES), "matrix")
    return stats.impute_scoring(rows, tables.FEATURES, ["snapshot_date"])


def _imputed_training(spark, sf_dir):
    matrix = written(prep.train_matrix(_training(spark, sf_dir), tables.FEATURES), "matrix")  # read once per pass
    return stats.impute_training(matrix, tables.FEATURES, ["split"])


@query
def imputed_training_features(spark, sf_dir):
    return _imputed_training(spark, sf_dir)


def _imputed_by(spark, sf_dir, scope, groups, rows):
    """Rows filled by a fitted imputer that was saved and loaded again."""
    train = _training(spark, sf_dir).where("split = 'train'")
    fitted = MedianImputer(inputCols=list(tables.FEATURES), scope=scope, groupCols=groups).fit(train)
    path = new_path(spark, "imputer")
    fitted.save(path)
    return MedianImputerModel.load(path).transform(rows)


@query
def imputed_train_scope(spark, sf_dir):
    """All splits, missing values filled by the medians of the training split."""
    rows = written(prep.train_matrix(_training(spark, sf_dir), tables.FEATURES), "matrix")
    return _imputed_by(spark, sf_dir, "train", [], rows)


@query
def imputed_batch_scope(spark, sf_dir):
    """Scoring matrix filled per snapshot, and by the training medians where a snapshot has no value."""
    rows = prep.inference_matrix(tables.gold_features(spark, sf_dir), tables.FEATURES)
    lacking = F.when(F.month("snapshot_date") != 5, F.col("Monthly_Inhand_Salary"))  # nobody's is known in May
    return _imputed_by(spark, sf_dir, "batch", ["snapshot_date"], written(rows.withColumn("Monthly_Inhand_Salary", lacking), "matrix"))


@query
def scaler_stats(spark, sf_dir):
    return stats.scaler_stats(_imputed_training(spark, sf_dir).where("split = 'train'"), tables.FEATURES)


@query
def scaled_features(spark, sf_dir):
    """All splits, scaled by the training split."""
    rows = written(_imputed_training(spark, sf_dir), "imputed")
    return stats.standardise(rows, rows.where("split = 'train'"), tables.FEATURES)


@query
def class_weights(spark, sf_dir):
    return stats.class_weights(_training(spark, sf_dir).where("split = 'train'"))


# --- predictions against labels ---------------------------------------------------------------

DAY = ["snapshot_date"]


@query
def score_output(spark, sf_dir):
    """Scored rows written to the partitioned predictions table and read back."""
    rows = prediction_table.prediction_rows(tables.scores(spark, sf_dir), "alpha", proba="prediction")
    path = new_path(spark, "predictions")
    prediction_table.write_predictions(rows, path)
    return snapshots.read_snapshots(spark, path, rows.schema).drop("inference_timestamp")


@query
def resolve_predictions(spark, sf_dir):
    """Every third day has unnamed predictions, every second day lacks the best model."""
    rows = tables.predictions(spark, sf_dir)
    day = F.dayofmonth(F.to_date("inference_date"))
    unnamed = rows.where((F.col("model_name") == "alpha") & (day % 3 == 0)).withColumn("model_name", F.lit(None).cast("string"))
    named = rows.where((F.col("model_name") == "alpha") | (day % 2 == 1))
    chosen = prediction_table.resolve(named.unionByName(unnamed), best_model="beta")
    return chosen.groupBy("inference_date", F.coalesce("model_name", F.lit("unnamed")).alias("model_name")).agg(
        F.count("*").alias("n_rows"), F.avg(nan_to_null(F.col("prediction"))).alias("mean_prediction"))


@query
def aligned_label_join(spark, sf_dir):
    joined = monitoring.join_labels(tables.scores(spark, sf_dir).drop("label"), tables.observed_labels(spark, sf_dir))
    return joined.groupBy("snapshot_date", "label_date").agg(
        F.count("*").alias("n_rows"), F.sum("label").alias("defaults"))


@query
def prediction_label_join(spark, sf_dir):
    joined = monitoring.join_labels(monitoring.prediction_snapshots(tables.predictions(spark, sf_dir)),
                                    tables.observed_labels(spark, sf_dir))
    return joined.select("loan_id", "Customer_ID", "model_name", "snapshot_date",
                         nan_to_null(F.col("prediction")).alias("prediction"), "label")


@query
def unmatched_keys(spark, sf_dir):
    return monitoring.unmatched_keys(tables.scores(spark, sf_dir), tables.observed_labels(spark, sf_dir))


@query
def predicted_rates(spark, sf_dir):
    return metrics.predicted_rates(tables.scores(spark, sf_dir), DAY)


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(tables.scores(spark, sf_dir), DAY)


@query
def classification_metrics(spark, sf_dir):
    return metrics.with_rates(metrics.confusion_matrix(tables.scores(spark, sf_dir), DAY))


@query
def log_loss(spark, sf_dir):
    return metrics.log_loss(tables.scores(spark, sf_dir), DAY)


@query
def auc_by_snapshot(spark, sf_dir):
    return metrics.auc(tables.scores(spark, sf_dir), DAY)


@query
def auc_with_ties(spark, sf_dir):
    rows = tables.scores(spark, sf_dir).withColumn("prediction", F.floor(F.col("prediction") * 10) / 10)
    return metrics.auc(rows, DAY)


@query
def auc(spark, sf_dir):
    return metrics.auc(tables.document_scores(spark, sf_dir))


@query
def log_loss_documents(spark, sf_dir):
    return metrics.log_loss(tables.document_scores(spark, sf_dir))


@query
def classification_metrics_documents(spark, sf_dir):
    return metrics.with_rates(metrics.confusion_matrix(tables.document_scores(spark, sf_dir)))


@query
def evaluate_models(spark, sf_dir):
    """All metrics of both models over all days, in one pass."""
    joined = monitoring.join_labels(monitoring.prediction_snapshots(tables.predictions(spark, sf_dir)),
                                    tables.observed_labels(spark, sf_dir))
    return metrics.evaluate(joined, ["model_name"]).drop("bins", "n_rows")


@query
def psi_bins(spark, sf_dir):
    return drift.histogram_bins(drift.score_histogram(tables.scores(spark, sf_dir), DAY), DAY)


@query
def psi_by_snapshot(spark, sf_dir):
    return drift.psi_by_snapshot(tables.scores(spark, sf_dir))


@query
def score_density(spark, sf_dir):
    return drift.score_density(tables.scores(spark, sf_dir))


# --- monitoring -------------------------------------------------------------------------------

@query
def monitoring_report(spark, sf_dir):
    return tables.report(spark, sf_dir)


@query
def monitoring_period(spark, sf_dir):
    """One period of the stored predictions table against the baseline of all."""
    stored = tables.stored_predictions(spark, sf_dir)
    return monitoring.monitoring_report(stored, tables.observed_labels(spark, sf_dir), period=("2024-01-10", "2024-01-15"))


@query
def monitoring_incremental(spark, sf_dir):
    """The same report from a state that was brought up to date twice: with the labels of the first days, then with all."""
    stored, labels = tables.stored_predictions(spark, sf_dir), tables.observed_labels(spark, sf_dir)
    state = incremental.State(new_path(spark, "score-state"))
    incremental.update(stored, labels.where("snapshot_date <= date'2024-07-12'"), state)
    return incremental.monitor(stored, labels, state)[0]


@query
def threshold_checks(spark, sf_dir):
    """Checks with an index of 0 reported as OK."""
    rows = tables.report(spark, sf_dir)
    measured = rows.select(*monitoring.KEYS, *config.Thresholds().floors, "psi")
    return checks.with_checks(measured, strict_psi=True)


@query
def monitoring_flat(spark, sf_dir):
    """Nested records of two runs written as flat Parquet, the second in place of the first, and read back."""
    path = new_path(spark, "monitoring")
    first, again = _two_runs(spark, sf_dir)
    history.write_flat(first, path)
    history.write_flat(again, path)
    return snapshots.read_snapshots(spark, path, history.flat(first).schema)


def _two_runs(spark, sf_dir):
    records = tables.records(spark, sf_dir)
    return [records.where(f"monitored_at like '%{time}'") for time in ("T08:00:00", "T20:00:00")]


def _history(spark, sf_dir):
    """Records appended in two runs to the history, read back flat."""
    def build():
        path = new_path(spark, "history")
        for records in _two_runs(spark, sf_dir):
            history.append_history(records, path)
        return history.history_rows(history.read_history(spark, path))
    return tables.stored(spark, sf_dir, "history-rows", build)


@query
def history_flatten(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def history_documents(spark, sf_dir):
    """The records of both runs as two JSON documents that hold a list each, imported."""
    path = new_path(spark, "history-documents")
    for records in _two_runs(spark, sf_dir):
        one = records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("r")).agg(
            F.concat(F.lit('{"monitoring_history": [\n  '), F.array_join(F.collect_list("r"), ",\n  "), F.lit('\n], "last_updated": "now"}')))
        one.write.mode("append").text(path)
    return history.history_rows(history.import_history(spark, path))


@query
def history_append(spark, sf_dir):
    """A re-run adds its records: records per model and snapshot."""
    return _history(spark, sf_dir).groupBy("model_name", "snapshot_date").agg(F.count("*").alias("records"))


@query
def history_in_period(spark, sf_dir):
    rows = report.history_in_period(_history(spark, sf_dir), "2024-01-05", "2024-01-20")
    return rows.select("model_name", "snapshot_date", "monitored_at", "auc_roc", "psi", "check_alert_level")


@query
def history_latest(spark, sf_dir):
    rows = report.latest_per_snapshot(_history(spark, sf_dir))
    return rows.select("model_name", "snapshot_date", "monitored_at", "accuracy", "auc_roc", "psi")


@query
def latest_metrics(spark, sf_dir):
    return report.latest_metrics(_history(spark, sf_dir))


@query
def threshold_compliance(spark, sf_dir):
    return report.threshold_compliance(_history(spark, sf_dir))


@query
def monitoring_summary(spark, sf_dir):
    return report.monitoring_summary(report.require_history(_history(spark, sf_dir)))


@query
def monitoring_series(spark, sf_dir):
    return report.monitoring_series(_history(spark, sf_dir))


@query
def even_period_sample(spark, sf_dir):
    return report.even_period_sample(tables.scores(spark, sf_dir))


@query
def sampled_density(spark, sf_dir):
    """Densities of the evenly sampled days that lie inside a period."""
    return report.sampled_density(tables.scores(spark, sf_dir), "2024-01-05", "2024-01-28")


@query
def monitoring_records(spark, sf_dir):
    """Nested records of two runs written as JSON per model and snapshot, the second in place of the first."""
    path = new_path(spark, "records")
    for records in _two_runs(spark, sf_dir):
        history.write_records(records, path)
    back = history.read_history(spark, path)
    return back.select("snapshot_date", "model_name", "monitored_at", "metrics.auc_roc", "metrics.true_positives", "metrics.psi",
                       "threshold_checks.all_passed", "threshold_checks.alert_level", "thresholds.psi_critical")


@query
def retrain_trigger(spark, sf_dir):
    return checks.retrain_trigger(report.latest_per_snapshot(_history(spark, sf_dir)))


@query
def performance_degradation(spark, sf_dir):
    return checks.performance_degradation(report.latest_per_snapshot(_history(spark, sf_dir)))


@query
def degradation_from_validation(spark, sf_dir):
    """Against the validation score that the registry holds."""
    return checks.performance_degradation(report.latest_per_snapshot(_history(spark, sf_dir)),
                                          registry=_score_registry(spark, sf_dir))


@query
def scheduled_retraining(spark, sf_dir):
    """Label months as periods, retraining every second month."""
    rates = tables.labels(spark, sf_dir).groupBy("snapshot_date").agg(F.avg("label").alias("rate"))
    rows = rates.select(F.lit("alpha").alias("model_name"), "snapshot_date", F.col("rate").alias("auc_roc"),
                        *[F.col("rate").alias(c) for c in ("precision", "recall", "f1_score", "psi")])
    return checks.retrain_trigger(rows, every_months=2).select("model_name", "snapshot_date", "scheduled", "retrain")


# --- models -----------------------------------------------------------------------------------

def _score_registry(spark, sf_dir):
    """Both score models evaluated on three windows of days."""
    joined = monitoring.join_labels(monitoring.prediction_snapshots(tables.predictions(spark, sf_dir)),
                                    tables.observed_labels(spark, sf_dir))
    windows = {"train": ("2024-01-01", "2024-01-15"), "validation": ("2024-01-16", "2024-01-20"),
               "test": ("2024-01-21", "2024-01-25")}
    evaluated = models.evaluate_splits(prep.with_split(joined, windows))
    ordinal = F.when(F.col("model_name") == "alpha", 1).otherwise(2)
    return report.registry_long(evaluated).select(ordinal.alias("ordinal"), "model_name", "split", "metric", "value")


@query
def registry_metrics(spark, sf_dir):
    return _score_registry(spark, sf_dir)


@query
def best_model(spark, sf_dir):
    return report.best_model(_score_registry(spark, sf_dir))


_RATES = ("accuracy", "precision", "recall", "f1_score", "auc_roc")


def _in_range(columns, top="1"):
    return F.expr(" and ".join(f"{c} between 0 and {top}" for c in columns))


def _fitted(spark, sf_dir, name, checks=None):
    """Facts about a fit: rows and positives per split, every row counted once, measures within their range, and a
    training AUC above one half. The measures themselves depend on the engine's random draws."""
    frame = tables.stored(spark, sf_dir, "vectors", lambda: tables.vectors(spark, sf_dir))
    train = frame.where("split = 'train'")
    model = models.fit(name, train, tables.VECTOR_FEATURES)
    found = metrics.evaluate(models.score(model, frame, name), ["model_name", "split"])
    return found.select(
        "model_name", "split", "n_rows", F.expr("false_negatives + true_positives").alias("positives"),
        F.expr("true_negatives + false_positives + false_negatives + true_positives").alias("counted"),
        (_in_range(_RATES) & (F.col("log_loss") >= 0)).alias("in_range"),
        F.expr("split <> 'train' or auc_roc > 0.5").alias("beats_chance"),
        *[F.lit(value).alias(c) for c, value in (checks(model, train) if checks else {}).items()])


@query
def train_logreg(spark, sf_dir):
    """At the optimum the gradient of the penalised objective vanishes."""
    return _fitted(spark, sf_dir, "LogisticRegression", lambda model, train: {
        "at_optimum": models.gradient_norm(model, train, len(tables.VECTOR_FEATURES)) < 1e-4})


@query
def train_rf(spark, sf_dir):
    return _fitted(spark, sf_dir, "RandomForest")


@query
def train_gbt(spark, sf_dir):
    return _fitted(spark, sf_dir, "GradientBoosting")


@query
def boosted_stump(spark, sf_dir):
    """One boosting round of one split over all vectors: the feature, the threshold, and the weights of both leaves."""
    frame = tables.vectors(spark, sf_dir).select("label", array_to_vector(F.array(*tables.VECTOR_FEATURES)).alias("features"))
    model = HistogramTrees(trees=1, depth=1, rate=1.0).fit(frame)
    fitted = model.fitted
    return model.transform(frame).agg(F.count("*").alias("n_rows"), F.avg("rawPrediction").alias("mean_margin")).withColumns({
        "feature": F.lit(int(fitted.feature[0, 0]) + 1), "threshold": F.lit(float(fitted.threshold[0, 0])),
        "left_weight": F.lit(float(fitted.weight[0, 1])), "right_weight": F.lit(float(fitted.weight[0, 2]))})


def _trained_root(spark, sf_dir):
    """Mart features, trained and registered once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        frame, columns = training.model_frame(tables.gold_features(spark, sf_dir), tables.gold_labels(spark, sf_dir),
                                              tables.SPLITS, tables.FEATURES)
        root = new_path(spark, "registry")
        training.train_all(frame, columns, root)
        _roots[key] = root
    return _roots[key]


_roots: dict[tuple, str] = {}


@query
def registry_long(spark, sf_dir):
    """Registry table of the models trained on the mart's own feature store: every model, split and metric."""
    value, loss = F.col("value"), F.col("metric") == "log_loss"
    inside = F.when(loss, value >= 0).otherwise(value.between(0, 1))
    return registry.read_registry(spark, _trained_root(spark, sf_dir)).select(
        "ordinal", "model_name", "split", "metric", inside.alias("in_range"))


@query
def score_range(spark, sf_dir):
    """The selected model scores a range of snapshots into the predictions table."""
    root, path = _trained_root(spark, sf_dir), new_path(spark, "scored")
    features = tables.gold_features(spark, sf_dir)
    scoring.score_range(features, root, path, *tables.SPLITS["oot"])
    return scoring.scored_summary(spark.read.parquet(path)).select(
        F.col("inference_date").cast("string").alias("inference_date"), "n_rows",
        _in_range(["mean_probability", "predicted_rate"]).alias("in_range"))


@query
def score_best(spark, sf_dir):
    """Scored rows of the out-of-time snapshots."""
    rows = scoring.score_snapshots(tables.gold_features(spark, sf_dir), _trained_root(spark, sf_dir), *tables.SPLITS["oot"])
    return rows.select("loan_id", "Customer_ID", "threshold", "inference_date", _in_range(["prediction_proba"]).alias("in_range"),
                       F.expr("(prediction_label = 1) = (prediction_proba >= threshold)").alias("label_agrees"))
