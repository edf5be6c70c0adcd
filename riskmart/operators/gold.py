"""Gold tables: point-in-time features and delinquency labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from riskmart import config

KEY = ["Customer_ID", "snapshot_date"]


def feature_store(loans: DataFrame, attributes: DataFrame, financials: DataFrame,
                  clickstream: DataFrame, mob: int = config.FEATURE_MOB,
                  columns: config.FeatureColumns = config.FeatureColumns()) -> DataFrame:
    """Loans at the given month on book with the customer's features of the same snapshot.

    All four inputs shuffle once, on the same key; later joins reuse the partitioning of the first. All of them grow with the
    customers, and their files may be a tenth of their rows, so none is broadcast for its file size: it would pass the driver.
    Rows of a customer (or null customer) that holds a large share of the loans are split over
    tasks at run time (see session.JOIN_SETTINGS); left rows are never dropped, and repeated
    right rows fan out.
    """
    base = loans.where(F.col("mob") == mob).select(*columns.loan)
    people = attributes.select(*KEY, *[F.col(c).alias(name) for name, c in columns.attributes.items()])
    money = financials.select(*KEY, *columns.financials)
    clicks = clickstream.select(*KEY, *columns.clickstream)
    return reduce(lambda left, right: left.join(right.hint("merge"), KEY, "left"), [people, money, clicks], base)


def label_store(loans: DataFrame, dpd: int = config.DPD_THRESHOLD, mob: int = config.LABEL_MOB) -> DataFrame:
    """Default label of every loan at the given month on book."""
    return loans.where(F.col("mob") == mob).select(
        "loan_id", "Customer_ID",
        F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date")
