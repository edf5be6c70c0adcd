"""Dirty text to numbers, bands and categories."""

import pytest
from pyspark.sql import functions as F

from riskmart.functions.cleaning import cast_columns, ratio, with_if_present
from riskmart.operators.silver import silver_attributes, silver_clickstream, silver_financials, silver_loan_daily
from riskmart import config


@pytest.mark.parametrize("text, number", [
    ("41", 41), (" 7 ", 7), ("12.5", 12), ("-12.7", -12), ("7.0", 7), ("+3", 3), ("5.", 5),
    ("abc", None), ("", None), ("1e3", None), ("12d", None), ("NaN", None), ("_", None),
    ("99999999999", None), (None, None)])
def test_int_from_text(spark, text, number):
    assert cast_columns(spark.createDataFrame([(text,)], "n string"), {"n": "int"}).first().n == number


def test_strip_and_ratio(spark):
    df = spark.createDataFrame([("__-33_", 1.0, 0.0, 12.9)], "t string, a double, b double, c double")
    row = cast_columns(df, {"t": "int", "c": "int"}, strip=["t"]).select("t", "c", ratio(F.col("a"), F.col("b")).alias("r")).first()
    assert (row.t, row.c, row.r) == (-33, 12, None)


def test_cast_columns_required_and_guarded(spark):
    df = spark.createDataFrame([("1", "x")], "a string, other string")
    assert cast_columns(df, {"a": "int", "missing": "float"}).first() == (1, "x")
    with pytest.raises(ValueError, match="missing"):
        cast_columns(df, {"a": "int", "missing": "float"}, required=True)
    assert with_if_present(df, "nope", F.upper).columns == df.columns
    assert with_if_present(df, "other", F.upper).first().other == "X"


def test_attributes_from_dirty_rows(spark):
    rows = [("41_", "Engineer"), ("-500", "_______"), ("2329_", "Media_Manager"), ("17", "Doctor"), ("64", "Manager"),
            ("65", "Teacher"), (None, None)]
    raw = spark.createDataFrame([(f"C{i}", "n", a, "s", o, "2023-01-01") for i, (a, o) in enumerate(rows)],
                                "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date string")
    got = [(r.Age, r.age_group, r.occupation_category) for r in silver_attributes(raw).orderBy("Customer_ID").collect()]
    assert got == [(41, "35-44", "Technical"), (None, "65+", "Other"), (None, "65+", "Other"), (17, "18-24", "Professional"),
                   (64, "55-64", "Management"), (65, "65+", "Education"), (None, "65+", "Other")]


def test_financials(spark):
    raw = spark.createDataFrame(
        [("C1", "30000_", "1000", "50", "7.0", "__-333333333333333333333333333__"),
         ("C2", "29999.5", "0", "50", "_", "100.5"),
         ("C3", None, None, "50", "3_", "-1000000"),
         ("C4", "120000", "2000", None, "x", "2e15")],
        "Customer_ID string, Annual_Income string, Monthly_Inhand_Salary string, Total_EMI_per_month string, "
        "Num_of_Loan string, Monthly_Balance string").withColumn("snapshot_date", F.lit("2023-01-01"))
    got = {r.Customer_ID: r for r in silver_financials(raw).collect()}
    assert [got[c].income_category for c in ("C1", "C2", "C3", "C4")] == ["Medium", "Low", "Very High", "Very High"]
    assert [got[c].Num_of_Loan for c in ("C1", "C2", "C3", "C4")] == [7, None, 3, None]
    assert [got[c].Monthly_Balance for c in ("C1", "C2", "C3", "C4")] == [None, 100.5, -1000000.0, None]
    assert [got[c].debt_to_income_ratio for c in ("C1", "C2", "C3", "C4")] == [5.0, 0.0, 0.0, None]


def test_clickstream_types(spark):
    raw = spark.createDataFrame([("C1", "2023-01-01", "1.5", "x")], "Customer_ID string, snapshot_date string, fe_1 string, fe_2 string")
    row = silver_clickstream(raw).first()
    assert (row.fe_1, row.fe_2) == (1.5, None)


LOAN = "loan_id string, Customer_ID string, loan_start_date string, tenure string, installment_num string, loan_amt string, " \
       "due_amt string, paid_amt string, overdue_amt string, balance string, snapshot_date string"


def loan(loan_id, installment, due, overdue, snapshot, balance="1"):
    return (loan_id, "C1", "2023-01-01", "10", installment, "1000", due, "0", overdue, balance, snapshot)


def test_loan_daily_rules(spark):
    raw = spark.createDataFrame([
        loan("null installment", None, "100", "0", "2023-01-01"),
        loan("null amounts", "1", "100", None, "2023-02-01", balance=None),
        loan("three missed", "4", "100", "250", "2023-05-01"),
        loan("no due", "3", "0", "50", "2023-04-01"),
        loan("february", "2", "100", "100", "2023-03-01"),
        loan("month end", "5", "100", "100", "2023-03-31"),
        loan("float noise", "5", "0.1", "0.3", "2023-06-01"),
    ], LOAN)
    got = {r.loan_id: r for r in silver_loan_daily(raw).collect()}
    assert got["null installment"].mob == 0 and got["null installment"].installment_num == 0
    assert (got["null amounts"].overdue_amt, got["null amounts"].balance, got["null amounts"].dpd) == (0.0, 0.0, 0)
    assert (got["three missed"].installments_missed, str(got["three missed"].first_missed_date), got["three missed"].dpd) == (3, "2023-02-01", 89)
    assert (got["no due"].installments_missed, got["no due"].first_missed_date, got["no due"].dpd) == (0, None, None)
    assert (got["february"].dpd, str(got["month end"].first_missed_date)) == (28, "2023-02-28")
    # 0.3f / 0.1f as doubles lies just above 3.
    assert got["float noise"].installments_missed == 4
    with pytest.raises(ValueError):
        silver_loan_daily(raw.drop("balance"))


def test_silver_is_free_of_shuffles(spark):
    plan = silver_loan_daily(spark.createDataFrame([loan("a", "1", "1", "1", "2023-01-01")], LOAN))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert set(config.LOAN_TYPES) < set(plan.columns)
