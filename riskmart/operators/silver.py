"""Silver tables: typed, cleaned and banded snapshots. Row-wise, so no shuffle at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskmart import config
from riskmart.functions.cleaning import band, cast_columns, map_groups, null_outside, ratio, with_if_present


def silver_loan_daily(raw: DataFrame, types=config.LOAN_TYPES) -> DataFrame:
    """Loan panel with month on book, missed instalments and days past due.

    Every numeric null of the table becomes 0, amounts and month on book included; a ratio without
    denominator counts as no missed instalment.
    """
    typed = cast_columns(raw, types, required=True)
    missed = F.ceil(ratio(F.col("overdue_amt"), F.col("due_amt"))).try_cast("int")
    filled = typed.withColumns({"mob": F.col("installment_num"), "installments_missed": missed}).fillna(0)
    dated = filled.withColumn("first_missed_date", F.when(
        F.col("installments_missed") > 0,
        F.add_months("snapshot_date", -F.col("installments_missed"))))
    return dated.withColumn("dpd", F.when(
        F.col("overdue_amt") > 0, F.datediff("snapshot_date", "first_missed_date")).otherwise(0))


def silver_attributes(raw: DataFrame, types=config.ATTRIBUTE_TYPES) -> DataFrame:
    """Customer attributes with valid ages, age group and occupation category."""
    typed = cast_columns(raw, types, strip=config.ATTRIBUTE_DIRTY)
    valid = typed.withColumn("Age", null_outside(F.col("Age"), *config.AGE_RANGE))
    return valid.withColumns({
        "age_group": band(F.col("Age"), config.AGE_BANDS, config.AGE_TOP_BAND),
        "occupation_category": map_groups(F.col("Occupation"), config.OCCUPATION_GROUPS,
                                          config.OCCUPATION_OTHER),
    })


def silver_financials(raw: DataFrame, types=config.FINANCIAL_TYPES) -> DataFrame:
    """Financials with placeholder balances removed, debt-to-income ratio and income category."""
    typed = cast_columns(raw, types, strip=config.FINANCIAL_DIRTY)
    valid = with_if_present(typed, "Monthly_Balance",
                            lambda c: null_outside(c, *config.MONTHLY_BALANCE_RANGE))
    salary = F.col("Monthly_Inhand_Salary")
    burden = ratio(F.col("Total_EMI_per_month"), salary) * 100
    return valid.withColumns({
        "debt_to_income_ratio": F.when(salary > 0, burden).otherwise(0.0).cast("float"),
        "income_category": band(F.col("Annual_Income"), config.INCOME_BANDS, config.INCOME_TOP_BAND),
    })


def silver_clickstream(raw: DataFrame, types=config.CLICKSTREAM_TYPES) -> DataFrame:
    """Clickstream features as floats."""
    return cast_columns(raw, types)
