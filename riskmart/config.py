"""Parameters of the mart. Every operator takes them as arguments; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Results depend on each of these being exactly as written.
# ---------------------------------------------------------------------------

FEATURE_MOB = 0
LABEL_MOB = 6
DPD_THRESHOLD = 30
SCORE_THRESHOLD = 0.5

# (exclusive upper limit, band); anything else, nulls included, takes the last band.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
AGE_TOP_BAND = "65+"
INCOME_BANDS = ((30000, "Low"), (70000, "Medium"), (120000, "High"))
INCOME_TOP_BAND = "Very High"

AGE_RANGE = (0, 150)
MONTHLY_BALANCE_RANGE = (-1000000.0, 1e15)

OCCUPATION_GROUPS = {
    "Technical": ("Engineer", "Developer", "Scientist", "Architect"),
    "Professional": ("Doctor", "Lawyer", "Accountant"),
    "Management": ("Manager", "Director", "Executive"),
    "Education": ("Teacher", "Professor"),
}
OCCUPATION_OTHER = "Other"

LOAN_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "float", "due_amt": "float", "paid_amt": "float",
    "overdue_amt": "float", "balance": "float", "snapshot_date": "date",
}
ATTRIBUTE_TYPES = {
    "Customer_ID": "string", "Name": "string", "Age": "int", "SSN": "string",
    "Occupation": "string", "snapshot_date": "date",
}
FINANCIAL_TYPES = {
    "Customer_ID": "string", "Annual_Income": "float", "Monthly_Inhand_Salary": "float",
    "Num_Bank_Accounts": "int", "Num_Credit_Card": "int", "Interest_Rate": "float",
    "Num_of_Loan": "int", "Type_of_Loan": "string", "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int", "Changed_Credit_Limit": "float",
    "Num_Credit_Inquiries": "int", "Credit_Mix": "string", "Outstanding_Debt": "float",
    "Credit_Utilization_Ratio": "float", "Credit_History_Age": "string",
    "Payment_of_Min_Amount": "string", "Total_EMI_per_month": "float",
    "Amount_invested_monthly": "float", "Payment_Behaviour": "string",
    "Monthly_Balance": "float", "snapshot_date": "date",
}
CLICK_FEATURES = tuple(f"fe_{k}" for k in range(1, 21))
CLICKSTREAM_TYPES = {
    "Customer_ID": "string", "snapshot_date": "date", **{c: "float" for c in CLICK_FEATURES},
}

# Text columns that carry stray underscores around their numbers.
ATTRIBUTE_DIRTY = ("Age",)
FINANCIAL_DIRTY = (
    "Annual_Income", "Num_of_Loan", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
    "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance",
)

# Columns known when a loan is applied for; repayment columns would leak the label.
LOAN_FEATURES = ("loan_id", "Customer_ID", "loan_start_date", "tenure", "loan_amt", "snapshot_date")
# output name -> silver column; name and SSN stay behind.
ATTRIBUTE_FEATURES = {
    "customer_age": "Age", "customer_occupation": "Occupation",
    "age_group": "age_group", "occupation_category": "occupation_category",
}
FINANCIAL_FEATURES = (
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "Total_EMI_per_month",
    "Amount_invested_monthly", "Monthly_Balance", "debt_to_income_ratio", "income_category",
)

# Model inputs, in matrix order.
MODEL_FEATURES = (
    "tenure", "loan_amt", "customer_age",
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Num_of_Delayed_Payment", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly",
    "Monthly_Balance", "debt_to_income_ratio",
) + CLICK_FEATURES

# Columns the raw feeds are expected to hold as numbers.
NUMERIC_ATTRIBUTES = ("Age",)
NUMERIC_FINANCIALS = (
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Changed_Credit_Limit", "Num_Credit_Inquiries", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly",
    "Monthly_Balance",
)

# Closed snapshot ranges of the temporal split.
SPLITS = {
    "train": ("2023-01-01", "2023-12-01"),
    "validation": ("2024-01-01", "2024-03-01"),
    "test": ("2024-04-01", "2024-05-01"),
    "oot": ("2024-06-01", "2024-06-01"),
}
WINDOW_MONTHS = {"train": 12, "validation": 2, "test": 2}

# Stability index: edges of the ten score bins as the doubles of an even grid on [0, 1], the outer
# two widened; empty bins count as this share.
PSI_EDGES = (-0.001, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5,
             0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.001)
PSI_EMPTY_SHARE = 0.0001
DENSITY_BINS = 50
# Probabilities are kept this far away from 0 and 1 in the log loss.
LOG_LOSS_EPS = 2.220446049250313e-16
PERIOD_SAMPLE = 10

SELECTION_METRIC = "auc_roc"
RANDOM_SEED = 42
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    """Monitoring limits (fixed values): floors for metrics, ceilings for drift."""

    auc_roc_min: float = 0.70
    precision_min: float = 0.60
    recall_min: float = 0.50
    f1_score_min: float = 0.55
    psi_warning: float = 0.1
    psi_critical: float = 0.2
    performance_degradation_threshold: float = 0.05

    @property
    def floors(self) -> dict[str, float]:
        return {"auc_roc": self.auc_roc_min, "precision": self.precision_min,
                "recall": self.recall_min, "f1_score": self.f1_score_min}


@dataclass(frozen=True)
class ModelSettings:
    """Hyper-parameters of the three classifiers (fixed values)."""

    logistic_c: float = 1.0
    logistic_iterations: int = 1000
    trees: int = 100
    forest_depth: int = 10
    forest_leaf: int = 2
    forest_split: int = 5
    boosting_rounds: int = 100
    boosting_depth: int = 6
    boosting_rate: float = 0.1
    boosting_row_share: float = 0.8
    boosting_column_share: float = 0.8
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class FeatureColumns:
    """Which silver columns reach the feature store."""

    loan: tuple = LOAN_FEATURES
    attributes: dict = field(default_factory=lambda: dict(ATTRIBUTE_FEATURES))
    financials: tuple = FINANCIAL_FEATURES
    clickstream: tuple = CLICK_FEATURES
