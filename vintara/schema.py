"""Column lists, code sets, thresholds and scenario definitions.

Everything in this module is a FIXED VALUE: results are only right when these
equal the published file layouts and risk definitions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

LOAN = "LOAN_SEQUENCE_NUMBER"
VINTAGE_YEARS = tuple(range(2010, 2017))

# Origination file, columns by position, "|" separated, no header.
ORIGINATION_COLUMNS = (
    "CREDIT_SCORE", "FIRST_PAYMENT_DATE", "FIRST_TIME_HOMEBUYER_FLAG", "MATURITY_DATE",
    "MSA", "MI_PCT", "NUMBER_OF_UNITS", "OCC_STATUS", "ORIGINAL_CLTV", "ORIGINAL_DTI",
    "ORIGINAL_UPB", "ORIGINAL_LTV", "ORIGINAL_INTEREST_RATE", "CHANNEL", "PPM_FLAG",
    "PRODUCT_TYPE", "PROPERTY_STATE", "PROPERTY_TYPE", "POSTAL_CODE",
    "LOAN_SEQUENCE_NUMBER", "LOAN_PURPOSE", "ORIGINAL_LOAN_TERM", "NUMBER_OF_BORROWERS",
    "SELLER_NAME", "SERVICER_NAME", "SUPER_CONFORMING_FLAG",
    "PRE_HARP_LOAN_SEQUENCE_NUMBER", "PROGRAM_INDICATOR", "HARP_INDICATOR",
    "PROPERTY_VALUATION_METHOD", "IO_INDICATOR", "MI_CANCELLATION_INDICATOR",
)

# Servicing file, columns by position, "|" separated, no header.
SERVICING_COLUMNS = (
    "LOAN_SEQUENCE_NUMBER", "MONTHLY_REPORTING_PERIOD", "CURRENT_ACTUAL_UPB",
    "CURRENT_LOAN_DELINQUENCY_STATUS", "LOAN_AGE", "REMAINING_MONTHS_TO_MATURITY",
    "REPURCHASE_MAKE_WHOLE_PROCEEDS_FLAG", "MODIFICATION_FLAG", "ZERO_BALANCE_CODE",
    "ZERO_BALANCE_EFFECTIVE_DATE", "CURRENT_INTEREST_RATE", "CURRENT_DEFERRED_UPB", "DDLPI",
    "MI_RECOVERIES", "NET_SALES_PROCEEDS", "NON_MI_RECOVERIES", "EXPENSES", "LEGAL_COSTS",
    "MAINTENANCE_PRESERVATION_COSTS", "TAXES_INSURANCE", "MISCELLANEOUS_EXPENSES",
    "ACTUAL_LOSS_CALCULATION", "MODIFICATION_RELATED_NON_INTEREST_BEARING_UPB",
    "PRINCIPAL_FORGIVENESS_UPB", "ORIGINAL_LIST_START_DATE", "ORIGINAL_LIST_PRICE",
    "CURRENT_LIST_START_DATE", "CURRENT_LIST_PRICE", "BORROWER_ASSISTANCE_PLAN",
    "VALUE_OF_DELINQUENT_ACCRUED_INTEREST", "CURRENT_NON_INTEREST_BEARING_UPB",
    "CURRENT_UPB_SCHEDULED",
)

# Target types of the numeric columns; every other column is text or a date.
ORIGINATION_NUMBERS = {
    "CREDIT_SCORE": "short", "MI_PCT": "float", "NUMBER_OF_UNITS": "byte",
    "ORIGINAL_CLTV": "float", "ORIGINAL_DTI": "float", "ORIGINAL_UPB": "double",
    "ORIGINAL_LTV": "float", "ORIGINAL_INTEREST_RATE": "float", "ORIGINAL_LOAN_TERM": "short",
}
ORIGINATION_MONTHS = ("FIRST_PAYMENT_DATE", "MATURITY_DATE")
ORIGINATION_CODES = tuple(
    c for c in ORIGINATION_COLUMNS if c not in ORIGINATION_NUMBERS and c not in ORIGINATION_MONTHS
)
SERVICING_NUMBERS = {
    "CURRENT_ACTUAL_UPB": "double", "LOAN_AGE": "short", "REMAINING_MONTHS_TO_MATURITY": "short",
    "CURRENT_INTEREST_RATE": "double", "CURRENT_DEFERRED_UPB": "double",
    "MI_RECOVERIES": "double", "NET_SALES_PROCEEDS": "double", "NON_MI_RECOVERIES": "double",
    "EXPENSES": "double", "LEGAL_COSTS": "double", "MAINTENANCE_PRESERVATION_COSTS": "double",
    "TAXES_INSURANCE": "double", "MISCELLANEOUS_EXPENSES": "double",
    "ACTUAL_LOSS_CALCULATION": "double",
    "MODIFICATION_RELATED_NON_INTEREST_BEARING_UPB": "double",
    "PRINCIPAL_FORGIVENESS_UPB": "double", "ORIGINAL_LIST_PRICE": "double",
    "CURRENT_LIST_PRICE": "double", "VALUE_OF_DELINQUENT_ACCRUED_INTEREST": "double",
    "CURRENT_NON_INTEREST_BEARING_UPB": "double", "CURRENT_UPB_SCHEDULED": "double",
}

# Missing-value conventions of the files.
NUMERIC_SENTINELS = {"CREDIT_SCORE": 9999, "ORIGINAL_DTI": 999}
CODE_SENTINELS = ("9", "99")
CODES_KEEPING_NINE = ("LOAN_PURPOSE",)
NULL_TOKENS = (
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Business definitions.
SERIOUS_DELINQUENCY_MONTHS = 3
SERIOUS_DELINQUENCY_CODES = ("XX", "RA")
DELINQUENCY_CODE_AS_INT = {"XX": 999, "RA": 998}
PREPAID_CODE = "01"
LIQUIDATION_CODES = ("02", "03", "04", "05", "06", "09")
DAYS_PER_MONTH = 30.44

# Columns of the loan-month panel.
PANEL_ORIGINATION_COLUMNS = (
    "LOAN_SEQUENCE_NUMBER", "VINTAGE_YEAR", "ORIGINATION_DATE", "CREDIT_SCORE", "ORIGINAL_LTV",
    "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB", "ORIGINAL_INTEREST_RATE",
    "ORIGINAL_LOAN_TERM", "OCC_STATUS", "LOAN_PURPOSE", "PROPERTY_TYPE", "PROPERTY_STATE",
    "PRODUCT_TYPE", "CHANNEL", "NUMBER_OF_UNITS", "FIRST_TIME_HOMEBUYER_FLAG", "MI_PCT",
    "MATURITY_DATE", "POSTAL_CODE", "MSA",
)
PANEL_SERVICING_COLUMNS = (
    "LOAN_SEQUENCE_NUMBER", "MONTHLY_REPORTING_PERIOD", "REPORTING_DATE", "CURRENT_ACTUAL_UPB",
    "CURRENT_LOAN_DELINQUENCY_STATUS", "LOAN_AGE", "REMAINING_MONTHS_TO_MATURITY",
    "CURRENT_INTEREST_RATE", "ZERO_BALANCE_CODE", "ZERO_BALANCE_DATE", "IS_SERIOUSLY_DELINQUENT",
    "IS_ZERO_BALANCE", "IS_PREPAID", "IS_LIQUIDATED", "IS_DEFAULTED", "MODIFICATION_FLAG",
    "NET_SALES_PROCEEDS", "ACTUAL_LOSS_CALCULATION", "EXPENSES", "MI_RECOVERIES",
    "NON_MI_RECOVERIES",
)
OUTCOME_ORIGINATION_COLUMNS = tuple(
    c for c in PANEL_ORIGINATION_COLUMNS
    if c not in ("NUMBER_OF_UNITS", "MATURITY_DATE", "POSTAL_CODE", "MSA")
)

# Macro series and calendar.
MACRO_SERIES = {
    "UNRATE": "unemployment_rate", "USSTHPI": "hpi_us", "MORTGAGE30US": "mortgage_rate_30y",
    "STLFSI4": "financial_stress_idx", "GDPC1": "real_gdp", "CPIAUCSL": "cpi",
}
MACRO_START, MACRO_END = "2010-01-01", "2023-12-01"
BASELINE_YEAR = 2016
BASELINE_DEFAULTS = {
    "unemployment_rate": 4.87, "hpi_yoy_chg": 5.6, "mortgage_rate_30y": 3.65,
    "financial_stress_idx": -0.5, "unrate_chg_mom": 0.0, "hpi_us": 199.0,
}

# IFRS 9 staging and the lifetime multiplier.
STAGE2_MIN_DLQ, STAGE3_MIN_DLQ = 1, 3
STAGE2_MIN_PD, STAGE3_MIN_PD = 0.01, 0.10
LIFETIME_MULTIPLIER = 3.0

# Bands are right-closed, (lower, upper].
FICO_EDGES = (0, 620, 660, 700, 740, 800, 900)
FICO_LABELS = ("<620", "620-659", "660-699", "700-739", "740-799", "800+")
FICO_DEFAULT = 650
LTV_EDGES = (0, 60, 70, 80, 90, 100, 200)
LTV_LABELS = ("<60", "60-69", "70-79", "80-89", "90-99", "100+")
LTV_DEFAULT = 80

# Risk levels by upper PD bound (exclusive).
RISK_LEVELS = ((0.01, "LOW"), (0.03, "MEDIUM"), (0.08, "HIGH"))
RISK_LEVEL_ABOVE = "VERY HIGH"

# Model splits by vintage.
SPLIT_YEARS = {"train": (2010, 2011, 2012, 2013), "valid": (2014,), "test": (2015, 2016)}


class Scenario(NamedTuple):
    scenario_name: str
    unemployment_shock: float = 0.0
    hpi_shock: float = 0.0
    rate_shock: float = 0.0
    label: str = "Custom"
    color: str = "#888"


# Preset scenarios.
SCENARIOS = (
    Scenario("baseline", 0.0, 0.0, 0.0, "Baseline", "#22d3ee"),
    Scenario("mild", 2.0, -5.0, 1.0, "Mild Stress", "#f59e0b"),
    Scenario("severe", 5.0, -20.0, 2.5, "Severe Stress", "#ef4444"),
    Scenario("gfc", 8.0, -33.0, 0.5, "GFC-like", "#7c3aed"),
)

# Application fields as (default, lower bound, upper bound); None = no bound.
APPLICATION_FIELDS = {
    "credit_score": (700, 300, 850),
    "original_ltv": (80.0, 0, 200),
    "original_cltv": (80.0, 0, 200),
    "original_dti": (35.0, 0, 70),
    "original_upb": (200000.0, 1000, None),
    "original_interest_rate": (4.5, 0, 20),
    "original_loan_term": (360, 60, 480),
    "occ_status": ("P", None, None),
    "loan_purpose": ("C", None, None),
    "property_type": ("SF", None, None),
    "property_state": ("CA", None, None),
    "product_type": ("FRM", None, None),
    "channel": ("R", None, None),
    "first_time_homebuyer": ("N", None, None),
    "mi_pct": (0.0, 0, 35),
    "unemployment_shock": (0.0, -5, 20),
    "hpi_shock": (0.0, -50, 20),
    "rate_shock": (0.0, -3, 10),
}
SHOCK_FIELDS = ("unemployment_shock", "hpi_shock", "rate_shock")

# Model features.
PD_NUMERIC = (
    "CREDIT_SCORE", "ORIGINAL_LTV", "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB",
    "ORIGINAL_INTEREST_RATE", "ORIGINAL_LOAN_TERM", "MI_PCT", "RATE_SPREAD", "LOAN_AGE_AT_OBS",
    "unemployment_rate", "hpi_yoy_chg", "mortgage_rate_30y", "financial_stress_idx",
    "unrate_chg_mom", "DLQ_STATUS_INT",
)
PD_CATEGORICAL = (
    "OCC_STATUS", "LOAN_PURPOSE", "PROPERTY_TYPE", "PROPERTY_STATE", "PRODUCT_TYPE", "CHANNEL",
    "FIRST_TIME_HOMEBUYER_FLAG",
)
LGD_NUMERIC = (
    "CREDIT_SCORE", "ORIGINAL_LTV", "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB",
    "ORIGINAL_INTEREST_RATE", "ORIGINAL_LOAN_TERM", "MI_PCT", "LOAN_AGE_AT_DEFAULT",
    "unemployment_rate_at_default", "hpi_yoy_chg_at_default", "rate_at_default",
    "fsi_at_default",
)
LGD_CATEGORICAL = ("OCC_STATUS", "PROPERTY_TYPE", "PROPERTY_STATE", "LOAN_PURPOSE")


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    """All-string schema of a positional text file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
