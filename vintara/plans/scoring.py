"""Batch scoring of loan applications, with bounds validation and a quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import risk as R
from vintara.plans import portfolio as P

# Application field -> loan column the risk expressions read.
_LOAN_COLUMNS = {
    "credit_score": "CREDIT_SCORE",
    "original_ltv": "ORIGINAL_LTV",
    "original_cltv": "ORIGINAL_CLTV",
    "original_dti": "ORIGINAL_DTI",
    "original_upb": "ORIGINAL_UPB",
    "original_interest_rate": "ORIGINAL_INTEREST_RATE",
    "original_loan_term": "ORIGINAL_LOAN_TERM",
    "occ_status": "OCC_STATUS",
    "loan_purpose": "LOAN_PURPOSE",
    "property_type": "PROPERTY_TYPE",
    "property_state": "PROPERTY_STATE",
    "product_type": "PRODUCT_TYPE",
    "channel": "CHANNEL",
    "first_time_homebuyer": "FIRST_TIME_HOMEBUYER_FLAG",
    "mi_pct": "MI_PCT",
}


def with_defaults(applications: DataFrame) -> DataFrame:
    """Fill absent fields and nulls with the field defaults."""

    def filled(name: str, default: object) -> Column:
        if name not in applications.columns:
            return F.lit(default)
        return F.coalesce(F.col(name), F.lit(default))

    return applications.withColumns(
        {n: filled(n, default) for n, (default, _, _) in S.APPLICATION_FIELDS.items()}
    )


def validate(rows: DataFrame) -> DataFrame:
    """Add ``violations``: one reason per field outside its bounds, in field order.

    Checks whichever bounded fields the frame has, so it serves loan applications and scenario
    requests alike.
    """
    reasons = []
    for name, (_, low, high) in S.APPLICATION_FIELDS.items():
        if name not in rows.columns:
            continue
        if low is not None:
            reasons.append(F.when(F.col(name) < low, F.lit(f"{name} below {low}")))
        if high is not None:
            reasons.append(F.when(F.col(name) > high, F.lit(f"{name} above {high}")))
    return rows.withColumn("violations", F.array_compact(F.array(*reasons)))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") == 0).drop("violations")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") > 0)


def score_applications(
    applications: DataFrame, baseline: DataFrame, scoring: P.Scoring | None = None
) -> DataFrame:
    """PD, LGD, EAD, ECL, stage and risk level of every valid application.

    A new loan: exposure is the original balance, not delinquent, age zero.
    """
    valid = accepted(validate(with_defaults(applications)))
    loans = valid.withColumnsRenamed(_LOAN_COLUMNS).withColumns(
        {
            "CURRENT_ACTUAL_UPB": F.col("ORIGINAL_UPB"),
            "DLQ_STATUS_INT": F.lit(0),
            "LOAN_AGE_AT_OBS": F.lit(0),
        }
    )
    scored = P.expected_credit_loss(P.with_own_shocks(loans, baseline), scoring)
    rate = F.col("ecl") / F.greatest(F.col("ead"), F.lit(1.0))
    return scored.select(
        *[c for c in applications.columns if c not in S.APPLICATION_FIELDS],
        F.round("pd_pred", 6).alias("pd_12m"),
        F.round("lgd_pred", 4).alias("lgd"),
        F.round("ead", 2).alias("ead"),
        F.round("ecl", 2).alias("ecl"),
        F.round(rate, 6).alias("ecl_rate"),
        "ifrs9_stage",
        R.risk_level(F.col("pd_pred")).alias("risk_level"),
    )
