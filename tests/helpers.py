"""Small frames for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

SERVICING_SCHEMA = (
    "LOAN_SEQUENCE_NUMBER string, ROW_SEQ long, REPORTING_DATE date, LOAN_AGE int,"
    " CURRENT_LOAN_DELINQUENCY_STATUS string, ZERO_BALANCE_CODE string, ZERO_BALANCE_DATE date,"
    " CURRENT_ACTUAL_UPB double, MODIFICATION_FLAG string, NET_SALES_PROCEEDS double,"
    " MI_RECOVERIES double, NON_MI_RECOVERIES double, EXPENSES double,"
    " ACTUAL_LOSS_CALCULATION double"
)
ORIGINATION_SCHEMA = (
    "LOAN_SEQUENCE_NUMBER string, VINTAGE_YEAR int, ORIGINATION_DATE date, CREDIT_SCORE int,"
    " ORIGINAL_LTV double, ORIGINAL_DTI double, ORIGINAL_UPB double, PROPERTY_STATE string,"
    " PRODUCT_TYPE string"
)


def month(text: str | None):
    return None if text is None else dt.datetime.strptime(text, "%Y-%m").date()


def servicing(spark, rows):
    """Rows as (loan, seq, 'YYYY-MM', age, status, code, upb, extras dict)."""
    records = []
    for loan, seq, date, age, status, code, upb, *rest in rows:
        extra = rest[0] if rest else {}
        records.append(
            (
                loan, seq, month(date), age, status, code, month(extra.get("zb_date")), upb,
                extra.get("mod"), extra.get("net"), extra.get("mi"), extra.get("non_mi"),
                extra.get("costs"), extra.get("loss"),
            )
        )
    from vintara.operators.cleaning import add_event_flags

    return add_event_flags(spark.createDataFrame(records, SERVICING_SCHEMA))


def origination(spark, rows):
    """Rows as (loan, vintage, 'YYYY-MM', fico, ltv, dti, upb, state, product)."""
    records = [(r[0], r[1], month(r[2]), *r[3:]) for r in rows]
    frame = spark.createDataFrame(records, ORIGINATION_SCHEMA)
    return frame.withColumn("ORIGINAL_INTEREST_RATE", F.lit(4.0))


def by_key(df, key):
    return {r[key]: r for r in df.collect()}
