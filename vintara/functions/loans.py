"""Loan-month expressions: delinquency, zero balance, age, realised loss."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions.nullsafe import clip, flag, ratio, to_number

# Stands for the month of an undated record; every real month is below.
UNDATED = 9_999_999


def delinquency_status(c: Column) -> Column:
    return F.upper(F.trim(c))


def is_seriously_delinquent(status: Column) -> Column:
    """Three or more months past due, or a foreclosure / REO code."""
    months = to_number(status)
    return flag(months >= S.SERIOUS_DELINQUENCY_MONTHS) | flag(
        status.isin(*S.SERIOUS_DELINQUENCY_CODES)
    )


def is_zero_balance(code: Column) -> Column:
    return flag(F.trim(code) != "")


def is_prepaid(code: Column) -> Column:
    return flag(F.trim(code) == S.PREPAID_CODE)


def is_liquidated(code: Column) -> Column:
    return flag(F.trim(code).isin(*S.LIQUIDATION_CODES))


def delinquency_as_int(status: Column) -> Column:
    """Months delinquent as a number; letter codes have their own values, unknown is 0."""
    coded = reduce(
        lambda chain, kv: chain.when(status == kv[0], F.lit(kv[1])),
        S.DELINQUENCY_CODE_AS_INT.items(),
        F,
    )
    months = coded.otherwise(to_number(status).try_cast("int"))
    return F.coalesce(months, F.lit(0)).cast("short")


def age_from_dates(observed: Column, originated: Column) -> Column:
    """Whole months between two dates on a 30.44-day month, rounded half to even."""
    return F.rint(F.date_diff(observed, originated) / F.lit(S.DAYS_PER_MONTH)).cast("int")


def loan_age_months(reported: Column, observed: Column, originated: Column) -> Column:
    return F.coalesce(reported.cast("int"), age_from_dates(observed, originated))


def default_month(originated: Column, age_months: Column) -> Column:
    """Month in which a loan of the given age stood, counting 30.44 days per month."""
    days = F.floor(F.coalesce(age_months, F.lit(0)) * F.lit(S.DAYS_PER_MONTH)).cast("int")
    return F.trunc(F.date_add(originated, days), "MM")


def realised_lgd(
    exposure: Column, reported_loss: Column, net: Column, mi: Column, non_mi: Column, costs: Column
) -> Column:
    """Share of exposure lost: the reported loss, or exposure less recoveries plus costs."""
    zero = F.lit(0.0)
    computed = (
        exposure
        - F.coalesce(net, zero)
        - F.coalesce(mi, zero)
        - F.coalesce(non_mi, zero)
        + F.coalesce(costs, zero)
    )
    return clip(ratio(F.coalesce(reported_loss, computed), exposure), 0.0, 1.0)


def event_order(reporting_date: Column, row_seq: Column) -> Column:
    """Order of a loan's records: by month with undated last, then by file position.

    One decimal: the month above 30 digits of ROW_SEQ, so that neither months nor positions
    collide. Like a long, and unlike a struct, it keeps the ordered aggregates in hash
    aggregation.
    """
    months = F.year(reporting_date) * 12 + F.month(reporting_date)
    month = F.coalesce(months, F.lit(UNDATED)).cast("decimal(7,0)")
    return (month * F.lit(Decimal(10**30)) + row_seq.cast("decimal(30,0)")).cast("decimal(38,0)")


def with_event_order(rows: DataFrame) -> DataFrame:
    """Add ``_order``, so that many ordered aggregates share one evaluation of it per row."""
    return rows.withColumn("_order", event_order(F.col("REPORTING_DATE"), F.col("ROW_SEQ")))


def last_known(value: Column, order: Column, where: Column | None = None) -> Column:
    """Aggregate: the last non-null ``value`` in ``order``, optionally among some rows."""
    known = value.isNotNull() if where is None else value.isNotNull() & where
    return F.max_by(value, F.when(known, order))
