"""One outcome row per loan: default, prepayment, liquidation, realised loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import loans as L
from vintara.functions.nullsafe import flag, month_of, select_available
from vintara.functions.textfold import TextFolds
from vintara.plans.macro import at_month

_RECOVERIES = (
    "ACTUAL_LOSS_CALCULATION", "NET_SALES_PROCEEDS", "MI_RECOVERIES", "NON_MI_RECOVERIES",
    "EXPENSES",
)


def servicing_history(servicing: DataFrame) -> DataFrame:
    """All per-loan summaries of the servicing rows, in one aggregation by hashing.

    They run before the join to origination: each task folds its rows to one per loan, so the
    shuffle carries loans rather than loan-months and a hot loan costs one row per task. Age
    falls back to dates that only origination can anchor, so minimum and maximum age are kept
    as two parts (reported age; reporting date of rows without one) and finished after the join.
    The final zero-balance code, the one text value, is folded as a number.
    """
    texts = TextFolds(servicing, ["ZERO_BALANCE_CODE"])
    rows = L.with_event_order(texts.prepare(servicing.where(F.col(S.LOAN).isNotNull())))
    order = F.col("_order")
    upb, age, date = F.col("CURRENT_ACTUAL_UPB"), F.col("LOAN_AGE"), F.col("REPORTING_DATE")
    everywhere, zero = F.lit(True), F.col("IS_ZERO_BALANCE")

    def parts(fold, name: str, where: Column) -> list[Column]:
        return [
            fold(F.when(where & age.isNotNull(), age.cast("int"))).alias(f"{name}_age"),
            fold(F.when(where & age.isNull(), date)).alias(f"{name}_date"),
        ]

    def at(column: Column, alias: str, where: Column) -> Column:
        """The value in the last of the given rows, null included."""
        return F.max_by(column, F.when(where, order)).alias(alias)

    def present(name: str, kind: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None).cast(kind)

    def final_code(value: Column) -> Column:
        return L.last_known(value, order, zero)

    aged = zero & (age.isNotNull() | date.isNotNull())
    folded = rows.groupBy(S.LOAN).agg(
        *texts.fold("ZERO_BALANCE_CODE", final_code),
        F.bool_or("IS_SERIOUSLY_DELINQUENT").alias("seriously_delinquent"),
        F.bool_or("IS_PREPAID").alias("prepaid"),
        F.bool_or("IS_LIQUIDATED").alias("liquidated"),
        *parts(F.min, "default", F.col("IS_SERIOUSLY_DELINQUENT")),
        *parts(F.min, "prepay", F.col("IS_PREPAID")),
        *parts(F.max, "observed", everywhere),
        L.last_known(upb, order, upb > 0).alias("last_exposure"),
        *[at(present(n, "double"), f"last_{n}", F.col("IS_LIQUIDATED")) for n in _RECOVERIES],
        F.bool_or(flag(F.col("MODIFICATION_FLAG") == "Y")).alias("ever_modified"),
        F.max(L.delinquency_as_int(F.col("CURRENT_LOAN_DELINQUENCY_STATUS"))).alias("max_dlq_status"),
        L.last_known(present("ZERO_BALANCE_DATE", "date"), order, zero).alias("ZERO_BALANCE_DATE"),
        L.last_known(age.cast("int"), order, zero).alias("zero_reported_age"),
        at(age.cast("int"), "zero_aged_age", aged),
        at(date, "zero_aged_date", aged),
    )
    return folded.withColumn("ZERO_BALANCE_CODE", texts.finish("ZERO_BALANCE_CODE"))


def loan_outcomes(
    servicing: DataFrame, origination: DataFrame, default_basis: str = "serious"
) -> DataFrame:
    """One row per originated loan; loans without servicing rows have no events.

    ``default_basis`` "serious" counts serious delinquency only; "serious_or_liquidated" also
    counts liquidation.
    """
    originated = F.col("ORIGINATION_DATE")

    def earliest(name: str) -> Column:
        return F.least(F.col(f"{name}_age"), L.age_from_dates(F.col(f"{name}_date"), originated))

    def latest(name: str) -> Column:
        return F.greatest(F.col(f"{name}_age"), L.age_from_dates(F.col(f"{name}_date"), originated))

    defaulted = flag(F.col("seriously_delinquent"))
    if default_basis == "serious_or_liquidated":
        defaulted = defaulted | flag(F.col("liquidated"))
    elif default_basis != "serious":
        raise ValueError(f"unknown default basis {default_basis!r}")

    base = select_available(origination, S.OUTCOME_ORIGINATION_COLUMNS)
    joined = base.join(servicing_history(servicing), S.LOAN, "left")
    exposure = F.when(F.col("liquidated"), F.col("last_exposure"))
    loss = [F.col(f"last_{c}") for c in _RECOVERIES]
    aged = L.loan_age_months(F.col("zero_aged_age"), F.col("zero_aged_date"), originated)
    return joined.select(
        *base.columns,
        defaulted.alias("defaulted"),
        flag(F.col("prepaid")).alias("prepaid"),
        flag(F.col("liquidated")).alias("liquidated"),
        earliest("default").alias("time_to_default_months"),
        earliest("prepay").alias("time_to_prepay_months"),
        L.realised_lgd(exposure, *loss).alias("lgd_observed"),
        exposure.alias("EAD"),
        flag(F.col("ever_modified")).alias("ever_modified"),
        "max_dlq_status",
        "ZERO_BALANCE_CODE",
        "ZERO_BALANCE_DATE",
        F.when(originated.isNull(), F.col("zero_reported_age")).otherwise(aged).alias(
            "zero_balance_age_months"
        ),
        latest("observed").alias("observed_months"),
    )


def outcomes_with_macro(outcomes: DataFrame, macro: DataFrame) -> DataFrame:
    """Outcomes plus the macro values of the origination month and the rate spread."""
    names = {
        "date": "_month",
        "unemployment_rate": "unrate_at_orig",
        "hpi_us": "hpi_at_orig",
        "hpi_yoy_chg": "hpi_yoy_at_orig",
        "mortgage_rate_30y": "rate_at_orig",
        "financial_stress_idx": "fsi_at_orig",
    }
    with_month = outcomes.withColumn("_month", month_of(F.col("ORIGINATION_DATE")))
    joined = with_month.join(at_month(macro, names), "_month", "left").drop("_month")
    spread = F.col("ORIGINAL_INTEREST_RATE") - F.col("rate_at_orig")
    return joined.withColumn("RATE_SPREAD", spread)

