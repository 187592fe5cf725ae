"""Modelling datasets: forward-looking default labels, loss severity, time-based splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import loans as L
from vintara.functions import risk as R
from vintara.functions.nullsafe import flag, month_of, select_available
from vintara.functions.textfold import TextFolds
from vintara.plans.macro import at_month

# Observation age and label horizon in months of each dataset.
PD_DATASETS = {"pd_12m": (12, 12), "pd_24m": (12, 24), "pd_orig": (0, 12)}

# Columns of the two datasets.
_PD_COLUMNS = (
    "LOAN_SEQUENCE_NUMBER", "VINTAGE_YEAR", "PD_TARGET", "CREDIT_SCORE", "ORIGINAL_LTV",
    "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB", "ORIGINAL_INTEREST_RATE",
    "ORIGINAL_LOAN_TERM", "OCC_STATUS", "LOAN_PURPOSE", "PROPERTY_TYPE", "PROPERTY_STATE",
    "PRODUCT_TYPE", "CHANNEL", "FIRST_TIME_HOMEBUYER_FLAG", "MI_PCT", "RATE_SPREAD",
    "LOAN_AGE_AT_OBS", "CURRENT_ACTUAL_UPB", "CURRENT_LOAN_DELINQUENCY_STATUS",
    "DLQ_STATUS_INT", "unemployment_rate", "hpi_yoy_chg", "mortgage_rate_30y",
    "financial_stress_idx", "unrate_chg_mom",
)
_LGD_COLUMNS = (
    "LOAN_SEQUENCE_NUMBER", "VINTAGE_YEAR", "lgd_observed", "CREDIT_SCORE", "ORIGINAL_LTV",
    "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_UPB", "ORIGINAL_INTEREST_RATE",
    "ORIGINAL_LOAN_TERM", "OCC_STATUS", "PROPERTY_TYPE", "PROPERTY_STATE", "LOAN_PURPOSE",
    "MI_PCT", "LOAN_AGE_AT_DEFAULT", "unemployment_rate_at_default", "hpi_yoy_chg_at_default",
    "rate_at_default", "fsi_at_default", "EAD", "lgd_source",
)
_PD_MACRO = (
    "unemployment_rate", "hpi_yoy_chg", "mortgage_rate_30y", "financial_stress_idx",
    "unrate_chg_mom",
)
_SNAPSHOT = (
    "IS_ZERO_BALANCE", "REPORTING_DATE", "CURRENT_ACTUAL_UPB", "CURRENT_LOAN_DELINQUENCY_STATUS",
    "DLQ_STATUS_INT",
)


def observations_and_labels(
    servicing: DataFrame, origination: DataFrame, windows: dict[str, tuple[int, int]]
) -> DataFrame:
    """Per loan: the first record at each observation age and each window's default label.

    Servicing is read once and folded twice, by hashing both times. The first fold runs before the
    shuffle and needs no origination: the rows of a loan with a reported age become one row, and
    those without one, whose age only the origination date tells, one row for each reporting date.
    Only these few rows meet origination, and the second fold, which the join has partitioned by
    loan already, leaves one row for each loan. Texts are folded as numbers.
    """
    ages = sorted({a for a, _ in windows.values()})
    last = max(a + h for a, h in windows.values())
    status, age, date = F.col("CURRENT_LOAN_DELINQUENCY_STATUS"), F.col("LOAN_AGE"), F.col("REPORTING_DATE")
    texts = TextFolds(servicing, _SNAPSHOT)
    slim = servicing.select(
        S.LOAN, "LOAN_AGE", "ROW_SEQ", "IS_DEFAULTED",
        *[c for c in _SNAPSHOT if c != "DLQ_STATUS_INT"],
        L.delinquency_as_int(status).alias("DLQ_STATUS_INT"),
        age.isNotNull().alias("_reported"),
        F.when(age.isNull(), date).alias("_anchor"),
    )
    usable = F.col(S.LOAN).isNotNull() & (age.between(ages[0], last) | age.isNull())
    rows = L.with_event_order(texts.prepare(slim.where(usable)))
    order, reported = F.col("_order"), F.col("_reported")

    def inside(months: Column, a: int, h: int) -> Column:
        return flag((months > a) & (months <= a + h))

    def first_rows(fold_values, order_at) -> list[Column]:
        return [
            column
            for a in ages
            for column in [
                F.min(order_at(a)).alias(f"_order_at_{a}"), *[c for n in _SNAPSHOT for c in fold_values(n, a)]
            ]
        ]

    # Rows of one reporting date have one age: their first record takes the place of the first age.
    def place(a: int) -> Column:
        here = age.cast("int") == a
        return F.when(here | ~reported if a == ages[0] else here, order)

    by_date = rows.groupBy(S.LOAN, "_reported", "_anchor").agg(
        *first_rows(lambda n, a: texts.fold(n, lambda c: F.min_by(c, place(a)), f"{n}_at_{a}"), place),
        *[
            F.bool_or(inside(age, a, h) & flag(F.col("IS_DEFAULTED"))).alias(f"label_{n}")
            for n, (a, h) in windows.items()
        ],
        F.bool_or(flag(F.col("IS_DEFAULTED"))).alias("_defaulted"),
    )
    dates = origination.select(S.LOAN, "ORIGINATION_DATE", F.lit(True).alias("_originated"))
    months = L.age_from_dates(F.col("_anchor"), F.col("ORIGINATION_DATE"))
    anchored = by_date.join(dates, S.LOAN, "left").where(reported | F.col("_originated")).withColumn("_age", months)

    def either(name: str, a: int) -> Column:
        return F.when(reported, F.col(f"{name}_at_{a}")).otherwise(F.col(f"{name}_at_{ages[0]}"))

    def placed(a: int) -> Column:
        return F.when(reported | (F.col("_age") == a), either("_order", a))

    def again(name: str, a: int) -> list[Column]:
        return [
            F.min_by(F.when(reported, F.col(c)).otherwise(F.col(first)), placed(a)).alias(c)
            for c, first in zip(texts.names(f"{name}_at_{a}", name), texts.names(f"{name}_at_{ages[0]}", name), strict=True)
        ]

    folded = anchored.groupBy(S.LOAN).agg(
        *first_rows(again, placed),
        *[
            flag(
                F.bool_or(F.when(reported, F.col(f"label_{n}")).otherwise(inside(F.col("_age"), a, h) & F.col("_defaulted")))
            ).alias(f"label_{n}")
            for n, (a, h) in windows.items()
        ],
    )
    return folded.select(
        S.LOAN,
        *[
            column
            for a in ages
            for column in [
                F.col(f"_order_at_{a}").isNotNull().alias(f"seen_at_{a}"),
                *[texts.finish(n, f"{n}_at_{a}").alias(f"{n}_at_{a}") for n in _SNAPSHOT],
            ]
        ],
        *[f"label_{n}" for n in windows],
    )


def pd_dataset(
    servicing: DataFrame,
    origination: DataFrame,
    macro: DataFrame,
    observation_age: int = 12,
    horizon: int = 12,
) -> DataFrame:
    """Loans not yet at zero balance at the observation age, labelled over (age, age + horizon]."""
    windows = {"it": (observation_age, horizon)}
    base = observations_and_labels(servicing, origination, windows)
    return _pd_dataset(base, origination, macro, "it", observation_age)


def pd_datasets(
    servicing: DataFrame, origination: DataFrame, macro: DataFrame
) -> dict[str, DataFrame]:
    """The three standard datasets over one shared reduction of the servicing rows."""
    return pd_datasets_of(observations_and_labels(servicing, origination, PD_DATASETS), origination, macro)


def pd_datasets_of(base: DataFrame, origination: DataFrame, macro: DataFrame) -> dict[str, DataFrame]:
    """The three standard datasets from their shared reduction, written or not."""
    return {
        name: _pd_dataset(base, origination, macro, name, age)
        for name, (age, _) in PD_DATASETS.items()
    }


def _pd_dataset(
    base: DataFrame, origination: DataFrame, macro: DataFrame, name: str, age: int
) -> DataFrame:
    observed = base.where(F.col(f"seen_at_{age}") & ~F.col(f"IS_ZERO_BALANCE_at_{age}")).select(
        S.LOAN,
        *[F.col(f"{c}_at_{age}").alias(c) for c in _SNAPSHOT],
        F.col(f"label_{name}").cast("int").alias("PD_TARGET"),
    )
    rows = observed.join(origination, S.LOAN).withColumn("_month", month_of(F.col("REPORTING_DATE")))
    names = {"date": "_month", **{c: c for c in _PD_MACRO}}
    rows = rows.join(at_month(macro, names), "_month", "left").withColumns(
        {
            "RATE_SPREAD": F.col("ORIGINAL_INTEREST_RATE") - F.col("mortgage_rate_30y"),
            "LOAN_AGE_AT_OBS": F.lit(age),
        }
    )
    return select_available(rows, _PD_COLUMNS)


def lgd_dataset(outcomes: DataFrame, macro: DataFrame) -> DataFrame:
    """Loss severity of defaulted loans: realised when liquidated, else an LTV proxy.

    The two kinds are disjoint, so one pass with a CASE replaces a union of two scans;
    ``lgd_source`` tells them apart.
    """
    realised = F.col("liquidated") & F.col("lgd_observed").isNotNull()
    rows = outcomes.where(F.col("defaulted")).withColumns(
        {
            "lgd_source": F.when(realised, "observed").otherwise("synthetic_ltv"),
            "lgd_observed": F.when(realised, F.col("lgd_observed")).otherwise(
                R.ltv_loss_proxy(F.col("ORIGINAL_LTV"))
            ),
            "EAD": F.coalesce("EAD", "ORIGINAL_UPB"),
            "LOAN_AGE_AT_DEFAULT": F.coalesce("time_to_default_months", "observed_months").cast(
                "float"
            ),
            "_month": L.default_month(F.col("ORIGINATION_DATE"), F.col("time_to_default_months")),
        }
    )
    names = {
        "date": "_month",
        "unemployment_rate": "unemployment_rate_at_default",
        "hpi_yoy_chg": "hpi_yoy_chg_at_default",
        "mortgage_rate_30y": "rate_at_default",
        "financial_stress_idx": "fsi_at_default",
    }
    usable = F.col("lgd_observed").between(0, 1) & (F.col("EAD") > 0)
    joined = rows.where(usable).join(at_month(macro, names), "_month", "left")
    return select_available(joined, _LGD_COLUMNS)


def with_split(df: DataFrame, years: dict[str, Sequence[int]] | None = None) -> DataFrame:
    """Tag rows train / valid / test by vintage (``years``); other vintages are dropped."""
    years = S.SPLIT_YEARS if years is None else years
    tag = reduce(
        lambda chain, kv: chain.when(F.col("VINTAGE_YEAR").isin(*kv[1]), F.lit(kv[0])),
        years.items(),
        F,
    )
    return df.withColumn("split", tag.otherwise(F.lit(None).cast("string"))).where(
        F.col("split").isNotNull()
    )


def fill_empty_splits(df: DataFrame, key: str = S.LOAN) -> DataFrame:
    """Make sure validation and test rows exist.

    Without validation rows, a fifth of the training rows (by the first digits of the key's md5,
    so the choice is stable and needs no sort) becomes validation. Without test rows, the
    validation rows serve as test too.
    """
    sizes = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}  # 3 rows
    if not sizes.get("train"):
        raise ValueError("no training rows")
    if not sizes.get("valid"):
        digits = F.substring(F.md5(F.coalesce(F.col(key), F.lit("")).cast("binary")), 1, 8)
        held_out = (F.col("split") == "train") & (F.conv(digits, 16, 10).cast("long") % 5 == 4)
        df = df.withColumn("split", F.when(held_out, F.lit("valid")).otherwise(F.col("split")))
    if not sizes.get("test"):
        test = df.where(F.col("split") == "valid").withColumn("split", F.lit("test"))
        df = df.unionByName(test)
    return df


def class_weights(df: DataFrame, label: str = "PD_TARGET") -> DataFrame:
    """Class counts, the positive-class weight and the balanced class weights."""
    positive = F.count_if(F.col(label) == 1)
    negative = F.count_if(F.col(label) == 0)
    rows = F.count(F.col(label))
    return df.agg(
        negative.alias("negatives"),
        positive.alias("positives"),
        (negative / F.greatest(positive, F.lit(1))).alias("scale_pos_weight"),
        (rows / F.nullif(2 * negative, F.lit(0))).alias("weight_negative"),
        (rows / F.nullif(2 * positive, F.lit(0))).alias("weight_positive"),
    )
