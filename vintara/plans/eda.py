"""Exploratory summaries of loans and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.functions import risk as R
from vintara.operators.ordered import histogram, known_values, quantiles_of_rows


def default_rate_by_vintage(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("VINTAGE_YEAR").isNotNull()).groupBy("VINTAGE_YEAR").agg(
        F.avg(F.col("defaulted").cast("int")).alias("default_rate"), F.count("*").alias("loans")
    )


def default_rate_by_fico(outcomes: DataFrame) -> DataFrame:
    banded = outcomes.withColumn("fico_band", R.fico_band(F.col("CREDIT_SCORE")))
    rates = banded.where(F.col("fico_band").isNotNull()).groupBy("fico_band").agg(
        (F.avg(F.col("defaulted").cast("int")) * 100).alias("default_rate_pct")
    )
    return rates.withColumn("band_order", R.band_order(F.col("fico_band")))


def fico_histogram(origination: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(origination, ["VINTAGE_YEAR"], "CREDIT_SCORE", bins)


def ltv_histogram(origination: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(origination, [], "ORIGINAL_LTV", bins)


def lgd_histogram(outcomes: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(outcomes, [], "lgd_observed", bins)


def mean_and_median(df: DataFrame, value: str) -> DataFrame:
    """One row: mean and exact median of a column."""
    rows = known_values(df, [], value)
    median = quantiles_of_rows(rows, [], value, [0.5]).select("quantile").scalar()
    return rows.agg(F.avg(value).alias("mean_value")).withColumn("median_value", median)


def top_states_by_loans(origination: DataFrame, n: int = 15) -> DataFrame:
    """The n states with most loans; ties go to the alphabetically first."""
    counts = origination.where(F.col("PROPERTY_STATE").isNotNull()).groupBy("PROPERTY_STATE")
    return counts.agg(F.count("*").alias("loans")).orderBy(F.desc("loans"), "PROPERTY_STATE").limit(n)


def portfolio_summary(outcomes: DataFrame) -> DataFrame:
    """Ten summary numbers in one pass over outcomes, which carry every originated loan."""

    def share(condition: Column) -> Column:
        return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))

    return outcomes.agg(
        F.count("*").alias("total_loans"),
        F.sum("ORIGINAL_UPB").alias("total_upb"),
        F.avg("CREDIT_SCORE").alias("avg_fico"),
        F.avg("ORIGINAL_LTV").alias("avg_ltv"),
        F.avg("ORIGINAL_INTEREST_RATE").alias("avg_rate"),
        share(F.col("defaulted")).alias("default_rate"),
        share(F.col("prepaid")).alias("prepay_rate"),
        F.avg("lgd_observed").alias("mean_lgd"),
        share(F.col("PRODUCT_TYPE") == "FRM").alias("frm_share"),
        share(F.col("LOAN_PURPOSE") == "C").alias("purchase_share"),
    )
