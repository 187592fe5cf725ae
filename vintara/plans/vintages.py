"""Default curves by vintage and observation year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.session import write_through


def loan_years(servicing: DataFrame, origination: DataFrame) -> DataFrame:
    """One row per loan and observation year with its vintage and defaulted months.

    The servicing rows are reduced to loan-years before the join, and counting distinct loans
    per year becomes a plain count.
    """
    per_year = (
        servicing.where(F.col(S.LOAN).isNotNull() & F.col("REPORTING_DATE").isNotNull())
        .groupBy(S.LOAN, F.year("REPORTING_DATE").alias("obs_year"))
        .agg(F.count_if("IS_DEFAULTED").alias("defaulted_months"))
    )
    vintages = origination.select(S.LOAN, F.col("VINTAGE_YEAR").alias("vintage_year"))
    return per_year.join(vintages, S.LOAN).where(F.col("vintage_year").isNotNull())


def vintage_curves(loan_years: DataFrame) -> DataFrame:
    """Defaulted loan-months over distinct loans, by vintage and observation year."""
    curves = loan_years.groupBy("vintage_year", "obs_year").agg(
        F.count("*").alias("total_loans"), F.sum("defaulted_months").alias("defaulted")
    )
    return curves.withColumn("default_rate", F.col("defaulted") / F.col("total_loans"))


def cumulative_curves(loan_years: DataFrame) -> DataFrame:
    """Share of a vintage's observed loans that have defaulted by each observation year.

    One pass: the first window spans a loan's years (one row each, so a few dozen at most) and
    reuses the partitioning by loan; the later ones run on the small (vintage, year) table.
    """
    own = W.partitionBy(S.LOAN, "vintage_year")
    first = F.min(F.when(F.col("defaulted_months") > 0, F.col("obs_year"))).over(own)
    entry = F.min("obs_year").over(own)
    per_year = (
        loan_years.withColumns({"_first": first, "_entry": entry})
        .groupBy("vintage_year", "obs_year")
        .agg(
            F.count_if(F.col("obs_year") == F.col("_first")).alias("_new"),
            F.count_if(F.col("obs_year") == F.col("_entry")).alias("_entered"),
        )
    )
    whole = W.partitionBy("vintage_year")
    running = whole.orderBy("obs_year").rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_year.select(
        "vintage_year",
        "obs_year",
        F.sum("_entered").over(whole).alias("vintage_loans"),
        F.sum("_new").over(running).alias("cumulative_defaults"),
    ).withColumn("cumulative_default_rate", F.col("cumulative_defaults") / F.col("vintage_loans"))


def vintage_pivot(curves: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """One row per observation year, one column per vintage, rate in percent to 3 places.

    Vintages are those of ``curves``, or the given ``years``. The curves, a few rows per vintage,
    are stored, as they are read for their vintages first.
    """
    percent = F.round(F.col("default_rate") * 100, 3)
    if years is None:
        curves = write_through(curves, "vintage-curves")
        rows = curves.where(F.col("vintage_year").isNotNull()).select("vintage_year").distinct().collect()
        years = sorted(r["vintage_year"] for r in rows)
    return curves.groupBy("obs_year").pivot("vintage_year", list(years)).agg(F.max(percent))


def vintage_series(curves: DataFrame) -> DataFrame:
    """One row per vintage with its points in order of observation year, at most one per year."""
    point = F.struct("obs_year", "default_rate", "total_loans")
    return curves.groupBy("vintage_year").agg(F.array_sort(F.collect_list(point)).alias("data"))
