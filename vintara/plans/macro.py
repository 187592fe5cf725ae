"""Monthly macro table from irregular observations, and the scenario baseline."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions.nullsafe import ratio


def _by_series() -> WindowSpec:
    return W.partitionBy("series_id").orderBy("month")


def monthly_last(observations: DataFrame) -> DataFrame:
    """Last non-null observation of each series and month: (series_id, month, value).

    Observations of one day follow ``obs_seq`` where the table has it. Of observations that tie
    (one day, no or one sequence number) the largest value counts. Day and sequence form one
    decimal, which keeps the aggregation a hash aggregation.
    """
    order = F.unix_date("obs_date").cast("decimal(18,0)") * F.lit(Decimal(10**19))
    if "obs_seq" in observations.columns:
        order = order + F.col("obs_seq").cast("decimal(19,0)")
    known = observations.where(F.col("value").isNotNull())
    month = F.trunc("obs_date", "MM").alias("month")
    settled = known.groupBy("series_id", month, order.alias("_order")).agg(F.max("value").alias("value"))
    return settled.groupBy("series_id", "month").agg(F.max_by("value", "_order").alias("value"))


def calendar(spark: SparkSession, start: str = S.MACRO_START, end: str = S.MACRO_END) -> DataFrame:
    """Every configured series at every month from start to end."""
    series = F.explode(F.array(*[F.lit(s) for s in S.MACRO_SERIES])).alias("series_id")
    months = F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month")
    )
    return spark.range(1).select(series).select("series_id", F.explode(months).alias("month"))


def filled_series(
    observations: DataFrame, start: str = S.MACRO_START, end: str = S.MACRO_END
) -> DataFrame:
    """Series on the full calendar, forward-filled, with 12-month and 1-month changes.

    Windows run per series over the fixed calendar (168 rows by default), whatever the number of
    observations.
    """
    by_series = _by_series()
    grid = calendar(observations.sparkSession, start, end)
    aligned = grid.join(monthly_last(observations), ["series_id", "month"], "left")
    filled = aligned.withColumn("value", F.last("value", ignorenulls=True).over(by_series))
    year_ago = F.lag("value", 12).over(by_series)
    return filled.withColumns(
        {
            "pct_change_12m": (ratio(F.col("value"), year_ago) - 1) * 100,
            "change_1m": F.col("value") - F.lag("value", 1).over(by_series),
        }
    )


def macro_table(
    observations: DataFrame, start: str = S.MACRO_START, end: str = S.MACRO_END
) -> DataFrame:
    """One row per month: the six series, house-price yearly and unemployment monthly change.

    The pivot list is fixed, so a series without observations is a null column.
    """
    filled = filled_series(observations, start, end)

    def series(series_id: str, column: str, name: str):
        return F.max(F.when(F.col("series_id") == series_id, F.col(column))).alias(name)

    return filled.groupBy(F.col("month").alias("date")).agg(
        *[series(sid, "value", name) for sid, name in S.MACRO_SERIES.items()],
        series("USSTHPI", "pct_change_12m", "hpi_yoy_chg"),
        series("UNRATE", "change_1m", "unrate_chg_mom"),
    )


def baseline_macro(macro: DataFrame, year: int = S.BASELINE_YEAR) -> DataFrame:
    """One row: the mean of each macro value over the baseline year, else its fixed default."""
    names = [c for c in macro.columns if c != "date"]

    def mean(name: str):
        value = F.avg(F.col(name).cast("double"))
        if name in S.BASELINE_DEFAULTS:
            value = F.coalesce(value, F.lit(S.BASELINE_DEFAULTS[name]))
        return value.alias(name)

    return macro.where(F.year("date") == year).agg(*[mean(n) for n in names])


def default_baseline(spark: SparkSession) -> DataFrame:
    """The fixed baseline, for use without a macro table."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in S.BASELINE_DEFAULTS.items()])


def at_month(macro: DataFrame, names: dict[str, str]) -> DataFrame:
    """Macro columns renamed for a join on a month column; a month with several rows is an error.

    The table has a row per calendar month, so Spark's own size check broadcasts it.
    """
    once = F.count(F.lit(1)) == 1
    broken = F.raise_error(F.lit("the macro table has several rows of one month"))

    def value(name: str, alias: str):
        return F.when(once, F.max(name)).otherwise(broken.cast("double")).alias(alias)

    values = [value(c, alias) for c, alias in names.items() if c != "date"]
    return macro.groupBy(F.trunc("date", "MM").alias(names["date"])).agg(*values)
