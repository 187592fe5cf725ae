"""Parquet tables partitioned by vintage year, and JSON result documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara import schema as S


def write_by_vintage(df: DataFrame, path: str, sort_by: tuple[str, ...] = ()) -> None:
    """Write one Parquet folder per vintage year; rerunning a year replaces only that year.

    Rows are rebalanced by year and, with ``sort_by``, its first column: the input runs once (a
    range partitioning would run it twice, for its sample), and adaptive execution splits a
    year or loan with a large share of the rows and joins small partitions, so that a year has
    few files of even size. ``sort_by`` orders the rows of each file.
    """
    keys = ["VINTAGE_YEAR", *sort_by]
    df = df.hint("rebalance", *[F.col(k) for k in keys[:2]])
    if sort_by:
        df = df.sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in keys])
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("VINTAGE_YEAR")
        .parquet(path)
    )


def read_vintages(
    spark: SparkSession, path: str, years: Iterable[int] | None = None
) -> DataFrame:
    """Read some vintage years (partition pruning), failing when one of them is absent."""
    df = spark.read.parquet(path)
    if years is None:
        return df
    wanted = sorted(set(years))
    df = df.where(F.col("VINTAGE_YEAR").isin(wanted))
    # At most one row per requested year reaches the driver.
    found = {r[0] for r in df.select("VINTAGE_YEAR").distinct().collect()}
    missing = [y for y in wanted if y not in found]
    if missing:
        raise FileNotFoundError(f"no data for vintage years {missing} under {path}")
    return df


def combine_years(frames: list[DataFrame]) -> DataFrame:
    """One table out of per-year tables; a column missing in some years is null there."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def read_macro_observations(spark: SparkSession, path: str) -> DataFrame:
    """Irregular observations in long form: series_id, obs_date, value."""
    return spark.read.parquet(path).where(F.col("series_id").isin(*S.MACRO_SERIES))
