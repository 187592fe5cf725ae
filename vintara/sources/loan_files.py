"""Origination and servicing text files, one of each per vintage year."""

from __future__ import annotations

import re
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara import schema as S

# File (or folder) name of each year.
ORIGINATION_NAME = "sample_orig_{year}.txt"
SERVICING_NAME = "sample_svcg_{year}.txt"


def read_origination(
    spark: SparkSession,
    folder: str,
    years: Iterable[int] = S.VINTAGE_YEARS,
    name: str = ORIGINATION_NAME,
) -> DataFrame:
    return _read(spark, folder, name, S.ORIGINATION_COLUMNS, years)


def read_servicing(
    spark: SparkSession,
    folder: str,
    years: Iterable[int] = S.VINTAGE_YEARS,
    name: str = SERVICING_NAME,
) -> DataFrame:
    return _read(spark, folder, name, S.SERVICING_COLUMNS, years)


def year_of_file(name: str) -> Column:
    """Vintage year out of the path of the file a row came from."""
    pattern = re.escape(name).replace(re.escape("{year}"), r"(\d{4})")
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("int")


def _read(
    spark: SparkSession, folder: str, name: str, columns: tuple[str, ...], years: Iterable[int]
) -> DataFrame:
    """All years in one distributed read, every column as text.

    Naming each year's path makes Spark refuse the job when one is missing.
    """
    paths = [f"{folder.rstrip('/')}/{name.format(year=y)}" for y in years]
    raw = spark.read.schema(S.text_schema(columns)).option("sep", "|").csv(paths)
    return raw.select("*", year_of_file(name).alias("VINTAGE_YEAR"), row_sequence().alias("ROW_SEQ"))


def row_sequence(split_start: Column | None = None) -> Column:
    """Position of a row within its file, as one decimal.

    Above: the byte where the row's split starts. Below, 13 digits: the generated id without its
    task number, which counts the task's rows in reading order. Rows of one split have one task,
    so the two order the rows of a file.
    """
    start = F.col("_metadata.file_block_start") if split_start is None else split_start
    split = start.cast("decimal(17,0)")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (split * F.lit(Decimal(10**13)) + row.cast("decimal(13,0)")).cast("decimal(30,0)")


def malformed_lines(
    spark: SparkSession,
    folder: str,
    name: str,
    columns: tuple[str, ...],
    years: Iterable[int] = S.VINTAGE_YEARS,
) -> DataFrame:
    """Lines per year, and how many have too few or too many fields.

    The reader pads short lines and cuts long ones, so this is the place to notice them.
    """
    paths = [f"{folder.rstrip('/')}/{name.format(year=y)}" for y in years]
    lines = spark.read.text(paths).select("value", year_of_file(name).alias("VINTAGE_YEAR"))
    separators = F.length("value") - F.length(F.replace(F.col("value"), F.lit("|"), F.lit("")))
    return lines.groupBy("VINTAGE_YEAR").agg(
        F.count("*").alias("raw_rows"),
        F.count_if(separators != len(columns) - 1).alias("malformed_rows"),
    )
