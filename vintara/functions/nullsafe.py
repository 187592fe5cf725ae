"""Null-safe column helpers shared by every job.

Spark's ``greatest``/``least`` skip nulls, ANSI casts raise, NaN sorts above every number and
division by zero raises; each helper pins the behaviour the data products need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.schema import NULL_TOKENS


def clip(x: Column, lo: float | Column, hi: float | Column) -> Column:
    """Bound ``x`` to [lo, hi]; null stays null."""
    return F.when(x.isNotNull(), F.greatest(_lit(lo), F.least(_lit(hi), x)))


def flag(condition: Column) -> Column:
    """A condition as a two-valued flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null on a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def blank_to_null(c: Column) -> Column:
    """Null for the tokens a text file uses for a missing value."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal literal becomes null.

    The cast alone also takes type suffixes, hexadecimal, 'nan' and 'infinity'; all but
    hexadecimal end in a letter.
    """
    text = F.trim(c)
    plain = (F.right(text, F.lit(1)) <= "9") & ~F.contains(F.lower(text), F.lit("x"))
    return F.when(plain, text.try_cast("double"))


def narrow(value: Column, kind: str) -> Column:
    """Double to a column type; fractions and overflow become null for integers."""
    if kind in ("short", "byte"):
        return F.when(value == F.floor(value), value).try_cast(kind)
    return value.cast(kind)


def to_month(c: Column) -> Column:
    """'YYYYMM' text to the first day of that month; bad text becomes null."""
    return F.try_to_date(F.trim(c), "yyyyMM")


def month_of(c: Column) -> Column:
    return F.trunc(c, "MM")


def columns_present(df: DataFrame, names: tuple[str, ...] | list[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in names if c in present]


def select_available(df: DataFrame, names: tuple[str, ...] | list[str]) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    return df.select(*columns_present(df, names))


def col_or(df: DataFrame, name: str, default: object) -> Column:
    """The column with nulls replaced by ``default``, or the default when it is absent."""
    if name not in df.columns:
        return F.lit(default)
    return F.col(name) if default is None else F.coalesce(F.col(name), F.lit(default))


def _lit(x: float | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))
