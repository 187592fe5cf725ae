"""Stateless cleaning of the two loan files, and first-occurrence de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import loans as L
from vintara.functions.nullsafe import blank_to_null, columns_present, narrow, to_month, to_number


def clean_codes(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Trim code columns; blank and the "9"/"99" sentinels become null.

    Columns in CODES_KEEPING_NINE treat "9" as a value. Absent columns are skipped.
    """
    return df.withColumns({c: _code(c) for c in columns_present(df, columns)})


def _code(name: str) -> Column:
    text = F.trim(F.col(name))
    missing = ("",) if name in S.CODES_KEEPING_NINE else ("", *S.CODE_SENTINELS)
    return F.when(~text.isin(*missing), text)


def _without_null_tokens(raw: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return raw.withColumns({c: blank_to_null(F.col(c)) for c in columns_present(raw, columns)})


def _typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Text columns to numbers of the given kinds, sentinels to null.

    Two projections, so that the parsed double is computed once however often the narrowing
    expression uses it. A null token is not a number, so it needs no rule of its own here.
    """
    names = columns_present(df, tuple(kinds))
    parsed = df.withColumns({c: to_number(F.col(c)) for c in names})

    def final(name: str) -> Column:
        value = F.col(name)
        if name in S.NUMERIC_SENTINELS:
            value = F.nullif(value, F.lit(float(S.NUMERIC_SENTINELS[name])))
        return narrow(value, kinds[name])

    return parsed.withColumns({c: final(c) for c in names})


def clean_origination(raw: DataFrame) -> DataFrame:
    """Typed origination rows from text rows tagged with VINTAGE_YEAR."""
    df = _typed(_without_null_tokens(raw, S.ORIGINATION_CODES), S.ORIGINATION_NUMBERS)
    months = {c: to_month(F.col(c)) for c in columns_present(df, S.ORIGINATION_MONTHS)}
    df = clean_codes(df.withColumns(months), S.ORIGINATION_CODES)
    return df.withColumn("ORIGINATION_DATE", F.add_months("FIRST_PAYMENT_DATE", -1))


def clean_servicing(raw: DataFrame) -> DataFrame:
    """Typed servicing rows with event flags from text rows.

    Every output row depends on one input row only, so the same projection serves batch reads
    of any size and streaming reads.
    """
    text = tuple(c for c in S.SERVICING_COLUMNS if c not in S.SERVICING_NUMBERS)
    df = _typed(_without_null_tokens(raw, text), S.SERVICING_NUMBERS)
    dates = {
        "REPORTING_DATE": to_month(F.col("MONTHLY_REPORTING_PERIOD")),
        "ZERO_BALANCE_DATE": to_month(F.col("ZERO_BALANCE_EFFECTIVE_DATE")),
    }
    return add_event_flags(df.withColumns(dates))


def add_event_flags(df: DataFrame) -> DataFrame:
    """Normalise the delinquency status and derive the five event flags."""
    df = df.withColumn(
        "CURRENT_LOAN_DELINQUENCY_STATUS",
        L.delinquency_status(F.col("CURRENT_LOAN_DELINQUENCY_STATUS")),
    )
    status, code = F.col("CURRENT_LOAN_DELINQUENCY_STATUS"), F.col("ZERO_BALANCE_CODE")
    serious, liquidated = L.is_seriously_delinquent(status), L.is_liquidated(code)
    return df.withColumns(
        {
            "IS_SERIOUSLY_DELINQUENT": serious,
            "IS_ZERO_BALANCE": L.is_zero_balance(code),
            "IS_PREPAID": L.is_prepaid(code),
            "IS_LIQUIDATED": liquidated,
            "IS_DEFAULTED": serious | liquidated,
        }
    )


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the first in ``order``, which differs between the rows of a key.

    Only keys and positions are aggregated, by hashing, and each task reduces its own rows
    before the shuffle. Keys with several rows, few as a rule, then meet the whole rows in a
    join whose way Spark chooses by their measured size; later copies drop out there. A key with
    very many copies is one row on the small side, and skew handling splits the other.
    """
    several = df.groupBy(*keys).agg(F.count("*").alias("_copies"), F.min(order).alias("_first"))
    several = several.where(F.col("_copies") > 1).select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_first")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    marked = df.join(several, same, "left")
    first = F.col("_first").isNull() | (F.col(order) == F.col("_first"))
    return marked.where(first).select(*df.columns)


def load_audit(df: DataFrame) -> DataFrame:
    """Rows and duplicate loan ids per vintage year, before de-duplication."""
    per_loan = df.groupBy("VINTAGE_YEAR", S.LOAN).agg(F.count("*").alias("copies"))
    return per_loan.groupBy("VINTAGE_YEAR").agg(
        F.sum("copies").alias("raw_rows"),
        F.sum(F.col("copies") - 1).alias("duplicate_rows"),
        F.count("*").alias("clean_rows"),
    )
