"""Loan-shaped views of the given star-schema tables.

Each view is a set of row-wise expressions over a join of the given tables, so it grows with
them. The expression text is portable: the SQL checks reuse it for their input views, never for
the operators under test. Dirty values (padded and lower-case codes, sentinels, bad dates,
duplicates, nulls) are on purpose.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Months since year 0 of the loan's origination (orders shifted by 15 years) and of a record.
_ORIG_INDEX = "(extract(year from o_orderdate) * 12 + extract(month from o_orderdate) + 179)"
_LINE_INDEX = f"({_ORIG_INDEX} + (l_linenumber - 1) * 6)"


def _month_start(index: str) -> str:
    return f"make_date(cast(floor(({index}) / 12) as int), cast(({index}) % 12 + 1 as int), 1)"


_ORIG_MONTH = _month_start(_ORIG_INDEX)
_LINE_MONTH = _month_start(_LINE_INDEX)


def _loan_id(key: str) -> str:
    return f"concat('F', lpad(cast({key} as string), 11, '0'))"


def _yyyymm(index: str) -> str:
    return f"cast(cast(floor(({index}) / 12) as int) * 100 + ({index}) % 12 + 1 as string)"


# One row per loan, already clean.
ORIGINATION = {
    "LOAN_SEQUENCE_NUMBER": _loan_id("o_orderkey"),
    "VINTAGE_YEAR": "cast(extract(year from o_orderdate) as int) + 15",
    "ORIGINATION_DATE": _ORIG_MONTH,
    "CREDIT_SCORE": "cast(case when o_orderkey % 50 = 0 then null else 560 + o_orderkey * 37 % 290 end as int)",
    "ORIGINAL_LTV": "cast(case when o_custkey % 60 = 0 then null else 40 + o_custkey % 75 end as double)",
    "ORIGINAL_CLTV": "cast(case when o_custkey % 60 = 0 then null else 42 + o_custkey % 75 end as double)",
    "ORIGINAL_DTI": "cast(case when o_orderkey % 40 = 0 then null else 15 + o_orderkey % 36 end as double)",
    "ORIGINAL_UPB": "o_totalprice",
    "ORIGINAL_INTEREST_RATE": "cast(300 + o_orderkey % 250 as double) / cast(100 as double)",
    "ORIGINAL_LOAN_TERM": "cast(case when o_orderkey % 3 = 0 then 180 else 360 end as int)",
    "OCC_STATUS": "case o_orderstatus when 'O' then 'P' when 'P' then 'I' else 'S' end",
    "LOAN_PURPOSE": "case when o_orderkey % 45 = 0 then '9' when o_orderkey % 3 = 0 then 'C' when o_orderkey % 3 = 1 then 'N' else 'R' end",
    "PROPERTY_TYPE": "case c_mktsegment when 'BUILDING' then 'SF' when 'MACHINERY' then 'CO' when 'AUTOMOBILE' then 'PU' when 'FURNITURE' then 'MH' else null end",
    "PROPERTY_STATE": "n_name",
    "PRODUCT_TYPE": "case when o_orderpriority = '5-LOW' then 'ARM' else 'FRM' end",
    "CHANNEL": "case when o_orderkey % 4 = 0 then 'R' when o_orderkey % 4 = 1 then 'B' when o_orderkey % 4 = 2 then 'C' else null end",
    "FIRST_TIME_HOMEBUYER_FLAG": "case when o_custkey % 2 = 0 then 'Y' else 'N' end",
    "MI_PCT": "cast(case when o_orderkey % 5 = 0 then 25 else 0 end as double)",
}

# One row per loan-month record, before event flags. ROW_SEQ stands for file order: line
# number, ship date and part packed into one number (no window needed).
SERVICING = {
    "LOAN_SEQUENCE_NUMBER": _loan_id("l_orderkey"),
    "ROW_SEQ": "(cast(l_linenumber as bigint) * 16384 + (extract(year from l_shipdate) - 1980) * 372 + extract(month from l_shipdate) * 31 + extract(day from l_shipdate)) * 34359738368 + l_partkey",
    "REPORTING_DATE": f"case when l_partkey % 997 = 0 then null else {_LINE_MONTH} end",
    "LOAN_AGE": "cast(case when l_partkey % 25 = 0 then null else (l_linenumber - 1) * 6 end as int)",
    "CURRENT_LOAN_DELINQUENCY_STATUS": "case when l_quantity >= 49 then ' xx' when l_quantity >= 48 then 'RA' when l_quantity >= 47 then '24' when l_quantity >= 46 then '10' when l_quantity >= 44 then '3' when l_quantity >= 40 then '2' when l_quantity >= 34 then '1' when l_quantity >= 33 then null else '0' end",
    "ZERO_BALANCE_CODE": "case when l_linenumber >= 6 and l_returnflag = 'R' then '01' when l_linenumber >= 5 and l_returnflag = 'A' and l_discount > cast(0.075 as double) then '03 ' when l_linenumber >= 5 and l_returnflag = 'A' and l_discount > cast(0.065 as double) then '09' when l_linenumber = 7 and l_returnflag = 'N' and l_discount < cast(0.005 as double) then '96' else null end",
    "ZERO_BALANCE_DATE": f"case when l_linenumber >= 5 and l_suppkey % 3 <> 0 then {_month_start(_LINE_INDEX + ' + 1')} else null end",
    "CURRENT_ACTUAL_UPB": "case when l_linenumber >= 5 and l_returnflag in ('A','R') then cast(0 as double) when l_partkey % 31 = 0 then null else l_extendedprice end",
    "MODIFICATION_FLAG": "case when l_quantity >= 31 and l_quantity < 32 then 'Y' when l_quantity >= 30 and l_quantity < 31 then 'P' else null end",
    "NET_SALES_PROCEEDS": "case when l_linenumber >= 5 and l_returnflag = 'A' and l_suppkey % 2 = 0 then l_extendedprice * cast(0.5 as double) else null end",
    "MI_RECOVERIES": "case when l_linenumber >= 5 and l_returnflag = 'A' then l_extendedprice * l_tax else null end",
    "NON_MI_RECOVERIES": "case when l_linenumber >= 5 and l_returnflag = 'A' and l_suppkey % 5 = 0 then l_extendedprice * l_discount else null end",
    "EXPENSES": "case when l_linenumber >= 5 and l_returnflag = 'A' then l_quantity * cast(10 as double) else null end",
    "ACTUAL_LOSS_CALCULATION": "case when l_linenumber >= 5 and l_returnflag = 'A' and l_suppkey % 7 = 0 then l_extendedprice * cast(0.3 as double) else null end",
}

# Value of each macro series at one order date; None marks a series without observations.
_MACRO_VALUES = {
    "UNRATE": "cast(400 + o_orderkey % 600 as double) / cast(100 as double)",
    "USSTHPI": "cast(15000 + o_orderkey % 5000 as double) / cast(100 as double)",
    "MORTGAGE30US": "cast(300 + o_orderkey % 250 as double) / cast(100 as double)",
    "STLFSI4": "cast(o_orderkey % 400 - 200 as double) / cast(100 as double)",
}
MACRO_OBSERVATION = {
    "series_id": "series_id",
    "obs_date": "cast(o_orderdate + interval 180 month as date)",
    "obs_seq": "o_orderkey",
    "value": "case series_id "
    + " ".join(f"when '{k}' then {v}" for k, v in _MACRO_VALUES.items())
    + " end",
}
MACRO_FILTER = "series_id <> 'USSTHPI' or extract(month from o_orderdate) in (1, 4, 7, 10)"
MACRO_IDS = tuple(_MACRO_VALUES)

# Text rows as a file would hold them, all 32 columns, with dirty values.
RAW_ORIGINATION = {
    "CREDIT_SCORE": "case o_orderkey % 50 when 0 then '9999' when 1 then 'NA' when 2 then ' ' when 3 then 'abc' when 4 then concat(' ', cast(560 + o_orderkey * 37 % 290 as string), ' ') when 5 then '70000' when 6 then '700.0' else cast(560 + o_orderkey * 37 % 290 as string) end",
    "FIRST_PAYMENT_DATE": f"case o_orderkey % 97 when 0 then '201013' when 1 then '' when 2 then '2010' when 3 then concat(' ', {_yyyymm(_ORIG_INDEX)}, ' ') else {_yyyymm(_ORIG_INDEX)} end",
    "FIRST_TIME_HOMEBUYER_FLAG": "case when o_custkey % 7 = 0 then '9' when o_custkey % 2 = 0 then 'Y' else 'N' end",
    "MATURITY_DATE": f"case when o_orderkey % 89 = 0 then 'null' else {_yyyymm('(' + _ORIG_INDEX + ' + 360)')} end",
    "MSA": "case when o_custkey % 4 = 0 then '' else cast(10000 + o_custkey % 900 as string) end",
    "MI_PCT": "case when o_orderkey % 5 = 0 then '25' when o_orderkey % 5 = 1 then '000' else '0' end",
    "NUMBER_OF_UNITS": "case when o_orderkey % 33 = 0 then '300' else cast(1 + o_orderkey % 4 as string) end",
    "OCC_STATUS": "case when o_orderkey % 30 = 0 then ' 9 ' when o_orderstatus = 'O' then 'P' when o_orderstatus = 'P' then 'I' else 'S' end",
    "ORIGINAL_CLTV": "cast(42 + o_custkey % 75 as string)",
    "ORIGINAL_DTI": "case when o_orderkey % 40 = 0 then '999' when o_orderkey % 40 = 1 then 'n/a' else cast(15 + o_orderkey % 36 as string) end",
    "ORIGINAL_UPB": "cast(1000 * (50 + o_orderkey % 400) as string)",
    "ORIGINAL_LTV": "case when o_custkey % 60 = 0 then '999' else cast(40 + o_custkey % 75 as string) end",
    "ORIGINAL_INTEREST_RATE": "concat(cast(3 + o_orderkey % 3 as string), '.', lpad(cast(o_orderkey % 100 as string), 2, '0'))",
    "CHANNEL": "case when o_orderkey % 4 = 0 then 'R ' when o_orderkey % 4 = 1 then 'B' when o_orderkey % 4 = 2 then 'C' else '9' end",
    "PPM_FLAG": "case when o_orderkey % 9 = 0 then 'Y' else 'N' end",
    "PRODUCT_TYPE": "case when o_orderpriority = '5-LOW' then 'ARM' else 'FRM' end",
    "PROPERTY_STATE": "n_name",
    "PROPERTY_TYPE": "case c_mktsegment when 'BUILDING' then 'SF' when 'MACHINERY' then 'CO' when 'AUTOMOBILE' then 'PU' when 'FURNITURE' then 'MH' else '99' end",
    "POSTAL_CODE": "concat(cast(100 + o_custkey % 800 as string), '00')",
    "LOAN_SEQUENCE_NUMBER": _loan_id("(o_orderkey - case when o_orderkey % 20 = 7 then 1 else 0 end)"),
    "LOAN_PURPOSE": "case when o_orderkey % 45 = 0 then ' 9 ' when o_orderkey % 45 = 1 then '   ' when o_orderkey % 3 = 0 then 'C' when o_orderkey % 3 = 1 then 'N' else 'R' end",
    "ORIGINAL_LOAN_TERM": "case when o_orderkey % 3 = 0 then '180' else '360' end",
    "NUMBER_OF_BORROWERS": "case when o_orderkey % 11 = 0 then '99' else concat('0', cast(1 + o_orderkey % 2 as string)) end",
    "SELLER_NAME": "concat('SELLER ', cast(o_custkey % 20 as string))",
    "SERVICER_NAME": "concat('SERVICER ', cast(o_custkey % 15 as string))",
    "SUPER_CONFORMING_FLAG": "case when o_orderkey % 6 = 0 then 'Y' else '' end",
    "PRE_HARP_LOAN_SEQUENCE_NUMBER": "case when o_orderkey % 100 = 0 then concat('A', cast(o_orderkey as string)) else '' end",
    "PROGRAM_INDICATOR": "case when o_orderkey % 8 = 0 then 'H' else '9' end",
    "HARP_INDICATOR": "case when o_orderkey % 100 = 0 then 'Y' else '' end",
    "PROPERTY_VALUATION_METHOD": "cast(1 + o_orderkey % 9 as string)",
    "IO_INDICATOR": "'N'",
    "MI_CANCELLATION_INDICATOR": "case when o_orderkey % 5 = 0 then 'Y' when o_orderkey % 5 = 1 then 'N' else '9' end",
}
RAW_SERVICING = {
    "LOAN_SEQUENCE_NUMBER": _loan_id("l_orderkey"),
    "MONTHLY_REPORTING_PERIOD": f"case when l_partkey % 997 = 0 then '209913' when l_partkey % 997 = 1 then '' else {_yyyymm(_LINE_INDEX)} end",
    "CURRENT_ACTUAL_UPB": "case when l_linenumber >= 5 and l_returnflag in ('A','R') then '0' when l_partkey % 31 = 0 then 'NaN' else concat(cast(l_partkey * 3 + 1000 as string), '.25') end",
    "CURRENT_LOAN_DELINQUENCY_STATUS": SERVICING["CURRENT_LOAN_DELINQUENCY_STATUS"],
    "LOAN_AGE": "case when l_partkey % 25 = 0 then '' when l_partkey % 25 = 1 then '40000' else cast((l_linenumber - 1) * 6 as string) end",
    "REMAINING_MONTHS_TO_MATURITY": "cast(360 - (l_linenumber - 1) * 6 as string)",
    "REPURCHASE_MAKE_WHOLE_PROCEEDS_FLAG": "case when l_partkey % 50 = 0 then 'Y' else '' end",
    "MODIFICATION_FLAG": SERVICING["MODIFICATION_FLAG"],
    "ZERO_BALANCE_CODE": SERVICING["ZERO_BALANCE_CODE"],
    "ZERO_BALANCE_EFFECTIVE_DATE": f"case when l_linenumber >= 5 and l_suppkey % 3 <> 0 then concat(' ', {_yyyymm(_LINE_INDEX)}) else null end",
    "CURRENT_INTEREST_RATE": "concat(cast(3 + l_partkey % 3 as string), '.5')",
    "CURRENT_DEFERRED_UPB": "'0'",
    "DDLPI": _yyyymm(_LINE_INDEX),
    "MI_RECOVERIES": "case when l_linenumber >= 5 and l_returnflag = 'A' then cast(l_suppkey * 7 as string) else null end",
    "NET_SALES_PROCEEDS": "case when l_linenumber >= 5 and l_returnflag = 'A' then case when l_suppkey % 4 = 0 then 'C' else cast(l_suppkey * 11 as string) end else null end",
    "NON_MI_RECOVERIES": "case when l_linenumber >= 5 and l_returnflag = 'A' then '-12.5' else null end",
    "EXPENSES": "case when l_linenumber >= 5 and l_returnflag = 'A' then '1e3' else null end",
    "LEGAL_COSTS": "case when l_partkey % 13 = 0 then ' 15 ' else null end",
    "MAINTENANCE_PRESERVATION_COSTS": "case when l_partkey % 13 = 1 then '.5' else null end",
    "TAXES_INSURANCE": "case when l_partkey % 13 = 2 then '7.' else null end",
    "MISCELLANEOUS_EXPENSES": "case when l_partkey % 13 = 3 then '+3' else null end",
    "ACTUAL_LOSS_CALCULATION": "case when l_linenumber >= 5 and l_returnflag = 'A' and l_suppkey % 7 = 0 then cast(l_partkey as string) else null end",
    "MODIFICATION_RELATED_NON_INTEREST_BEARING_UPB": "case when l_partkey % 13 = 4 then 'null' else '0' end",
    "PRINCIPAL_FORGIVENESS_UPB": "'0'",
    "ORIGINAL_LIST_START_DATE": "''",
    "ORIGINAL_LIST_PRICE": "case when l_partkey % 13 = 5 then '1d' else '0' end",
    "CURRENT_LIST_START_DATE": "''",
    "CURRENT_LIST_PRICE": "case when l_partkey % 13 = 6 then '<NA>' else '0' end",
    "BORROWER_ASSISTANCE_PLAN": "case when l_partkey % 29 = 0 then 'F' else '' end",
    "VALUE_OF_DELINQUENT_ACCRUED_INTEREST": "'0'",
    "CURRENT_NON_INTEREST_BEARING_UPB": "'0'",
    "CURRENT_UPB_SCHEDULED": "cast(l_partkey * 2 as string)",
}

# Scoring applications and scenario requests, some outside the allowed bounds. Balances are
# whole cents.
APPLICATIONS = {
    "application_id": "o_orderkey",
    "credit_score": "cast(case when o_orderkey % 50 = 0 then null when o_orderkey % 50 = 1 then 250 + o_orderkey % 40 else 560 + o_orderkey * 37 % 320 end as int)",
    "original_ltv": "cast(case when o_custkey % 60 = 0 then null else 40 + o_custkey % 175 end as double)",
    "original_cltv": "cast(42 + o_custkey % 160 as double)",
    "original_dti": "cast(15 + o_orderkey % 60 as double)",
    "original_upb": "floor(o_totalprice * 5) / cast(100 as double)",
    "original_interest_rate": "cast(300 + o_orderkey % 250 as double) / cast(100 as double)",
    "original_loan_term": "cast(case when o_orderkey % 101 = 0 then 600 when o_orderkey % 3 = 0 then 180 else 360 end as int)",
    "occ_status": "case o_orderstatus when 'O' then 'P' when 'P' then 'I' else 'S' end",
    "loan_purpose": "case when o_orderkey % 3 = 0 then 'C' when o_orderkey % 3 = 1 then 'N' else 'R' end",
    "property_type": "cast(null as string)",
    "property_state": "cast(null as string)",
    "product_type": "case when o_orderpriority = '5-LOW' then 'ARM' else 'FRM' end",
    "channel": "'R'",
    "first_time_homebuyer": "case when o_custkey % 2 = 0 then 'Y' else 'N' end",
    "mi_pct": "cast(case when o_orderkey % 5 = 0 then 25 else 0 end as double)",
    "unemployment_shock": "cast(o_orderkey % 27 - 5 as double)",
    "hpi_shock": "cast(o_orderkey % 71 - 51 as double)",
    "rate_shock": "cast(case when o_orderkey % 6 = 0 then null else o_orderkey % 14 - 3 end as double)",
}

FROM_ORDERS = "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"
FROM_LINES = "lineitem join orders on l_orderkey = o_orderkey"


@cache
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, view: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} as {name}" for name, text in view.items()])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    return (
        _table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return _table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def origination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_orders(spark, sf_dir), ORIGINATION)


def servicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_lines(spark, sf_dir), SERVICING)


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = F.explode(F.array(*[F.lit(s) for s in MACRO_IDS])).alias("series_id")
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", series)
    return _project(rows.where(MACRO_FILTER), MACRO_OBSERVATION)


def raw_origination(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = {**RAW_ORIGINATION, "VINTAGE_YEAR": ORIGINATION["VINTAGE_YEAR"], "ROW_SEQ": "o_orderkey"}
    return _project(_orders(spark, sf_dir), view)


def raw_servicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = {
        **RAW_SERVICING,
        "VINTAGE_YEAR": ORIGINATION["VINTAGE_YEAR"],
        "ROW_SEQ": SERVICING["ROW_SEQ"],
    }
    return _project(_lines(spark, sf_dir), view)


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_orders(spark, sf_dir), APPLICATIONS)
