"""Loan-month panel: servicing joined to origination, with and without macro values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import loans as L
from vintara.functions.nullsafe import columns_present, month_of, select_available
from vintara.plans.macro import at_month
from vintara.sources.tables import write_by_vintage


def loan_panel(servicing: DataFrame, origination: DataFrame) -> DataFrame:
    """One row per loan and month with the loan's origination columns.

    A plain equi-join: Spark broadcasts the loan side when its measured size allows, and
    otherwise shuffles both with AQE splitting a hot loan.
    """
    kept = columns_present(servicing, (*S.PANEL_SERVICING_COLUMNS, "ROW_SEQ"))
    joined = servicing.select(*kept).join(
        select_available(origination, S.PANEL_ORIGINATION_COLUMNS), S.LOAN
    )
    return joined.withColumns(
        {
            "LOAN_AGE_MONTHS": L.loan_age_months(
                F.col("LOAN_AGE"), F.col("REPORTING_DATE"), F.col("ORIGINATION_DATE")
            ),
            "DLQ_STATUS_INT": L.delinquency_as_int(F.col("CURRENT_LOAN_DELINQUENCY_STATUS")),
        }
    )


def write_panel(panel: DataFrame, path: str) -> None:
    """Write the panel sorted by loan and month, one folder per vintage."""
    order = columns_present(panel, (S.LOAN, "REPORTING_DATE", "ROW_SEQ"))
    write_by_vintage(panel, path, sort_by=tuple(order))


_PANEL_MACRO = (
    "unemployment_rate", "hpi_us", "hpi_yoy_chg", "mortgage_rate_30y", "financial_stress_idx",
    "unrate_chg_mom",
)


def panel_with_macro(panel: DataFrame, macro: DataFrame) -> DataFrame:
    """Panel plus the macro values of its reporting month."""
    names = {"date": "_month", **{c: c for c in _PANEL_MACRO}}
    with_month = panel.withColumn("_month", month_of(F.col("REPORTING_DATE")))
    return with_month.join(at_month(macro, names), "_month", "left").drop("_month")
