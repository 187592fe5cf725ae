"""Report formats: compact currency, percent, basis points, stage label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fixed(x: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", x)


def currency(x: Column) -> Column:
    size = F.abs(x)
    return (
        F.when(size >= 1e9, F.concat(F.lit("$"), _fixed(x / 1e9, 2), F.lit("B")))
        .when(size >= 1e6, F.concat(F.lit("$"), _fixed(x / 1e6, 2), F.lit("M")))
        .when(size >= 1e3, F.concat(F.lit("$"), _fixed(x / 1e3, 1), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), _fixed(x, 0)))
    )


def percent(x: Column, decimals: int = 2) -> Column:
    return F.concat(_fixed(x * 100, decimals), F.lit("%"))


def basis_points(x: Column) -> Column:
    return F.concat(_fixed(x * 10000, 0), F.lit(" bps"))


def stage_label(stage: Column) -> Column:
    return F.when(stage.isin(1, 2, 3), F.concat(F.lit("Stage "), stage.cast("string"))).otherwise(
        F.lit("Unknown")
    )


def risk_dimensions(
    mean_pd: Column, mean_lgd: Column, ecl_rate: Column, unemployment_shock: Column, hpi_shock: Column
) -> dict[str, Column]:
    """Five risk dimensions of a scenario on a 0..100 scale (fixed multipliers)."""
    top = F.lit(100.0)
    return {
        "dim_pd": F.least(mean_pd * 2000, top),
        "dim_lgd": F.least(mean_lgd * 100, top),
        "dim_ecl": F.least(ecl_rate * 5000, top),
        "dim_unemployment": F.least((F.lit(4.87) + unemployment_shock) * 6, top),
        "dim_hpi": F.greatest(F.lit(0.0), F.lit(50.0) + hpi_shock * 2),
    }
