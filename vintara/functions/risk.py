"""Risk expressions: scenario macro values, heuristic PD and LGD, staging, ECL, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions.nullsafe import clip


def stressed(base: Column, shocks: Column) -> dict[str, Column]:
    """Macro values of one scenario: baseline struct plus the shocks struct."""
    jobless = shocks.getField("unemployment_shock")
    return {
        "unemployment_rate": base.getField("unemployment_rate") + jobless,
        "hpi_yoy_chg": base.getField("hpi_yoy_chg") + shocks.getField("hpi_shock"),
        "mortgage_rate_30y": base.getField("mortgage_rate_30y") + shocks.getField("rate_shock"),
        "financial_stress_idx": base.getField("financial_stress_idx"),
        # A shock is assumed to build up evenly over a year.
        "unrate_chg_mom": base.getField("unrate_chg_mom") + jobless / F.lit(12.0),
    }


def heuristic_pd(fico: Column, ltv: Column, dti: Column, unemployment: Column) -> Column:
    """Logistic 12-month default probability from four drivers (fixed coefficients)."""
    fico = F.coalesce(fico.cast("double"), F.lit(700.0))
    ltv = F.coalesce(ltv.cast("double"), F.lit(80.0))
    dti = F.coalesce(dti.cast("double"), F.lit(35.0))
    score = (
        F.lit(-4.5)
        + (F.lit(700.0) - fico) * F.lit(0.01)
        + (ltv - F.lit(80.0)) * F.lit(0.03)
        + (dti - F.lit(35.0)) * F.lit(0.01)
        + (unemployment - F.lit(5.0)) * F.lit(0.15)
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def heuristic_lgd(ltv: Column, hpi_yoy_chg: Column) -> Column:
    """Loss severity from loan-to-value revalued by the house-price change (fixed constants)."""
    growth = clip(F.lit(1.0) + F.coalesce(hpi_yoy_chg, F.lit(0.0)) / F.lit(100.0), 0.5, 1.5)
    revalued = F.coalesce(ltv.cast("double"), F.lit(80.0)) / growth
    severity = clip(revalued / F.lit(100.0) - F.lit(0.85), 0.0, 0.8) + F.lit(0.15)
    return clip(severity, 0.05, 0.90)


def ltv_loss_proxy(ltv: Column) -> Column:
    """Loss severity of a defaulted loan without a realised loss (fixed constants)."""
    excess = F.coalesce(ltv.cast("double"), F.lit(80.0)) / F.lit(100.0) - F.lit(0.80)
    return clip(F.lit(0.30) + F.greatest(excess, F.lit(0.0)), 0.05, 0.90)


def ifrs9_stage(pd: Column, delinquency: Column) -> Column:
    months = F.coalesce(delinquency, F.lit(0))
    impaired = (pd > S.STAGE3_MIN_PD) | (months >= S.STAGE3_MIN_DLQ)
    deteriorated = (pd > S.STAGE2_MIN_PD) | (months >= S.STAGE2_MIN_DLQ)
    return F.when(impaired, F.lit(3)).when(deteriorated, F.lit(2)).otherwise(F.lit(1))


def expected_loss(pd: Column, lgd: Column, ead: Column, stage: Column) -> Column:
    lifetime = F.when(stage == 1, F.lit(1.0)).otherwise(F.lit(S.LIFETIME_MULTIPLIER))
    return clip(pd * lifetime, 0.0, 1.0) * lgd * ead


def risk_level(pd: Column) -> Column:
    level = F
    for bound, name in S.RISK_LEVELS:
        level = level.when(pd < bound, F.lit(name))
    return level.otherwise(F.lit(S.RISK_LEVEL_ABOVE))


def band(value: Column, edges: tuple, labels: tuple) -> Column:
    """Label of the right-closed interval that holds ``value``; null outside all of them."""
    label = F.when(value <= edges[0], F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels, strict=True):
        label = label.when(value <= upper, F.lit(name))
    return label


def fico_band(score: Column) -> Column:
    return band(F.coalesce(score, F.lit(S.FICO_DEFAULT)), S.FICO_EDGES, S.FICO_LABELS)


def ltv_band(ltv: Column) -> Column:
    return band(F.coalesce(ltv, F.lit(S.LTV_DEFAULT)), S.LTV_EDGES, S.LTV_LABELS)


def band_order(label: Column) -> Column:
    """Position of a band in its scale, so that bands can be sorted by size."""
    places = {name: i for names in (S.FICO_LABELS, S.LTV_LABELS) for i, name in enumerate(names)}
    position = F
    for name, place in places.items():
        position = position.when(label == name, F.lit(place))
    return position.otherwise(F.lit(None).cast("int"))
