"""Active portfolio, loan-level expected credit loss and its roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import loans as L
from vintara.functions import risk as R
from vintara.functions.nullsafe import clip, col_or, ratio, select_available
from vintara.functions.textfold import TextFolds

# A scorer adds one probability-like column to a frame that carries loan and macro columns.
Scorer = Callable[[DataFrame], DataFrame]


def latest_per_loan(
    rows: DataFrame, mode: str = "composite", extra: Sequence[Column] = (), keep_texts: bool = False
) -> DataFrame:
    """Latest state of each loan, plus any ``extra`` aggregates.

    "composite" takes the last non-null value of every column by itself; "row" takes the last
    row as it stands. Both are aggregates that fold inside each task before the shuffle, and
    columns a caller does not use are pruned from the aggregation. A caller that uses the text
    columns says so by ``keep_texts``: they are measured first and folded as numbers, by hashing;
    otherwise a text column that is used after all is folded by sorting.
    """
    if mode not in ("composite", "row"):
        raise ValueError(f"unknown snapshot mode {mode!r}")
    values = [c for c in rows.columns if c not in (S.LOAN, "ROW_SEQ", "_order")]
    if "_order" not in rows.columns:
        rows = L.with_event_order(rows)
    order = F.col("_order")

    def latest(value: Column) -> Column:
        return L.last_known(value, order) if mode == "composite" else F.max_by(value, order)

    texts = TextFolds(rows, values if keep_texts else [])
    loans = texts.prepare(rows.where(F.col(S.LOAN).isNotNull())).groupBy(S.LOAN)
    folded = loans.agg(*[column for c in values for column in texts.fold(c, latest)], *extra)
    used = {c for name in values for c in texts.names(name, name)}
    others = [c for c in folded.columns if c not in used and c != S.LOAN]
    return folded.select(S.LOAN, *[texts.finish(c) for c in values], *others)


def active_portfolio(
    servicing: DataFrame, origination: DataFrame, mode: str = "composite", keep_texts: bool = False
) -> DataFrame:
    """Loans that are not at zero balance, in their latest state, with origination columns.

    ``keep_texts`` is for results that keep text columns of servicing (``latest_per_loan``).

    Servicing rows are reduced to one per loan before the join, so only loans are joined. The
    age of a row without a reported age needs the origination date, so the snapshot keeps both
    parts of the last row that has either and the age is finished after the join.
    """
    kept = select_available(servicing, (*S.PANEL_SERVICING_COLUMNS, "ROW_SEQ"))
    reported, date = F.col("LOAN_AGE").cast("int"), F.col("REPORTING_DATE")
    prepared = kept.withColumn(
        "DLQ_STATUS_INT", L.delinquency_as_int(F.col("CURRENT_LOAN_DELINQUENCY_STATUS"))
    )
    prepared, order = L.with_event_order(prepared), F.col("_order")
    known_age = F.when(reported.isNotNull() | date.isNotNull(), order) if mode == "composite" else order
    pieces = [F.max_by(reported, known_age).alias("_age"), F.max_by(date, known_age).alias("_age_date")]
    active = latest_per_loan(prepared, mode, pieces, keep_texts).where(~F.col("IS_ZERO_BALANCE"))
    joined = active.join(select_available(origination, S.PANEL_ORIGINATION_COLUMNS), S.LOAN)
    age = L.loan_age_months(F.col("_age"), F.col("_age_date"), F.col("ORIGINATION_DATE"))
    return joined.withColumn(
        "LOAN_AGE_MONTHS", F.when(F.col("ORIGINATION_DATE").isNull(), reported).otherwise(age)
    ).drop("_age", "_age_date")


@dataclass(frozen=True)
class Scoring:
    """How PD and LGD are predicted; the heuristic is used where no model is given."""

    pd_model: Scorer | None = None
    lgd_model: Scorer | None = None


def with_scenarios(
    loans: DataFrame, baseline: DataFrame, scenarios: Sequence[S.Scenario] = S.SCENARIOS
) -> DataFrame:
    """Each loan once per scenario, with that scenario's macro values.

    Scenarios are a short list of literals expanded inside each row and the one-row baseline is
    a scalar subquery, so every scenario is served by one scan without a join.
    """
    records = [
        F.struct(*[F.lit(v).alias(n) for n, v in scenario._asdict().items()])
        for scenario in scenarios
    ]
    base = baseline.select(F.struct(*baseline.columns)).scalar()
    rows = loans.select("*", base.alias("_base"), F.explode(F.array(*records)).alias("_shock"))
    return _apply_macro(rows, F.col("_shock")).withColumn(
        "scenario_name", F.col("_shock.scenario_name")
    ).drop("_shock")


def with_own_shocks(loans: DataFrame, baseline: DataFrame) -> DataFrame:
    """Each loan with macro values stressed by its own three shock columns."""
    base = baseline.select(F.struct(*baseline.columns)).scalar()
    shocks = F.struct(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in S.SHOCK_FIELDS])
    return _apply_macro(loans.select("*", base.alias("_base"), shocks.alias("_shock")), F.col("_shock")).drop("_shock")


def _apply_macro(rows: DataFrame, shocks: Column) -> DataFrame:
    values = R.stressed(F.col("_base"), shocks)
    market = F.col("_base.mortgage_rate_30y")
    return rows.withColumns({**values, "_market_rate": market}).drop("_base")


def expected_credit_loss(
    rows: DataFrame, scoring: Scoring | None = None, ead_column: str = "CURRENT_ACTUAL_UPB"
) -> DataFrame:
    """Add pd_pred, lgd_pred, ead, ifrs9_stage and ecl to rows that carry macro values."""
    scoring = scoring or Scoring()
    rows = rows.withColumn("ead", exposure(rows, ead_column))
    rows = _pd(rows, scoring.pd_model)
    rows = _lgd(rows, scoring.lgd_model)
    stage = R.ifrs9_stage(F.col("pd_pred"), col_or(rows, "DLQ_STATUS_INT", 0))
    loss = R.expected_loss(
        F.col("pd_pred"), F.col("lgd_pred"), F.col("ead"), F.col("ifrs9_stage")
    )
    return rows.withColumn("ifrs9_stage", stage).withColumn("ecl", loss).drop("_market_rate")


def exposure(rows: DataFrame, ead_column: str = "CURRENT_ACTUAL_UPB") -> Column:
    """Current balance, else original balance, else zero, over the columns present."""
    found = [F.col(c).cast("double") for c in (ead_column, "ORIGINAL_UPB") if c in rows.columns]
    return F.coalesce(*found, F.lit(0.0))


def _pd(rows: DataFrame, model: Scorer | None) -> DataFrame:
    if model is None:
        pd = R.heuristic_pd(
            col_or(rows, "CREDIT_SCORE", None),
            col_or(rows, "ORIGINAL_LTV", None),
            col_or(rows, "ORIGINAL_DTI", None),
            F.col("unemployment_rate"),
        )
        return rows.withColumn("pd_pred", clip(pd, 0.0, 1.0))
    features = pd_features(rows)
    added = [c for c in features.columns if c not in rows.columns]
    scored = model(features)
    return scored.withColumn("pd_pred", clip(F.col("pd_pred"), 0.0, 1.0)).drop(*added)


def _lgd(rows: DataFrame, model: Scorer | None) -> DataFrame:
    if model is None:
        lgd = R.heuristic_lgd(col_or(rows, "ORIGINAL_LTV", None), F.col("hpi_yoy_chg"))
        return rows.withColumn("lgd_pred", clip(lgd, 0.0, 1.0))
    features = lgd_features(rows)
    added = [c for c in features.columns if c not in rows.columns]
    scored = model(features)
    return scored.withColumn("lgd_pred", clip(F.col("lgd_pred"), 0.0, 1.0)).drop(*added)


def pd_features(rows: DataFrame) -> DataFrame:
    """Rows with macro values completed by the columns a default model expects."""
    added = {}
    if "LOAN_AGE_AT_OBS" not in rows.columns:
        added["LOAN_AGE_AT_OBS"] = _first_present(rows, ("LOAN_AGE_MONTHS", "LOAN_AGE"), None)
    if "RATE_SPREAD" not in rows.columns and "ORIGINAL_INTEREST_RATE" in rows.columns:
        # The spread describes the loan at origination, so a rate shock must not move it.
        added["RATE_SPREAD"] = F.col("ORIGINAL_INTEREST_RATE") - F.col("_market_rate")
    if "DLQ_STATUS_INT" not in rows.columns:
        added["DLQ_STATUS_INT"] = F.lit(0)
    return rows.withColumns(added) if added else rows


def lgd_features(rows: DataFrame) -> DataFrame:
    """Rows with macro values completed by the columns a loss model expects."""
    ages = ("LOAN_AGE_AT_DEFAULT", "LOAN_AGE_MONTHS", "LOAN_AGE")
    return rows.withColumns(
        {
            "unemployment_rate_at_default": F.col("unemployment_rate"),
            "hpi_yoy_chg_at_default": F.col("hpi_yoy_chg"),
            "rate_at_default": F.col("mortgage_rate_30y"),
            "fsi_at_default": F.col("financial_stress_idx"),
            "LOAN_AGE_AT_DEFAULT": _first_present(rows, ages, 24.0),
        }
    )


def _first_present(rows: DataFrame, names: tuple[str, ...], default: float | None) -> Column:
    """The first of the columns the frame has, else a constant."""
    name = next((c for c in names if c in rows.columns), None)
    return F.col(name) if name else F.lit(default).cast("double")


# Segment name -> column of the scored rows.
SEGMENTS = {
    "state": "PROPERTY_STATE",
    "fico_band": "FICO_BAND",
    "ltv_band": "LTV_BAND",
    "vintage": "VINTAGE_YEAR",
    "product_type": "PRODUCT_TYPE",
    "ifrs9_stage": "ifrs9_stage",
}


def roll_up(scored: DataFrame) -> DataFrame:
    """Totals per scenario and per segment in long form.

    Columns: scenario_name, segment ("portfolio" or a key of SEGMENTS), segment_value, ead, ecl,
    loan_count, mean_pd, mean_lgd, ecl_rate. Loans are aggregated once over all segment columns
    together (combined in each task before the shuffle); the grouping sets then run on that
    small table, not on loans. Rows without a segment value count in the portfolio only.
    """
    keys = {name: F.lit(None).cast("string") for name in SEGMENTS}
    for name, column in SEGMENTS.items():
        if column in scored.columns:
            keys[name] = F.col(column).cast("string")
    if "CREDIT_SCORE" in scored.columns:
        keys["fico_band"] = R.fico_band(F.col("CREDIT_SCORE"))
    if "ORIGINAL_LTV" in scored.columns:
        keys["ltv_band"] = R.ltv_band(F.col("ORIGINAL_LTV"))
    fine = scored.select(
        "scenario_name", *[c.alias(n) for n, c in keys.items()], "ead", "ecl", "pd_pred", "lgd_pred"
    )
    fine = fine.groupBy("scenario_name", *SEGMENTS).agg(
        F.sum("ead").alias("ead"),
        F.sum("ecl").alias("ecl"),
        F.count("*").alias("loan_count"),
        F.sum("pd_pred").alias("_pd"),
        F.count("pd_pred").alias("_pd_n"),
        F.sum("lgd_pred").alias("_lgd"),
        F.count("lgd_pred").alias("_lgd_n"),
    )
    sums = ("ead", "ecl", "loan_count", "_pd", "_pd_n", "_lgd", "_lgd_n")
    sets = [["scenario_name"], *[["scenario_name", name] for name in SEGMENTS]]
    coarse = fine.groupingSets(sets, "scenario_name", *SEGMENTS).agg(
        *[F.grouping(n).alias(f"_out_{n}") for n in SEGMENTS], *[F.sum(s).alias(s) for s in sums]
    )
    segment, value = F, F
    for name in SEGMENTS:
        segment = segment.when(F.col(f"_out_{name}") == 0, F.lit(name))
        value = value.when(F.col(f"_out_{name}") == 0, F.col(name))
    segment, value = segment.otherwise(F.lit("portfolio")), value.otherwise(F.lit("all"))
    whole = F.col("segment") == "portfolio"
    return coarse.select(
        "scenario_name",
        segment.alias("segment"),
        value.alias("segment_value"),
        "ead",
        "ecl",
        "loan_count",
        ratio(F.col("_pd"), F.col("_pd_n")).alias("mean_pd"),
        ratio(F.col("_lgd"), F.col("_lgd_n")).alias("mean_lgd"),
    ).where(F.col("segment_value").isNotNull()).withColumn(
        "ecl_rate",
        F.when(whole, F.col("ecl") / F.greatest(F.col("ead"), F.lit(1.0))).otherwise(
            ratio(F.col("ecl"), F.col("ead"))
        ),
    )


def portfolio_kpis(rolled: DataFrame) -> DataFrame:
    """Headline figures, one row per scenario."""
    return rolled.where(F.col("segment") == "portfolio").select(
        "scenario_name",
        F.col("ead").alias("total_ead"),
        F.col("ecl").alias("total_ecl"),
        "ecl_rate",
        "loan_count",
        "mean_pd",
        "mean_lgd",
    )


def segment_table(rolled: DataFrame, segment: str) -> DataFrame:
    """Roll-up of one segment; bands also carry their position in the scale."""
    table = rolled.where(F.col("segment") == segment).select(
        "scenario_name",
        F.col("segment_value").alias(segment),
        "ead",
        "ecl",
        "loan_count",
        "mean_pd",
        "mean_lgd",
        "ecl_rate",
    )
    if segment.endswith("_band"):
        return table.withColumn("band_order", R.band_order(F.col(segment)))
    return table


def stage_table(rolled: DataFrame) -> DataFrame:
    return rolled.where(F.col("segment") == "ifrs9_stage").select(
        "scenario_name",
        F.col("segment_value").cast("int").alias("ifrs9_stage"),
        "loan_count",
        "ead",
        "ecl",
    )
