"""Registered queries: every operator over the whole given tables.

Each takes (spark, sf_dir). Money sums are rounded to 2 places and rates to 6 so that results do
not depend on the order of floating-point additions; row-level arithmetic is left as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions.nullsafe import select_available
from vintara.operators import cleaning as C
from vintara.operators import metrics as M
from vintara.plans import datasets, eda, macro, outcomes, panel, portfolio, scenarios, scoring, training, vintages
from vintara.session import configure, scratch_path, together, write_through
from vintara.sources import driver_tables as D
from vintara.sources import loan_files, tables
from vintara.streaming import servicing as stream

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    CATALOG[fn.__name__] = configured
    return fn


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in digits.items()})


# ---------------------------------------------------------------- shared inputs


def orig(spark, sf_dir):
    return D.origination(spark, sf_dir)


def svcg(spark, sf_dir):
    return C.add_event_flags(D.servicing(spark, sf_dir))


def monthly(spark, sf_dir):
    return macro.macro_table(D.macro_observations(spark, sf_dir))


def base_macro(spark, sf_dir):
    return macro.baseline_macro(monthly(spark, sf_dir))


def results(spark, sf_dir):
    return outcomes.loan_outcomes(svcg(spark, sf_dir), orig(spark, sf_dir))


def active(spark, sf_dir):
    return portfolio.active_portfolio(svcg(spark, sf_dir), orig(spark, sf_dir))


def scored(spark, sf_dir, presets=S.SCENARIOS):
    rows = portfolio.with_scenarios(active(spark, sf_dir), base_macro(spark, sf_dir), presets)
    return portfolio.expected_credit_loss(rows)


def rolled(spark, sf_dir, presets=S.SCENARIOS):
    return portfolio.roll_up(scored(spark, sf_dir, presets))


def pd12(spark, sf_dir):
    return datasets.pd_dataset(svcg(spark, sf_dir), orig(spark, sf_dir), monthly(spark, sf_dir), 12, 12)


def lgd_rows(spark, sf_dir):
    return datasets.lgd_dataset(results(spark, sf_dir), monthly(spark, sf_dir))


def heuristic_scores(spark, sf_dir, dataset, label):
    """Dataset rows with the heuristic PD and LGD under the baseline, by split."""
    rows = datasets.with_split(dataset)
    rows = portfolio.with_scenarios(rows, base_macro(spark, sf_dir), S.SCENARIOS[:1])
    rows = portfolio.expected_credit_loss(rows)
    return rows.select(
        S.LOAN, "split", F.col(label).alias("label"),
        # The last digits of a double differ between engines; whole ranks must not.
        F.round("pd_pred", 12).alias("score"), F.round("lgd_pred", 12).alias("severity"),
    )


def pd_scores(spark, sf_dir):
    return heuristic_scores(spark, sf_dir, pd12(spark, sf_dir), "PD_TARGET")


def lgd_scores(spark, sf_dir):
    return heuristic_scores(spark, sf_dir, lgd_rows(spark, sf_dir), "lgd_observed")


# ---------------------------------------------------------------- cleaning


_CLEAN_ORIG_NUMBERS = ("MI_PCT", "ORIGINAL_CLTV", "ORIGINAL_DTI", "ORIGINAL_LTV", "ORIGINAL_INTEREST_RATE")


def _wide_floats(df: DataFrame) -> DataFrame:
    """Four-byte floats as doubles to 4 places, for comparison."""
    return rounded(df, **{c: 4 for c in _CLEAN_ORIG_NUMBERS if c in df.columns})


def clean_orig_rows(spark, sf_dir):
    return C.clean_origination(D.raw_origination(spark, sf_dir))


def clean_svcg_rows(spark, sf_dir):
    return C.clean_servicing(D.raw_servicing(spark, sf_dir))


@query
def clean_orig(spark, sf_dir):
    return _wide_floats(clean_orig_rows(spark, sf_dir)).withColumnRenamed("ROW_SEQ", "row_no")


@query
def parse_numbers(spark, sf_dir):
    return _wide_floats(clean_orig_rows(spark, sf_dir)).select(
        F.col("ROW_SEQ").alias("row_no"), *S.ORIGINATION_NUMBERS
    )


@query
def sentinel_nulls(spark, sf_dir):
    rows = clean_orig_rows(spark, sf_dir)
    return rows.groupBy("VINTAGE_YEAR").agg(
        F.count_if(F.col("CREDIT_SCORE").isNull()).alias("fico_missing"),
        F.count_if(F.col("ORIGINAL_DTI").isNull()).alias("dti_missing"),
        F.count_if(F.col("ORIGINAL_LTV") == 999).alias("ltv_999_kept"),
    )


@query
def parse_yyyymm(spark, sf_dir):
    return clean_orig_rows(spark, sf_dir).select(
        F.col("ROW_SEQ").alias("row_no"), "FIRST_PAYMENT_DATE", "MATURITY_DATE"
    )


@query
def code_sentinels(spark, sf_dir):
    rows = clean_orig_rows(spark, sf_dir)
    return rows.select(F.col("ROW_SEQ").alias("row_no"), *S.ORIGINATION_CODES)


@query
def loan_purpose_nine(spark, sf_dir):
    rows = clean_orig_rows(spark, sf_dir)
    return rows.groupBy("LOAN_PURPOSE", "OCC_STATUS").agg(F.count("*").alias("loans"))


@query
def null_tokens(spark, sf_dir):
    rows = clean_svcg_rows(spark, sf_dir)
    return rows.groupBy("VINTAGE_YEAR").agg(
        F.count_if(F.col("CURRENT_ACTUAL_UPB").isNull()).alias("upb_missing"),
        F.count_if(F.col("CURRENT_LIST_PRICE").isNull()).alias("list_price_missing"),
        F.count_if(F.col("ORIGINAL_LIST_PRICE").isNull()).alias("original_price_missing"),
        F.count_if(F.col("MODIFICATION_RELATED_NON_INTEREST_BEARING_UPB").isNull()).alias("deferred_missing"),
    )


@query
def origination_date(spark, sf_dir):
    return clean_orig_rows(spark, sf_dir).select(
        F.col("ROW_SEQ").alias("row_no"), "VINTAGE_YEAR", "FIRST_PAYMENT_DATE", "ORIGINATION_DATE"
    )


@query
def dedupe_first(spark, sf_dir):
    rows = _wide_floats(clean_orig_rows(spark, sf_dir))
    kept = C.keep_first(rows, ["VINTAGE_YEAR", S.LOAN], "ROW_SEQ")
    return kept.select("VINTAGE_YEAR", S.LOAN, F.col("ROW_SEQ").alias("row_no"), "CREDIT_SCORE", "ORIGINAL_UPB", "CHANNEL")


@query
def load_audit(spark, sf_dir):
    return C.load_audit(clean_orig_rows(spark, sf_dir))


@query
def clean_svcg(spark, sf_dir):
    return clean_svcg_rows(spark, sf_dir).withColumnRenamed("ROW_SEQ", "row_no")


@query
def clean_svcg_flags(spark, sf_dir):
    rows = svcg(spark, sf_dir)
    return rows.select(
        S.LOAN, F.col("ROW_SEQ").alias("row_no"), "CURRENT_LOAN_DELINQUENCY_STATUS",
        "IS_SERIOUSLY_DELINQUENT", "IS_ZERO_BALANCE", "IS_PREPAID", "IS_LIQUIDATED", "IS_DEFAULTED",
    )


# ---------------------------------------------------------------- sources and sinks


YEAR_FOLDER = "VINTAGE_YEAR={year}"


def _years(rows: DataFrame) -> list[int]:
    """The vintage years that rows have."""
    return sorted(r[0] for r in rows.select("VINTAGE_YEAR").distinct().collect() if r[0] is not None)


def _write_text_years(df: DataFrame, columns: tuple[str, ...], path: str) -> None:
    """Write raw rows as pipe-separated text, one folder per vintage year."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    df.select(line.alias("value"), "VINTAGE_YEAR").write.partitionBy("VINTAGE_YEAR").text(path)


@query
def io_orig_text(spark, sf_dir):
    path = scratch_path(spark, "orig-text")
    raw = D.raw_origination(spark, sf_dir)
    _write_text_years(raw, S.ORIGINATION_COLUMNS, path)
    text = loan_files.read_origination(spark, path, _years(raw), YEAR_FOLDER)
    return _wide_floats(C.clean_origination(text)).select("VINTAGE_YEAR", *S.ORIGINATION_COLUMNS, "ORIGINATION_DATE")


@query
def io_svcg_text(spark, sf_dir):
    path = scratch_path(spark, "svcg-text")
    raw = D.raw_servicing(spark, sf_dir)
    _write_text_years(raw, S.SERVICING_COLUMNS, path)
    text = loan_files.read_servicing(spark, path, _years(raw), YEAR_FOLDER)
    cleaned = C.clean_servicing(text)
    return cleaned.select(
        "VINTAGE_YEAR", *S.SERVICING_COLUMNS, "REPORTING_DATE", "ZERO_BALANCE_DATE",
        "IS_SERIOUSLY_DELINQUENT", "IS_ZERO_BALANCE", "IS_PREPAID", "IS_LIQUIDATED", "IS_DEFAULTED",
    )


@query
def io_svcg_stream(spark, sf_dir):
    path = scratch_path(spark, "svcg-stream")
    _write_text_years(D.raw_servicing(spark, sf_dir), S.SERVICING_COLUMNS, f"{path}/in")
    cleaned = stream.servicing_stream(spark, f"{path}/in", YEAR_FOLDER)
    stream.append_servicing(cleaned, f"{path}/out", f"{path}/state").awaitTermination()
    table = spark.read.parquet(f"{path}/out")
    return table.groupBy("VINTAGE_YEAR").agg(
        F.count("*").alias("loan_months"),
        F.count_if("IS_DEFAULTED").alias("defaulted"),
        F.count_if("IS_PREPAID").alias("prepaid"),
        F.round(F.sum("CURRENT_ACTUAL_UPB"), 2).alias("upb"),
    )


@query
def io_partitioned_parquet(spark, sf_dir):
    """Write the panel sorted and partitioned, read two vintages back."""
    path = scratch_path(spark, "panel")
    panel.write_panel(panel.loan_panel(svcg(spark, sf_dir), orig(spark, sf_dir)), path)
    rows = tables.read_vintages(spark, path, (2012, 2015))
    return rows.groupBy("VINTAGE_YEAR").agg(
        F.count("*").alias("loan_months"),
        F.count_distinct(S.LOAN).alias("loans"),
        F.round(F.sum("CURRENT_ACTUAL_UPB"), 2).alias("upb"),
    )


@query
def io_json_results(spark, sf_dir):
    """Write the nested scenario documents as JSON and read the figures back."""
    path = scratch_path(spark, "scenarios-json")
    tables.write_json(scenarios.result_documents(rolled(spark, sf_dir)), path)
    figures = "scenario_name string, total_ecl double, loan_count long, by_state array<struct<segment_value:string,ecl:double>>"
    documents = spark.read.schema(figures).json(path)
    return rounded(
        documents.select("scenario_name", "loan_count", "total_ecl", F.size("by_state").alias("states")),
        total_ecl=2,
    )


@query
def io_column_projection(spark, sf_dir):
    return select_available(orig(spark, sf_dir), (S.LOAN, "VINTAGE_YEAR", "CREDIT_SCORE"))


@query
def io_select_available(spark, sf_dir):
    return select_available(orig(spark, sf_dir), (S.LOAN, "NO_SUCH_COLUMN", "ORIGINAL_UPB", "MSA"))


@query
def io_years_subset(spark, sf_dir):
    rows = orig(spark, sf_dir).where(F.col("VINTAGE_YEAR").isin(2011, 2013))
    return rows.groupBy("VINTAGE_YEAR").agg(F.count("*").alias("loans"))


@query
def combine_years(spark, sf_dir):
    """Union of the per-year tables."""
    rows = orig(spark, sf_dir)
    per_year = [rows.where(F.col("VINTAGE_YEAR") == y) for y in _years(rows)]
    combined = tables.combine_years([per_year[0].withColumn("EXTRA", F.lit("x")), *per_year[1:]])
    return combined.select(S.LOAN, "VINTAGE_YEAR", "ORIGINAL_UPB", "EXTRA")


# ---------------------------------------------------------------- macro


@query
def macro_monthly(spark, sf_dir):
    return monthly(spark, sf_dir)


@query
def macro_resample_last(spark, sf_dir):
    return macro.monthly_last(D.macro_observations(spark, sf_dir))


@query
def macro_ffill(spark, sf_dir):
    return macro.filled_series(D.macro_observations(spark, sf_dir)).select("series_id", "month", "value")


@query
def hpi_yoy(spark, sf_dir):
    return monthly(spark, sf_dir).select("date", "hpi_us", "hpi_yoy_chg")


@query
def unrate_mom(spark, sf_dir):
    return monthly(spark, sf_dir).select("date", "unemployment_rate", "unrate_chg_mom")


@query
def macro_baseline(spark, sf_dir):
    base = base_macro(spark, sf_dir)
    return rounded(base, **{c: 6 for c in base.columns})


# ---------------------------------------------------------------- panel and outcomes


def _panel(spark, sf_dir):
    return panel.loan_panel(svcg(spark, sf_dir), orig(spark, sf_dir))


@query
def panel_rows(spark, sf_dir):
    return _panel(spark, sf_dir).withColumnRenamed("ROW_SEQ", "row_no")


@query
def loan_age_fallback(spark, sf_dir):
    rows = _panel(spark, sf_dir)
    return rows.groupBy("LOAN_AGE_MONTHS", F.col("LOAN_AGE").isNull().alias("computed")).agg(
        F.count("*").alias("loan_months")
    )


@query
def delinquency_int(spark, sf_dir):
    return _panel(spark, sf_dir).groupBy("CURRENT_LOAN_DELINQUENCY_STATUS", "DLQ_STATUS_INT").agg(
        F.count("*").alias("loan_months")
    )


@query
def panel_macro(spark, sf_dir):
    joined = panel.panel_with_macro(_panel(spark, sf_dir), monthly(spark, sf_dir))
    return joined.select(
        S.LOAN, F.col("ROW_SEQ").alias("row_no"), "REPORTING_DATE", "LOAN_AGE_MONTHS", *panel._PANEL_MACRO
    )


@query
def first_default(spark, sf_dir):
    return results(spark, sf_dir).select(S.LOAN, "defaulted", "time_to_default_months")


@query
def first_prepay(spark, sf_dir):
    return results(spark, sf_dir).select(S.LOAN, "prepaid", "time_to_prepay_months")


@query
def ead_last_nonzero(spark, sf_dir):
    return results(spark, sf_dir).where("liquidated").select(S.LOAN, "EAD")


@query
def lgd_observed(spark, sf_dir):
    return results(spark, sf_dir).where("liquidated").select(S.LOAN, "lgd_observed")


@query
def ever_modified(spark, sf_dir):
    return results(spark, sf_dir).select(S.LOAN, "ever_modified")


@query
def max_delinquency(spark, sf_dir):
    return results(spark, sf_dir).select(S.LOAN, "max_dlq_status", "observed_months")


@query
def zero_balance_final(spark, sf_dir):
    return results(spark, sf_dir).select(
        S.LOAN, "ZERO_BALANCE_CODE", "ZERO_BALANCE_DATE", "zero_balance_age_months"
    )


@query
def loan_outcomes(spark, sf_dir):
    return results(spark, sf_dir)


@query
def outcomes_liquidation_basis(spark, sf_dir):
    rows = outcomes.loan_outcomes(svcg(spark, sf_dir), orig(spark, sf_dir), "serious_or_liquidated")
    return rows.groupBy("VINTAGE_YEAR").agg(F.count_if("defaulted").alias("defaulted"))


@query
def outcomes_macro(spark, sf_dir):
    return outcomes.outcomes_with_macro(results(spark, sf_dir), monthly(spark, sf_dir)).select(
        S.LOAN, "defaulted", "unrate_at_orig", "hpi_at_orig", "hpi_yoy_at_orig", "rate_at_orig",
        "fsi_at_orig", "RATE_SPREAD",
    )


# ---------------------------------------------------------------- datasets


@query
def pd_12m(spark, sf_dir):
    return pd12(spark, sf_dir)


@query
def pd_24m(spark, sf_dir):
    return datasets.pd_datasets(svcg(spark, sf_dir), orig(spark, sf_dir), monthly(spark, sf_dir))["pd_24m"]


@query
def pd_orig(spark, sf_dir):
    return datasets.pd_datasets(svcg(spark, sf_dir), orig(spark, sf_dir), monthly(spark, sf_dir))["pd_orig"]


@query
def forward_default_labels(spark, sf_dir):
    base = datasets.observations_and_labels(svcg(spark, sf_dir), orig(spark, sf_dir), datasets.PD_DATASETS)
    return base.select(S.LOAN, *[f"label_{n}" for n in datasets.PD_DATASETS])


@query
def lgd_dataset(spark, sf_dir):
    return rounded(lgd_rows(spark, sf_dir), lgd_observed=9)


@query
def lgd_synthetic(spark, sf_dir):
    rows = lgd_rows(spark, sf_dir).groupBy("lgd_source").agg(
        F.count("*").alias("loans"), F.avg("lgd_observed").alias("mean_lgd"), F.sum("EAD").alias("ead")
    )
    return rounded(rows, mean_lgd=6, ead=2)


@query
def split_counts(spark, sf_dir):
    return datasets.with_split(pd12(spark, sf_dir)).groupBy("split").agg(F.count("*").alias("loans"))


@query
def split_fallback(spark, sf_dir):
    """All vintages as training years: validation comes out of training, test repeats validation."""
    years = {"train": [y for part in S.SPLIT_YEARS.values() for y in part]}
    rows = datasets.fill_empty_splits(datasets.with_split(pd12(spark, sf_dir), years))
    return rows.groupBy("split").agg(F.count("*").alias("loans"))


@query
def class_weights(spark, sf_dir):
    train = datasets.with_split(pd12(spark, sf_dir)).where("split = 'train'")
    weights = datasets.class_weights(train)
    return rounded(weights, scale_pos_weight=6, weight_negative=6, weight_positive=6)


@query
def dataset_summary(spark, sf_dir):
    rows = pd12(spark, sf_dir).groupBy("VINTAGE_YEAR").agg(
        F.count("*").alias("loans"), F.avg("PD_TARGET").alias("default_rate")
    )
    return rounded(rows, default_rate=6)


@query
def lgd_summary(spark, sf_dir):
    return rounded(eda.mean_and_median(lgd_rows(spark, sf_dir), "lgd_observed"), mean_value=6, median_value=6)


# ---------------------------------------------------------------- portfolio and scenarios


@query
def snapshot_active(spark, sf_dir):
    return portfolio.active_portfolio(svcg(spark, sf_dir), orig(spark, sf_dir), keep_texts=True)


@query
def snapshot_row_mode(spark, sf_dir):
    rows = portfolio.active_portfolio(svcg(spark, sf_dir), orig(spark, sf_dir), "row", keep_texts=True)
    return rows.select(
        S.LOAN, "REPORTING_DATE", "CURRENT_ACTUAL_UPB", "CURRENT_LOAN_DELINQUENCY_STATUS",
        "DLQ_STATUS_INT", "LOAN_AGE_MONTHS", "MODIFICATION_FLAG",
    )


@query
def scenario_macro(spark, sf_dir):
    """Stressed macro values of each scenario."""
    loans = active(spark, sf_dir).groupBy("PRODUCT_TYPE").agg(F.count("*").alias("loans"))
    rows = portfolio.with_scenarios(loans, base_macro(spark, sf_dir)).drop("_market_rate")
    names = ("unemployment_rate", "hpi_yoy_chg", "mortgage_rate_30y", "financial_stress_idx", "unrate_chg_mom")
    return rounded(rows, **{n: 6 for n in names})


_FIRST = S.SCENARIOS[:1]


@query
def heuristic_pd(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select(S.LOAN, "scenario_name", "pd_pred"), pd_pred=6)


@query
def heuristic_lgd(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select(S.LOAN, "scenario_name", "lgd_pred"), lgd_pred=6)


_MACRO_DIGITS = dict(unemployment_rate=6, hpi_yoy_chg=6, mortgage_rate_30y=6, unrate_chg_mom=6)


@query
def pd_scoring_features(spark, sf_dir):
    """Inputs of a default model: shocked macro values, spread against the unshocked rate."""
    rows = portfolio.with_scenarios(active(spark, sf_dir), base_macro(spark, sf_dir))
    features = portfolio.pd_features(rows).select(
        S.LOAN, "scenario_name", "LOAN_AGE_AT_OBS", "DLQ_STATUS_INT", "RATE_SPREAD", *_MACRO_DIGITS
    )
    return rounded(features, RATE_SPREAD=6, **_MACRO_DIGITS)


@query
def lgd_scoring_features(spark, sf_dir):
    """Inputs of a loss model: shocked macro values under their at-default names."""
    rows = portfolio.with_scenarios(active(spark, sf_dir), base_macro(spark, sf_dir))
    names = ("unemployment_rate_at_default", "hpi_yoy_chg_at_default", "rate_at_default", "fsi_at_default")
    features = portfolio.lgd_features(rows).select(S.LOAN, "scenario_name", "LOAN_AGE_AT_DEFAULT", *names)
    return rounded(features, **{n: 6 for n in names})


@query
def ead_selection(spark, sf_dir):
    return scored(spark, sf_dir, _FIRST).select(S.LOAN, "ead")


@query
def ifrs9_stage(spark, sf_dir):
    return scored(spark, sf_dir).select(S.LOAN, "scenario_name", "ifrs9_stage")


@query
def loan_ecl(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select(S.LOAN, "scenario_name", "ecl"), ecl=4)


def _kpis(spark, sf_dir):
    return portfolio.portfolio_kpis(rolled(spark, sf_dir))


_KPI_DIGITS = dict(total_ead=2, total_ecl=2, ecl_rate=8, mean_pd=6, mean_lgd=6)
_SEGMENT_DIGITS = dict(ead=2, ecl=2, ecl_rate=8, mean_pd=6, mean_lgd=6)


@query
def portfolio_kpi(spark, sf_dir):
    return rounded(_kpis(spark, sf_dir), **_KPI_DIGITS)


def _segment(spark, sf_dir, name):
    table = portfolio.segment_table(rolled(spark, sf_dir, _FIRST), name).drop("scenario_name")
    return rounded(table, **_SEGMENT_DIGITS)


@query
def ecl_by_state(spark, sf_dir):
    return _segment(spark, sf_dir, "state")


@query
def ecl_by_fico(spark, sf_dir):
    return _segment(spark, sf_dir, "fico_band")


@query
def ecl_by_ltv(spark, sf_dir):
    return _segment(spark, sf_dir, "ltv_band")


@query
def ecl_by_vintage(spark, sf_dir):
    return _segment(spark, sf_dir, "vintage")


@query
def ecl_by_product(spark, sf_dir):
    return _segment(spark, sf_dir, "product_type")


@query
def ecl_by_stage(spark, sf_dir):
    return rounded(portfolio.stage_table(rolled(spark, sf_dir)), ead=2, ecl=2)


@query
def scenario_all(spark, sf_dir):
    return rounded(rolled(spark, sf_dir), **_SEGMENT_DIGITS)


@query
def scenario_custom(spark, sf_dir):
    """One custom scenario next to the baseline."""
    custom = (*_FIRST, S.Scenario("custom", 3.5, -12.0, 1.25))
    kpis = portfolio.portfolio_kpis(rolled(spark, sf_dir, custom))
    return rounded(
        scenarios.compare_with_baseline(kpis), **_KPI_DIGITS, baseline_ecl=2, ecl_delta=2, ecl_delta_pct=4
    )


@query
def scenario_delta(spark, sf_dir):
    compared = scenarios.compare_with_baseline(_kpis(spark, sf_dir))
    columns = ("scenario_name", "total_ecl", "baseline_ecl", "ecl_delta", "ecl_delta_pct")
    return rounded(compared.select(*columns), total_ecl=2, baseline_ecl=2, ecl_delta=2, ecl_delta_pct=4)


@query
def scenario_summary(spark, sf_dir):
    summary = scenarios.scenario_summary(_kpis(spark, sf_dir))
    return rounded(summary, total_ecl=2, ecl_rate=8, mean_pd=6, mean_lgd=6)


@query
def risk_dimensions(spark, sf_dir):
    rows = scenarios.risk_dimensions(_kpis(spark, sf_dir))
    return rounded(rows, dim_pd=4, dim_lgd=4, dim_ecl=4, dim_unemployment=4, dim_hpi=4)


@query
def formatted_kpis(spark, sf_dir):
    return scenarios.formatted_kpis(_kpis(spark, sf_dir))


@query
def top_states_ecl(spark, sf_dir):
    return rounded(scenarios.top_states(rolled(spark, sf_dir, _FIRST)), **_SEGMENT_DIGITS)


def _loan_years(spark, sf_dir):
    return vintages.loan_years(svcg(spark, sf_dir), orig(spark, sf_dir))


@query
def vintage_curves(spark, sf_dir):
    return rounded(vintages.vintage_curves(_loan_years(spark, sf_dir)), default_rate=6)


@query
def vintage_curves_cumulative(spark, sf_dir):
    return rounded(vintages.cumulative_curves(_loan_years(spark, sf_dir)), cumulative_default_rate=6)


@query
def vintage_pivot(spark, sf_dir):
    return vintages.vintage_pivot(vintages.vintage_curves(_loan_years(spark, sf_dir)))


@query
def vintage_series(spark, sf_dir):
    """Points of each vintage as text, in order of observation year."""
    series = vintages.vintage_series(vintages.vintage_curves(_loan_years(spark, sf_dir)))
    point = lambda p: F.concat_ws(":", p["obs_year"], p["total_loans"])
    return series.select("vintage_year", F.concat_ws(",", F.transform("data", point)).alias("points"))


# ---------------------------------------------------------------- metrics


def _ranking(spark, sf_dir, name):
    points = M.roc_points(pd_scores(spark, sf_dir), ["split"], "label", "score")
    return rounded(M.classification_metrics(points, ["split"]).select("split", name), **{name: 6})


@query
def roc_points(spark, sf_dir):
    points = M.roc_points(pd_scores(spark, sf_dir), ["split"], "label", "score")
    return points.drop("all_pos", "all_neg")


@query
def auc(spark, sf_dir):
    return _ranking(spark, sf_dir, "auc")


@query
def average_precision(spark, sf_dir):
    return _ranking(spark, sf_dir, "ap")


@query
def ks(spark, sf_dir):
    return _ranking(spark, sf_dir, "ks")


@query
def brier(spark, sf_dir):
    points = M.roc_points(pd_scores(spark, sf_dir), ["split"], "label", "score")
    return rounded(M.classification_metrics(points, ["split"]).select("split", "brier", "rows"), brier=6)


@query
def regression_metrics(spark, sf_dir):
    table = M.regression_metrics(lgd_scores(spark, sf_dir), ["split"], "label", "severity")
    return rounded(table, rmse=6, mae=6, r2=6)


@query
def decile_calibration(spark, sf_dir):
    table = M.decile_calibration(lgd_scores(spark, sf_dir), ["split"], "label", "severity")
    return rounded(table, mean_pred=6, mean_actual=6)


@query
def calibration_curve(spark, sf_dir):
    table = M.calibration_curve(pd_scores(spark, sf_dir), ["split"], "label", "score")
    return rounded(table, mean_predicted=6, fraction_positive=6)


# ---------------------------------------------------------------- exploratory summaries


@query
def default_rate_by_vintage(spark, sf_dir):
    return rounded(eda.default_rate_by_vintage(results(spark, sf_dir)), default_rate=6)


@query
def default_rate_by_fico(spark, sf_dir):
    return rounded(eda.default_rate_by_fico(results(spark, sf_dir)), default_rate_pct=6)


@query
def histogram_fico(spark, sf_dir):
    return eda.fico_histogram(orig(spark, sf_dir))


@query
def histogram_ltv(spark, sf_dir):
    return eda.ltv_histogram(orig(spark, sf_dir))


@query
def histogram_lgd(spark, sf_dir):
    return eda.lgd_histogram(results(spark, sf_dir))


@query
def ltv_markers(spark, sf_dir):
    return rounded(eda.mean_and_median(orig(spark, sf_dir), "ORIGINAL_LTV"), mean_value=6, median_value=6)


@query
def lgd_markers(spark, sf_dir):
    return rounded(eda.mean_and_median(results(spark, sf_dir), "lgd_observed"), mean_value=6, median_value=6)


@query
def top_states_by_loans(spark, sf_dir):
    return eda.top_states_by_loans(orig(spark, sf_dir))


@query
def portfolio_summary(spark, sf_dir):
    summary = eda.portfolio_summary(results(spark, sf_dir))
    return rounded(summary, total_upb=2, **{c: 6 for c in summary.columns if c not in ("total_loans", "total_upb")})


# ---------------------------------------------------------------- applications


@query
def score_applications(spark, sf_dir):
    return scoring.score_applications(D.applications(spark, sf_dir), base_macro(spark, sf_dir))


@query
def request_violations(spark, sf_dir):
    checked = scoring.validate(scoring.with_defaults(D.applications(spark, sf_dir)))
    rejected = scoring.quarantined(checked)
    return rejected.select("application_id", F.concat_ws("; ", "violations").alias("violations"))


@query
def scenario_request_violations(spark, sf_dir):
    requests = D.applications(spark, sf_dir).select("application_id", *S.SHOCK_FIELDS)
    checked = scoring.validate(requests)
    return checked.groupBy((F.size("violations") == 0).alias("accepted")).agg(F.count("*").alias("requests"))


@query
def risk_level_counts(spark, sf_dir):
    levels = scoring.score_applications(D.applications(spark, sf_dir), base_macro(spark, sf_dir))
    return levels.groupBy("risk_level", "ifrs9_stage").agg(F.count("*").alias("applications"))


# ---------------------------------------------------------------- models


def _train_rows(spark, sf_dir):
    return datasets.with_split(pd12(spark, sf_dir)).where("split = 'train'")


@query
def impute_medians(spark, sf_dir):
    return training.median_table(_train_rows(spark, sf_dir), list(S.PD_NUMERIC))


@query
def scale_stats(spark, sf_dir):
    """Mean and sample deviation of each numeric feature after median filling."""
    train = write_through(_train_rows(spark, sf_dir), "pd-train")
    medians = {r[0]: r[1] for r in training.median_table(train, list(S.PD_NUMERIC)).collect()}
    filled = [F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias("v")) for c in S.PD_NUMERIC]
    long = train.select(F.explode(F.array(*filled)).alias("_p")).select("_p.*")
    stats = long.groupBy("feature").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("deviation"))
    return rounded(stats, mean=4, deviation=4)


def _pd_model_scores(spark, sf_dir, kinds, keep=None):
    data = write_through(pd12(spark, sf_dir), "pd-12m")
    models = training.train_pd_models(data, None, kinds)
    models = {k: m for k, m in models.items() if keep is None or k in keep}
    return training.scored_splits(models, data, training.predict_pd, "pd_pred", "PD_TARGET")


def _lgd_model_scores(spark, sf_dir, kinds):
    # Stored before the split, which counts the rows of each part.
    data = training.lgd_split(write_through(lgd_rows(spark, sf_dir), "lgd"))
    models = training.train_lgd_models(data, None, kinds)
    return training.scored_splits(models, data, training.predict_lgd, "lgd_pred", "lgd_observed")


def _in_range(scored: DataFrame) -> DataFrame:
    """Which rows a model scored, with their labels, and whether each score lies in [0, 1]."""
    return scored.select(S.LOAN, "model", "split", "label", F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("in_range"))


@query
def logit_scored_rows(spark, sf_dir):
    return _in_range(_pd_model_scores(spark, sf_dir, ("logit",)))


@query
def ridge_scored_rows(spark, sf_dir):
    return _in_range(_lgd_model_scores(spark, sf_dir, ("ridge",)))


@query
def logit_scores(spark, sf_dir):
    return _pd_model_scores(spark, sf_dir, ("logit",))


@query
def boosted_scores(spark, sf_dir):
    return _pd_model_scores(spark, sf_dir, ("boosted",), ("boosted_raw",))


@query
def calibrated_scores(spark, sf_dir):
    return _pd_model_scores(spark, sf_dir, ("boosted",), ("boosted",))


@query
def forest_scores(spark, sf_dir):
    return _pd_model_scores(spark, sf_dir, ("forest",))


@query
def pd_model_metrics(spark, sf_dir):
    return training.pd_metrics(_pd_model_scores(spark, sf_dir, ("logit", "boosted", "forest")))


@query
def ridge_scores(spark, sf_dir):
    return _lgd_model_scores(spark, sf_dir, ("ridge",))


@query
def boosted_lgd_scores(spark, sf_dir):
    return _lgd_model_scores(spark, sf_dir, ("boosted",))


@query
def lgd_model_metrics(spark, sf_dir):
    return training.lgd_metrics(_lgd_model_scores(spark, sf_dir, ("ridge", "boosted")))


@query
def top_feature_importance(spark, sf_dir):
    data = write_through(pd12(spark, sf_dir), "pd-12m")
    model = training.train_pd_models(data, kinds=("boosted",))["boosted_raw"]
    train = datasets.with_split(data).where("split = 'train'")
    table = training.importance_table(train, model.stages[0], model.stages[1], S.PD_NUMERIC, S.PD_CATEGORICAL)
    return training.top_features(table)


@query
def model_scenarios(spark, sf_dir):
    """Scenario run with trained models, saved and loaded again. The two are trained at one time."""
    def fit_pd():
        return training.train_pd_models(write_through(pd12(spark, sf_dir), "pd-12m"), kinds=("boosted",))["boosted"]

    def fit_lgd():
        return training.train_lgd_models(write_through(lgd_rows(spark, sf_dir), "lgd"), kinds=("boosted",))["boosted"]

    pd_path, lgd_path = scratch_path(spark, "pd-model"), scratch_path(spark, "lgd-model")
    for model, path in zip(together(spark, fit_pd, fit_lgd), (pd_path, lgd_path), strict=True):
        training.save_model(model, path)
    pd_model, lgd_model = training.load_model(pd_path), training.load_model(lgd_path)
    with_models = portfolio.Scoring(
        lambda rows: training.predict_pd(pd_model, rows), lambda rows: training.predict_lgd(lgd_model, rows)
    )
    rows = scenarios.run_scenarios(active(spark, sf_dir), base_macro(spark, sf_dir), S.SCENARIOS, with_models)
    return portfolio.portfolio_kpis(rows)
