"""The stages from raw text files to result tables; what several stages use is written once."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.operators import metrics
from vintara.operators.cleaning import clean_origination, clean_servicing, keep_first
from vintara.plans import datasets, macro, outcomes, panel, portfolio, scenarios, training, vintages
from vintara.session import together
from vintara.sources import loan_files, tables


def ingest(spark: SparkSession, raw: str, out: str, years: Iterable[int] = S.VINTAGE_YEARS) -> None:
    """Text files of all years to the clean ``orig`` and ``svcg`` tables."""
    years = list(years)
    orig = clean_origination(loan_files.read_origination(spark, raw, years))
    orig = keep_first(orig, ["VINTAGE_YEAR", S.LOAN], "ROW_SEQ")
    tables.write_by_vintage(orig, f"{out}/orig")
    svcg = clean_servicing(loan_files.read_servicing(spark, raw, years))
    tables.write_by_vintage(svcg, f"{out}/svcg", sort_by=(S.LOAN, "REPORTING_DATE", "ROW_SEQ"))


def build_products(spark: SparkSession, out: str, observations: str, years: Iterable[int] | None = None) -> None:
    """Macro table, panel, outcomes and modelling datasets from the clean tables."""
    orig = tables.read_vintages(spark, f"{out}/orig", years)
    svcg = tables.read_vintages(spark, f"{out}/svcg", years).drop("VINTAGE_YEAR")
    monthly = macro.macro_table(tables.read_macro_observations(spark, observations))
    monthly.write.mode("overwrite").parquet(f"{out}/macro")
    monthly = spark.read.parquet(f"{out}/macro")
    rows = panel.loan_panel(svcg, orig)
    panel.write_panel(rows, f"{out}/panel")
    joined = panel.panel_with_macro(tables.read_vintages(spark, f"{out}/panel", years), monthly)
    panel.write_panel(joined, f"{out}/panel_with_macro")
    results = outcomes.loan_outcomes(svcg, orig)
    tables.write_by_vintage(results, f"{out}/outcomes")
    results = tables.read_vintages(spark, f"{out}/outcomes", years)
    tables.write_by_vintage(outcomes.outcomes_with_macro(results, monthly), f"{out}/outcomes_with_macro")
    base = datasets.observations_and_labels(svcg, orig, datasets.PD_DATASETS)
    base.write.mode("overwrite").parquet(f"{out}/pd_base")
    base = spark.read.parquet(f"{out}/pd_base")
    for name, dataset in datasets.pd_datasets_of(base, orig, monthly).items():
        tables.write_by_vintage(dataset, f"{out}/{name}")
    tables.write_by_vintage(datasets.lgd_dataset(results, monthly), f"{out}/lgd")


def train_models(
    spark: SparkSession,
    out: str,
    pd_settings: training.PdSettings | None = None,
    lgd_settings: training.LgdSettings | None = None,
) -> None:
    """Fit, save and judge the default and loss models on the datasets of ``build_products``.

    Saves the models that the portfolio is scored with, and tables (Parquet, and one JSON
    document of the metrics): metrics by model and split, feature importance of both boosted
    models, and the decile calibration of the boosted loss model by split. A dataset is split
    once, and training, scoring and metrics all use that split.
    """
    pd_rows = datasets.with_split(spark.read.parquet(f"{out}/pd_12m"))
    lgd_rows = training.lgd_split(spark.read.parquet(f"{out}/lgd"))
    pd_models, lgd_models = together(
        spark, lambda: training.train_pd_models(pd_rows, pd_settings), lambda: training.train_lgd_models(lgd_rows, lgd_settings)
    )
    training.save_model(pd_models["boosted"], f"{out}/models/pd")
    training.save_model(lgd_models["boosted"], f"{out}/models/lgd")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    pd_scores = keep(training.scored_splits(pd_models, pd_rows, training.predict_pd, "pd_pred", "PD_TARGET"), "pd_scores")
    lgd_scores = keep(training.scored_splits(lgd_models, lgd_rows, training.predict_lgd, "lgd_pred", "lgd_observed"), "lgd_scores")
    judged = [keep(training.pd_metrics(pd_scores), "pd_metrics"), keep(training.lgd_metrics(lgd_scores), "lgd_metrics")]
    tables.write_json(tables.combine_years(judged), f"{out}/metrics_json")
    for kind, rows, model, numeric, categorical in (
        ("pd", pd_rows, pd_models["boosted_raw"], S.PD_NUMERIC, S.PD_CATEGORICAL),
        ("lgd", lgd_rows, lgd_models["boosted"], S.LGD_NUMERIC, S.LGD_CATEGORICAL),
    ):
        train = rows.where(F.col("split") == "train")
        keep(training.importance_table(train, model.stages[0], model.stages[1], numeric, categorical), f"{kind}_importance")
    boosted = lgd_scores.where(F.col("model") == "boosted")
    keep(metrics.decile_calibration(boosted, ["model", "split"], "label", "score"), "lgd_calibration")


def run_portfolio(
    spark: SparkSession,
    out: str,
    presets: Sequence[S.Scenario] = S.SCENARIOS,
    scoring: portfolio.Scoring | None = None,
) -> None:
    """Portfolio snapshot, scenario result tables and vintage curves from the clean tables.

    Scored by the given ``scoring``, else by the models that ``train_models`` saved, else by the
    heuristic; the ``scoring`` table says which.
    """
    scoring = scoring or training.saved_scoring(spark, f"{out}/models")
    used = {k: "heuristic" if m is None else "model" for k, m in (("pd", scoring.pd_model), ("lgd", scoring.lgd_model))}
    spark.range(1).select(*[F.lit(v).alias(k) for k, v in used.items()]).write.mode("overwrite").parquet(f"{out}/scoring")
    orig = spark.read.parquet(f"{out}/orig")
    svcg = spark.read.parquet(f"{out}/svcg").drop("VINTAGE_YEAR")
    baseline = macro.baseline_macro(spark.read.parquet(f"{out}/macro"))
    active = portfolio.active_portfolio(svcg, orig, keep_texts=True)
    tables.write_by_vintage(active, f"{out}/portfolio_snapshot")
    active = spark.read.parquet(f"{out}/portfolio_snapshot")
    rolled = scenarios.run_scenarios(active, baseline, presets, scoring)
    rolled.write.mode("overwrite").parquet(f"{out}/rollup")
    rolled = spark.read.parquet(f"{out}/rollup")
    portfolio.portfolio_kpis(rolled).write.mode("overwrite").parquet(f"{out}/kpi")
    portfolio.stage_table(rolled).write.mode("overwrite").parquet(f"{out}/stages")
    segments = rolled.where(~F.col("segment").isin("portfolio", "ifrs9_stage"))
    segments.write.mode("overwrite").parquet(f"{out}/segments")
    tables.write_json(scenarios.result_documents(rolled, presets), f"{out}/all_scenarios")
    curves = vintages.vintage_curves(vintages.loan_years(svcg, orig))
    curves.write.mode("overwrite").parquet(f"{out}/vintage_curves")
