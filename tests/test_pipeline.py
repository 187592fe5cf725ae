import json

import pytest
from pyspark.sql import functions as F

from checks import catalog
from vintara import schema as S
from vintara.plans import pipeline, training
from vintara.sources import driver_tables as D
from vintara.sources import loan_files


def as_files(df, columns, folder, name):
    """One text file per vintage year, in row order."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    rows = df.orderBy("ROW_SEQ").select("VINTAGE_YEAR", line.alias("line")).collect()
    for year in S.VINTAGE_YEARS:
        lines = [r["line"] for r in rows if r["VINTAGE_YEAR"] == year]
        (folder / name.format(year=year)).write_text("\n".join(lines) + "\n")


def test_files_to_result_tables(spark, sf_dir, tmp_path):
    raw, out, observations = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "observations")
    raw.mkdir()
    as_files(D.raw_origination(spark, sf_dir), S.ORIGINATION_COLUMNS, raw, loan_files.ORIGINATION_NAME)
    as_files(D.raw_servicing(spark, sf_dir), S.SERVICING_COLUMNS, raw, loan_files.SERVICING_NAME)
    D.macro_observations(spark, sf_dir).write.parquet(observations)

    pipeline.ingest(spark, str(raw), out)
    pipeline.build_products(spark, out, observations)
    pipeline.run_portfolio(spark, out)

    def table(name):
        return spark.read.parquet(f"{out}/{name}")

    assert tuple(table("scoring").first()) == ("heuristic", "heuristic")
    by_heuristic = table("kpi").where("scenario_name = 'baseline'").first()["total_ecl"]

    # De-duplicated loans, all loan-months, and every product written.
    kept = {(r[0], r[1]) for r in table("orig").select("VINTAGE_YEAR", S.LOAN).collect()}
    want = {(r[0], r[1]) for r in catalog.CATALOG["dedupe_first"](spark, sf_dir).select("VINTAGE_YEAR", S.LOAN).collect()}
    assert kept == want
    assert table("svcg").count() == D.servicing(spark, sf_dir).count()
    assert table("macro").count() == 168
    assert table("panel").count() == table("svcg").join(table("orig").select(S.LOAN), S.LOAN).count()
    assert table("panel_with_macro").count() == table("panel").count()
    assert table("outcomes").count() == table("outcomes_with_macro").count() == table("orig").count()
    for name in ("pd_12m", "pd_24m", "pd_orig", "lgd"):
        assert table(name).count() > 0
    snapshot, kpi = table("portfolio_snapshot"), table("kpi")
    assert {r["loan_count"] for r in kpi.collect()} == {snapshot.count()}
    stages = table("stages").groupBy("scenario_name").agg(F.sum("loan_count").alias("n")).collect()
    assert {r["n"] for r in stages} == {snapshot.count()} and len(stages) == 4
    documents = [json.loads(r["value"]) for r in spark.read.text(f"{out}/all_scenarios").collect()]
    assert {d["scenario_name"] for d in documents} == {s.scenario_name for s in S.SCENARIOS}
    assert all(len(d["by_ifrs9_stage"]) <= 3 and d["total_ecl"] > 0 for d in documents)
    assert table("vintage_curves").count() > 0 and table("segments").count() > 0

    # Training is a stage; the portfolio then uses its models.
    pipeline.train_models(
        spark, out,
        training.PdSettings(boosting_rounds=4, boosting_depth=3, forest_trees=5, forest_depth=3, forest_min_leaf=5),
        training.LgdSettings(boosting_rounds=4, boosting_depth=3),
    )
    pipeline.run_portfolio(spark, out)
    assert tuple(table("scoring").first()) == ("model", "model")
    assert table("kpi").where("scenario_name = 'baseline'").first()["total_ecl"] != by_heuristic
    judged = {(r["model"], r["split"]) for r in table("pd_metrics").collect()}
    assert judged == {(m, s) for m in ("logit", "boosted", "boosted_raw", "forest") for s in ("valid", "test")}
    assert {(r["model"], r["split"]) for r in table("lgd_metrics").collect()} == {(m, s) for m in ("ridge", "boosted") for s in ("valid", "test")}
    assert {r["split"] for r in table("lgd_calibration").collect()} == {"valid", "test"}
    for kind in ("pd", "lgd"):
        assert abs(table(f"{kind}_importance").agg(F.sum("importance")).first()[0] - 1) < 1e-6
    metrics = [json.loads(r["value"]) for r in spark.read.text(f"{out}/metrics_json").collect()]
    assert len(metrics) == 12
    for part in (tmp_path / "out" / "models" / "pd" / "metadata").glob("*part-*"):
        part.unlink() if part.name.startswith(".") else part.write_text("not json")
    with pytest.raises(Exception):  # noqa: B017  a damaged model is an error, not a missing one
        training.saved_scoring(spark, f"{out}/models")


def test_ingest_is_idempotent_per_year(spark, sf_dir, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    as_files(D.raw_origination(spark, sf_dir), S.ORIGINATION_COLUMNS, raw, loan_files.ORIGINATION_NAME)
    as_files(D.raw_servicing(spark, sf_dir), S.SERVICING_COLUMNS, raw, loan_files.SERVICING_NAME)
    pipeline.ingest(spark, str(raw), out, (2010, 2011))
    before = spark.read.parquet(f"{out}/svcg").count()
    pipeline.ingest(spark, str(raw), out, (2011,))
    assert spark.read.parquet(f"{out}/svcg").count() == before
