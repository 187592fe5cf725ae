import pytest
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions import display
from vintara.functions import risk as R
from vintara.plans import macro, portfolio, scenarios
from tests.helpers import origination, servicing


@pytest.fixture(scope="module")
def baseline(spark):
    return macro.default_baseline(spark)


def run(loans, baseline, *shocks):
    return portfolio.expected_credit_loss(portfolio.with_scenarios(loans, baseline, shocks or S.SCENARIOS[:1]))


def total(loans, baseline, **shocks):
    rolled = portfolio.roll_up(run(loans, baseline, S.Scenario("s", **shocks)))
    return portfolio.portfolio_kpis(rolled).collect()[0]


def lgd(spark, ltvs, hpi=5.6):
    df = spark.createDataFrame([(float(v),) for v in ltvs], "v double")
    return [r[0] for r in df.select(R.heuristic_lgd(F.col("v"), F.lit(hpi).cast("double"))).collect()]


def test_lgd_without_house_prices_is_finite(spark):
    assert all(0 < v < 1 for v in lgd(spark, [80, 95], None))


def test_lgd_bounds_and_order(spark):
    assert all(0.05 <= v <= 0.90 for v in lgd(spark, [20, 80, 150]))
    low, high = lgd(spark, [60, 120])
    assert high >= low


def test_no_exposure_column(spark, baseline):
    loans = spark.createDataFrame([(700,), (720,)], "CREDIT_SCORE int")
    assert [r["ead"] for r in run(loans, baseline).collect()] == [0.0, 0.0]


def test_exposure_fallback_and_preference(spark, baseline):
    original = spark.createDataFrame([(700, 250000.0)], "CREDIT_SCORE int, ORIGINAL_UPB double")
    assert run(original, baseline).collect()[0]["ead"] == 250000.0
    both = original.withColumn("CURRENT_ACTUAL_UPB", F.lit(200000.0))
    assert run(both, baseline).collect()[0]["ead"] == 200000.0
    unknown = original.withColumn("CURRENT_ACTUAL_UPB", F.lit(None).cast("double"))
    assert run(unknown, baseline).collect()[0]["ead"] == 250000.0


@pytest.mark.parametrize("dlq,pd,stage", [(0, 0.001, 1), (1, 0.001, 2), (2, 0.001, 2), (3, 0.001, 3), (0, 0.5, 3), (None, 0.001, 1), (0, 0.01, 1), (0, 0.1, 2)])
def test_stage(spark, dlq, pd, stage):
    df = spark.createDataFrame([(dlq, pd)], "d int, p double")
    assert df.select(R.ifrs9_stage(F.col("p"), F.col("d"))).collect()[0][0] == stage


def test_thresholds_are_months():
    assert (S.STAGE2_MIN_DLQ, S.STAGE3_MIN_DLQ) == (1, 3) and S.STAGE2_MIN_PD < S.STAGE3_MIN_PD


def test_minimal_portfolio(spark, baseline):
    loans = spark.createDataFrame([("NY",), ("CA",), ("NY",)], "PROPERTY_STATE string")
    rolled = portfolio.roll_up(run(loans, baseline))
    kpi = portfolio.portfolio_kpis(rolled).collect()[0]
    assert kpi["loan_count"] == 3 and kpi["ecl_rate"] == 0.0
    assert portfolio.segment_table(rolled, "state").count() == 2
    assert portfolio.segment_table(rolled, "fico_band").count() == 0
    assert portfolio.segment_table(rolled, "ltv_band").count() == 0


def test_bands(spark, baseline):
    loans = spark.createDataFrame(
        [(610, 55.0, 1e5), (705, 85.0, 2e5), (780, 105.0, 3e5)], "CREDIT_SCORE int, ORIGINAL_LTV double, ORIGINAL_UPB double"
    )
    rolled = portfolio.roll_up(run(loans, baseline))
    bands = {r["fico_band"]: r["band_order"] for r in portfolio.segment_table(rolled, "fico_band").collect()}
    assert bands == {"<620": 0, "700-739": 3, "740-799": 4}
    assert {r["ltv_band"] for r in portfolio.segment_table(rolled, "ltv_band").collect()} == {"<60", "80-89", "100+"}
    assert portfolio.portfolio_kpis(rolled).collect()[0]["total_ead"] == 600000.0


@pytest.mark.parametrize("score,label", [(620, "<620"), (621, "620-659"), (900, "800+"), (901, None), (0, None), (None, "620-659")])
def test_bands_are_right_closed(spark, score, label):
    df = spark.createDataFrame([(score,)], "v int")
    assert df.select(R.fico_band(F.col("v"))).collect()[0][0] == label


def test_shocks_add_to_the_baseline(spark, baseline):
    loans = spark.createDataFrame([("A",)], "LOAN_SEQUENCE_NUMBER string")
    row = portfolio.with_scenarios(loans, baseline, [S.Scenario("s", 2.0, -10.0, 1.0), S.Scenario("none")])
    found = {r["scenario_name"]: r for r in row.collect()}
    assert found["s"]["unemployment_rate"] == pytest.approx(6.87)
    assert found["s"]["hpi_yoy_chg"] == pytest.approx(-4.4)
    assert found["s"]["mortgage_rate_30y"] == pytest.approx(4.65)
    assert found["s"]["unrate_chg_mom"] == pytest.approx(2 / 12)
    assert found["none"]["unemployment_rate"] == 4.87 and found["none"]["hpi_yoy_chg"] == 5.6


def test_stress_raises_ecl(spark, baseline):
    loans = spark.createDataFrame(
        [(680, 90.0, 2e5), (700, 80.0, 2e5), (720, 70.0, 2e5)], "CREDIT_SCORE int, ORIGINAL_LTV double, ORIGINAL_UPB double"
    )
    base = total(loans, baseline)["total_ecl"]
    steps = [total(loans, baseline, unemployment_shock=u)["total_ecl"] for u in (0.0, 2.0, 4.0, 8.0)]
    assert steps[0] == pytest.approx(base) and steps == sorted(steps) and steps[2] > base
    falls = [total(loans, baseline, hpi_shock=h)["total_ecl"] for h in (10.0, 0.0, -10.0, -33.0)]
    assert falls == sorted(falls)
    assert total(loans, baseline, rate_shock=3.0)["total_ecl"] == pytest.approx(base)


def test_segments_and_null_keys_add_up(spark, baseline):
    loans = spark.createDataFrame(
        [("NY", 1e5), ("CA", 2e5), (None, 4e5)], "PROPERTY_STATE string, ORIGINAL_UPB double"
    )
    rolled = portfolio.roll_up(run(loans, baseline, *S.SCENARIOS))
    kpis = {r["scenario_name"]: r for r in portfolio.portfolio_kpis(rolled).collect()}
    states = portfolio.segment_table(rolled, "state").groupBy("scenario_name").agg(F.sum("ead").alias("e")).collect()
    assert {r["e"] for r in states} == {3e5} and {k["total_ead"] for k in kpis.values()} == {7e5}
    stages = portfolio.stage_table(rolled).groupBy("scenario_name").agg(F.sum("loan_count").alias("n")).collect()
    assert {r["n"] for r in stages} == {3} and len(kpis) == 4


def test_empty_portfolio(spark, baseline):
    loans = spark.createDataFrame([], "PROPERTY_STATE string, ORIGINAL_UPB double")
    assert portfolio.roll_up(run(loans, baseline)).where("segment <> 'portfolio'").count() == 0


def test_snapshot_is_last_known_per_column(spark):
    svcg = servicing(
        spark,
        [
            ("A", 1, "2012-01", 1, "0", None, 100.0),
            ("A", 2, "2012-02", None, "2", None, 90.0),
            ("A", 3, "2012-03", None, None, None, None),
            ("B", 4, "2012-01", 1, "0", None, 50.0),
            ("B", 5, "2012-02", 2, "0", "01", 0.0),
            ("C", 6, "2012-05", 9, "3", "03", 0.0),
            ("C", 7, None, None, "1", None, 70.0),
            (None, 8, "2012-01", 1, "0", None, 1.0),
        ],
    )
    orig = origination(
        spark,
        [
            ("A", 2012, "2011-12", 700, 80.0, 30.0, 120.0, "NY", "FRM"),
            ("B", 2012, "2011-12", 700, 80.0, 30.0, 60.0, "NY", "FRM"),
            ("C", 2011, "2011-08", 700, 80.0, 30.0, 80.0, "CA", "FRM"),
        ],
    )
    found = {r[S.LOAN]: r for r in portfolio.active_portfolio(svcg, orig).collect()}
    assert set(found) == {"A", "C"}  # B ended; C's undated row counts as its last
    a = found["A"]
    assert (a["CURRENT_ACTUAL_UPB"], a["CURRENT_LOAN_DELINQUENCY_STATUS"], a["DLQ_STATUS_INT"]) == (90.0, "2", 0)
    assert a["LOAN_AGE_MONTHS"] == 3 and found["C"]["LOAN_AGE_MONTHS"] == 9
    row = {r[S.LOAN]: r for r in portfolio.active_portfolio(svcg, orig, "row").collect()}
    assert row["A"]["CURRENT_ACTUAL_UPB"] is None and row["A"]["CURRENT_LOAN_DELINQUENCY_STATUS"] is None


def test_scenario_comparison(spark):
    kpis = spark.createDataFrame([("baseline", 100.0), ("severe", 150.0)], "scenario_name string, total_ecl double")
    found = {r["scenario_name"]: r for r in scenarios.compare_with_baseline(kpis).collect()}
    assert (found["severe"]["ecl_delta"], found["severe"]["ecl_delta_pct"]) == (50.0, 50.0)
    alone = kpis.where("scenario_name = 'severe'")
    assert scenarios.compare_with_baseline(alone).collect()[0]["ecl_delta_pct"] == 15000.0


def test_scenario_definitions(spark):
    rows = scenarios.scenario_definitions(spark).collect()
    assert [tuple(r) for r in rows] == [tuple(s) for s in S.SCENARIOS]


@pytest.mark.parametrize("amount,text", [(2.5e9, "$2.50B"), (60.2e6, "$60.20M"), (1234.0, "$1.2K"), (12.0, "$12"), (-5e6, "$-5.00M")])
def test_currency(spark, amount, text):
    assert spark.range(1).select(display.currency(F.lit(amount))).collect()[0][0] == text


def test_other_formats(spark):
    row = spark.range(1).select(
        display.percent(F.lit(0.01234)), display.basis_points(F.lit(0.0123)), display.stage_label(F.lit(2)), display.stage_label(F.lit(7))
    ).collect()[0]
    assert tuple(row) == ("1.23%", "123 bps", "Stage 2", "Unknown")
