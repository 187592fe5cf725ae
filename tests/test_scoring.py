import pytest

from vintara import schema as S
from vintara.plans import macro, scoring

SHOCKS = "unemployment_shock double, hpi_shock double, rate_shock double"


def violations(spark, **fields):
    kinds = {int: "int", float: "double", str: "string"}
    schema = "id int, " + ", ".join(f"{k} {kinds[type(v)]}" for k, v in fields.items())
    rows = spark.createDataFrame([(1, *fields.values())], schema)
    return scoring.validate(scoring.with_defaults(rows)).collect()[0]["violations"]


@pytest.mark.parametrize("field", S.SHOCK_FIELDS)
@pytest.mark.parametrize("value", [1e6, -1e6])
def test_extreme_shocks_are_rejected(spark, field, value):
    assert len(violations(spark, **{field: value})) == 1


def test_typical_shocks_are_accepted(spark):
    assert violations(spark, unemployment_shock=2.0, hpi_shock=-10.0, rate_shock=1.0) == []


@pytest.mark.parametrize("score", [200, 900])
def test_credit_score_bounds(spark, score):
    assert len(violations(spark, credit_score=score)) == 1


@pytest.mark.parametrize("field", [f for f, (_, lo, _h) in S.APPLICATION_FIELDS.items() if lo is not None])
def test_bounds_are_inclusive(spark, field):
    _, low, high = S.APPLICATION_FIELDS[field]
    assert violations(spark, **{field: float(low)}) == []
    assert len(violations(spark, **{field: float(low) - 0.5})) == 1
    if high is not None:
        assert violations(spark, **{field: float(high)}) == []
        assert len(violations(spark, **{field: float(high) + 0.5})) == 1


def test_scenario_requests_use_the_same_bounds(spark):
    rows = spark.createDataFrame([(2.0, -10.0, 1.0), (99.0, 0.0, 0.0), (0.0, -60.0, 11.0)], SHOCKS)
    assert [len(r["violations"]) for r in scoring.validate(rows).collect()] == [0, 1, 2]


def test_defaults_score(spark):
    rows = spark.createDataFrame([(1, None), (2, 200)], "id int, credit_score int")
    scored = scoring.score_applications(rows, macro.default_baseline(spark)).collect()
    assert [r["id"] for r in scored] == [1]  # the second is out of bounds
    row = scored[0]
    # Baseline unemployment 4.87 and house prices +5.6% at default drivers.
    assert row["pd_12m"] == pytest.approx(1 / (1 + 2.718281828459045 ** (4.5 + 0.13 * 0.15)), abs=1e-6)
    assert (row["lgd"], row["ead"], row["ifrs9_stage"], row["risk_level"]) == (0.15, 200000.0, 2, "MEDIUM")
    assert row["ecl"] == pytest.approx(row["pd_12m"] * 3 * 0.15 * 200000, abs=1)


def test_quarantine_keeps_the_rest(spark):
    rows = spark.createDataFrame([(1, 700), (2, 200), (3, 900)], "id int, credit_score int")
    checked = scoring.validate(scoring.with_defaults(rows))
    assert scoring.accepted(checked).count() + scoring.quarantined(checked).count() == 3
    reasons = {r["id"]: r["violations"] for r in scoring.quarantined(checked).collect()}
    assert reasons == {2: ["credit_score below 300"], 3: ["credit_score above 850"]}
