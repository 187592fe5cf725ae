import pandas as pd
import pytest

from tests.helpers import by_key, origination, servicing
from vintara import schema as S
from vintara.plans import datasets, macro, outcomes, panel, portfolio, vintages


@pytest.fixture(scope="module")
def orig(spark):
    return origination(
        spark,
        [
            ("A", 2010, "2010-01", 700, 80.0, 30.0, 1000.0, "NY", "FRM"),
            ("B", 2010, "2010-01", 650, 95.0, 40.0, 2000.0, "CA", "FRM"),
            ("C", 2010, None, 700, None, 30.0, 500.0, "CA", "ARM"),
            ("D", 2011, "2011-01", 720, 60.0, 20.0, 700.0, "NY", "FRM"),
            ("E", 2011, "2011-02", 720, 60.0, 20.0, 700.0, None, None),
        ],
    )


@pytest.fixture(scope="module")
def svcg(spark):
    return servicing(
        spark,
        [
            # A: defaults at an age known only from dates, then is liquidated at a loss.
            ("A", 1, "2010-07", 6, "0", None, 990.0),
            ("A", 2, "2011-01", None, "3", None, 980.0, {"mod": "Y"}),
            ("A", 3, "2011-07", 18, "5", None, None),
            ("A", 4, "2012-01", 24, "RA", "03 ", 0.0, {"net": 500.0, "mi": 80.0, "costs": 30.0, "zb_date": "2012-02"}),
            # B: prepays; two rows in one month, the later one wins.
            ("B", 5, "2010-07", 6, "0", None, 1900.0),
            ("B", 6, "2011-01", 12, "0", "01", 1800.0),
            ("B", 7, "2011-01", 12, "0", "96", 0.0),
            # C: no origination date, so an unreported age stays unknown.
            ("C", 8, "2010-07", None, "XX", None, 450.0),
            ("C", 9, "2010-09", 9, "4", "02", 0.0, {"loss": 9999.0}),
            ("C", 10, "2010-10", None, "4", "02", 0.0, {"loss": 45.0}),
            # D: stays current with a modification in progress; a row of a loan never originated.
            ("D", 11, "2012-01", 12, "1", None, 690.0, {"mod": "P"}),
            ("Z", 12, "2012-01", 12, "3", None, 10.0),
        ],
    )


def test_outcomes(svcg, orig):
    found = by_key(outcomes.loan_outcomes(svcg, orig), S.LOAN)
    a, b, c, d, e = (found[k] for k in "ABCDE")
    assert (a["defaulted"], a["prepaid"], a["liquidated"]) == (True, False, True)
    assert (a["time_to_default_months"], a["observed_months"]) == (12, 24)
    assert a["EAD"] == 980.0 and a["lgd_observed"] == pytest.approx((980 - 500 - 80 + 30) / 980)
    assert (a["ever_modified"], a["max_dlq_status"]) == (True, 998)
    assert (a["ZERO_BALANCE_CODE"], str(a["ZERO_BALANCE_DATE"]), a["zero_balance_age_months"]) == ("03 ", "2012-02-01", 24)
    assert (b["prepaid"], b["liquidated"], b["time_to_prepay_months"]) == (True, False, 12)
    assert (b["ZERO_BALANCE_CODE"], b["EAD"], b["lgd_observed"]) == ("96", None, None)
    assert (c["defaulted"], c["time_to_default_months"], c["max_dlq_status"]) == (True, 9, 999)
    assert (c["zero_balance_age_months"], c["observed_months"]) == (9, 9)
    assert c["EAD"] == 450.0 and c["lgd_observed"] == pytest.approx(0.1)
    assert (d["defaulted"], d["ever_modified"]) == (False, False)
    assert (e["defaulted"], e["prepaid"], e["liquidated"], e["ever_modified"]) == (False,) * 4
    assert (e["observed_months"], e["max_dlq_status"]) == (None, None) and len(found) == 5


def test_default_basis(svcg, orig):
    wide = by_key(outcomes.loan_outcomes(svcg, orig, "serious_or_liquidated"), S.LOAN)
    assert [wide[k]["defaulted"] for k in "ABCD"] == [True, False, True, False]
    with pytest.raises(ValueError):
        outcomes.loan_outcomes(svcg, orig, "other")


def test_missing_recovery_columns(svcg, orig):
    slim = svcg.drop("NET_SALES_PROCEEDS", "MI_RECOVERIES", "NON_MI_RECOVERIES", "EXPENSES", "ACTUAL_LOSS_CALCULATION", "ZERO_BALANCE_DATE")
    found = by_key(outcomes.loan_outcomes(slim, orig), S.LOAN)
    assert found["A"]["lgd_observed"] == 1.0 and found["A"]["ZERO_BALANCE_DATE"] is None


def test_panel(svcg, orig):
    rows = {r["ROW_SEQ"]: r for r in panel.loan_panel(svcg, orig).collect()}
    assert len(rows) == 11 and 12 not in rows
    assert [rows[i]["LOAN_AGE_MONTHS"] for i in (1, 2, 8, 9)] == [6, 12, None, 9]
    assert [rows[i]["DLQ_STATUS_INT"] for i in (2, 4, 8)] == [3, 998, 999]


def test_outcomes_equal_the_panel_definition(spark, sf_dir):
    """Summaries taken before the join equal pandas summaries of the joined panel."""
    from checks import catalog

    svcg, orig = catalog.svcg(spark, sf_dir), catalog.orig(spark, sf_dir)
    frame = panel.loan_panel(svcg, orig).toPandas().sort_values(
        [S.LOAN, "REPORTING_DATE", "ROW_SEQ"], na_position="last"
    )
    found = outcomes.loan_outcomes(svcg, orig).toPandas().set_index(S.LOAN)
    grouped = frame.groupby(S.LOAN)
    checks = {
        "time_to_default_months": frame[frame.IS_SERIOUSLY_DELINQUENT].groupby(S.LOAN).LOAN_AGE_MONTHS.min(),
        "time_to_prepay_months": frame[frame.IS_PREPAID].groupby(S.LOAN).LOAN_AGE_MONTHS.min(),
        "observed_months": grouped.LOAN_AGE_MONTHS.max(),
        "max_dlq_status": grouped.DLQ_STATUS_INT.max(),
        "zero_balance_age_months": frame[frame.IS_ZERO_BALANCE].groupby(S.LOAN).LOAN_AGE_MONTHS.last(),
        "ZERO_BALANCE_CODE": frame[frame.IS_ZERO_BALANCE].groupby(S.LOAN).ZERO_BALANCE_CODE.last(),
    }
    for column, want in checks.items():
        got = found[column].dropna()
        pd.testing.assert_series_equal(
            got.sort_index(), want.dropna().sort_index(), check_names=False, check_dtype=False
        )


def test_snapshot_equals_pandas_last(spark, sf_dir):
    from checks import catalog

    svcg, orig = catalog.svcg(spark, sf_dir), catalog.orig(spark, sf_dir)
    frame = panel.loan_panel(svcg, orig).toPandas().sort_values(["REPORTING_DATE", "ROW_SEQ"], na_position="last")
    last = frame.groupby(S.LOAN).last()
    want = last[~last.IS_ZERO_BALANCE.astype(bool)]
    got = portfolio.active_portfolio(svcg, orig).toPandas().set_index(S.LOAN)
    assert set(got.index) == set(want.index)
    for column in ("CURRENT_ACTUAL_UPB", "CURRENT_LOAN_DELINQUENCY_STATUS", "LOAN_AGE_MONTHS", "DLQ_STATUS_INT", "MODIFICATION_FLAG", "REPORTING_DATE"):
        a, b = got[column].sort_index(), want[column].sort_index()
        assert (a.isna() == b.isna()).all() and (a.dropna() == b.dropna()).all(), column


def test_one_hot_loan(spark, sf_dir):
    """A loan with a third of all rows gives the same answers as the rows spread out."""
    hot = [("A", i, f"20{10 + i % 10}-{1 + i % 12:02d}", None, str(i % 5), None, float(i)) for i in range(1, 3001)]
    others = [(f"L{i}", i, "2012-01", 12, "0", None, 5.0) for i in range(6000)]
    svcg = servicing(spark, [*hot, *others]).repartition(16)
    orig = origination(spark, [("A", 2010, "2010-01", 700, 80.0, 30.0, 1.0, "NY", "FRM")])
    found = outcomes.loan_outcomes(svcg, orig).collect()[0]
    assert found["defaulted"] and found["max_dlq_status"] == 4
    ages = [round(((y - 2010) * 365.25 + (m - 1) * 30.4) / 30.44) for y, m in ((10 + i % 10 + 2000, 1 + i % 12) for i in range(1, 3001))]
    assert abs(found["observed_months"] - max(ages)) <= 1
    rows = vintages.loan_years(svcg, orig).collect()
    assert len(rows) == 10 and sum(r["defaulted_months"] for r in rows) == sum(i % 5 >= 3 for i in range(1, 3001))


# ---------------------------------------------------------------- datasets


@pytest.fixture(scope="module")
def months(spark):
    schema = "series_id string, obs_date date, value double"
    return macro.macro_table(spark.createDataFrame([], schema))


def test_pd_labels(spark, orig, months):
    rows = servicing(
        spark,
        [
            ("A", 1, "2011-01", 12, "0", None, 900.0),
            ("A", 2, "2011-01", 12, "3", "03", 800.0),  # same month, later in the file: not the snapshot
            ("A", 3, "2012-01", 24, "3", None, 700.0),
            ("B", 4, "2011-01", 12, "0", None, 900.0),
            ("B", 5, "2012-02", 25, "4", None, 900.0),  # beyond 12 months, within 24
            ("C", 6, "2011-01", 12, "0", "01", 0.0),  # already ended
            ("D", 7, "2012-01", None, "0", None, 600.0),  # age 12 by dates
            ("D", 8, "2012-02", None, "0", "09", 0.0),
            ("E", 9, "2012-02", 13, "3", None, 1.0),  # no row at the observation age
        ],
    )
    sets = {n: by_key(d, S.LOAN) for n, d in datasets.pd_datasets(rows, orig, months).items()}
    assert {k: r["PD_TARGET"] for k, r in sets["pd_12m"].items()} == {"A": 1, "B": 0, "D": 1}
    assert {k: r["PD_TARGET"] for k, r in sets["pd_24m"].items()} == {"A": 1, "B": 1, "D": 1}
    assert sets["pd_orig"] == {}
    assert sets["pd_12m"]["A"]["CURRENT_ACTUAL_UPB"] == 900.0 and sets["pd_12m"]["A"]["LOAN_AGE_AT_OBS"] == 12
    alone = by_key(datasets.pd_dataset(rows, orig, months, 12, 24), S.LOAN)
    assert {k: r["PD_TARGET"] for k, r in alone.items()} == {"A": 1, "B": 1, "D": 1}


def test_longer_horizon_never_loses_a_default(spark, sf_dir):
    from checks import catalog

    rows = catalog.CATALOG["forward_default_labels"](spark, sf_dir)
    assert rows.where("label_pd_12m and not label_pd_24m").count() == 0


def test_lgd_dataset(svcg, orig, months):
    found = by_key(datasets.lgd_dataset(outcomes.loan_outcomes(svcg, orig), months), S.LOAN)
    assert {k: r["lgd_source"] for k, r in found.items()} == {"A": "observed", "C": "observed"}
    assert found["A"]["LOAN_AGE_AT_DEFAULT"] == 12.0


def test_lgd_proxy(spark, orig, months):
    rows = servicing(spark, [("B", 1, "2011-01", 12, "3", None, 900.0), ("C", 2, "2011-01", 12, "3", None, 0.0)])
    found = by_key(datasets.lgd_dataset(outcomes.loan_outcomes(rows, orig), months), S.LOAN)
    assert found["B"]["lgd_observed"] == pytest.approx(0.45) and found["B"]["EAD"] == 2000.0
    assert found["C"]["lgd_observed"] == pytest.approx(0.30) and found["C"]["lgd_source"] == "synthetic_ltv"


def test_split_fallback(spark):
    early = spark.createDataFrame([(f"L{i}", 2010) for i in range(1000)], "LOAN_SEQUENCE_NUMBER string, VINTAGE_YEAR int")
    rows = datasets.fill_empty_splits(datasets.with_split(early))
    sizes = {r[0]: r[1] for r in rows.groupBy("split").count().collect()}
    assert sizes["train"] + sizes["valid"] == 1000 and sizes["test"] == sizes["valid"] and 150 < sizes["valid"] < 250
    late = early.withColumn("VINTAGE_YEAR", early.VINTAGE_YEAR + 5)
    with pytest.raises(ValueError):
        datasets.fill_empty_splits(datasets.with_split(late))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, "PD_TARGET int")
    row = datasets.class_weights(df).collect()[0]
    assert (row["scale_pos_weight"], row["weight_negative"], row["weight_positive"]) == pytest.approx((3.0, 12 / 18, 2.0))
    none = datasets.class_weights(df.where("PD_TARGET = 0")).collect()[0]
    assert none["scale_pos_weight"] == 9.0 and none["weight_positive"] is None


# ---------------------------------------------------------------- vintages


def test_vintage_curves(svcg, orig):
    years = vintages.loan_years(svcg, orig)
    curves = {(r[0], r[1]): tuple(r)[2:] for r in vintages.vintage_curves(years).collect()}
    assert curves[2010, 2010] == (3, 3, 1.0)  # C has three defaulted months over three loans
    assert curves[2010, 2011] == (2, 2, 1.0) and curves[2011, 2012] == (1, 0, 0.0)
    cumulative = {(r["vintage_year"], r["obs_year"]): r for r in vintages.cumulative_curves(years).collect()}
    assert [cumulative[2010, y]["cumulative_defaults"] for y in (2010, 2011, 2012)] == [1, 2, 2]
    assert cumulative[2010, 2012]["cumulative_default_rate"] == pytest.approx(2 / 3)
    series = {r["vintage_year"]: r["data"] for r in vintages.vintage_series(vintages.vintage_curves(years)).collect()}
    assert [p["obs_year"] for p in series[2010]] == [2010, 2011, 2012]
    wide = {r["obs_year"]: r for r in vintages.vintage_pivot(vintages.vintage_curves(years)).collect()}
    assert wide[2010]["2010"] == 100.0 and wide[2010]["2011"] is None


def test_vintage_pivot_takes_the_vintages_of_the_data(spark):
    rows = [(2003, 2005, 10, 0.1), (2003, 2006, 10, 0.2), (2019, 2020, 4, 0.25), (None, 2020, 4, 0.5)]
    curves = spark.createDataFrame(rows, "vintage_year int, obs_year int, total_loans long, default_rate double")
    wide = {r["obs_year"]: r for r in vintages.vintage_pivot(curves).collect()}
    assert wide[2005].asDict() == {"obs_year": 2005, "2003": 10.0, "2019": None} and wide[2020]["2019"] == 25.0
    assert vintages.vintage_pivot(curves, [2019]).columns == ["obs_year", "2019"]
    assert vintages.vintage_pivot(curves.limit(0)).collect() == []
