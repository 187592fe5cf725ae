import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from vintara import schema as S
from vintara.plans import macro

SCHEMA = "series_id string, obs_date date, obs_seq long, value double"


@pytest.fixture(scope="module")
def observations():
    draw = random.Random(11)
    rows = []
    for series in ("UNRATE", "USSTHPI", "MORTGAGE30US"):
        day = dt.date(2010, 4, 1)
        seq = 0
        while day < dt.date(2016, 6, 1):
            seq += 1
            rows.append((series, day, seq, None if draw.random() < 0.1 else round(draw.random() * 10 + 1, 3)))
            if draw.random() < 0.1:
                rows.append((series, day, seq + 1, round(draw.random() * 10 + 1, 3)))
                seq += 1
            day += dt.timedelta(days=draw.choice([3, 7, 20, 95]))
    return rows


def expected(rows, series):
    months = pd.date_range(S.MACRO_START, S.MACRO_END, freq="MS")
    data = sorted([(d, s, v) for k, d, s, v in rows if k == series and v is not None])
    last = {}
    for day, _, value in data:
        last[pd.Timestamp(day).replace(day=1)] = value
    return pd.Series([last.get(m, np.nan) for m in months], index=months).ffill()


def test_macro_table_matches_pandas(spark, observations):
    draw = random.Random(1)
    shuffled = draw.sample(observations, len(observations))
    df = spark.createDataFrame(shuffled, SCHEMA).repartition(4)
    table = macro.macro_table(df).orderBy("date").toPandas()
    assert len(table) == 168
    for series in ("UNRATE", "USSTHPI", "MORTGAGE30US"):
        want = expected(observations, series)
        np.testing.assert_allclose(table[S.MACRO_SERIES[series]].astype(float), want.values)
    hpi, jobless = expected(observations, "USSTHPI"), expected(observations, "UNRATE")
    np.testing.assert_allclose(table["hpi_yoy_chg"].astype(float), (hpi / hpi.shift(12) - 1).values * 100)
    np.testing.assert_allclose(table["unrate_chg_mom"].astype(float), jobless.diff().values)
    assert table[["real_gdp", "cpi", "financial_stress_idx"]].isna().all().all()


def test_baseline_is_the_mean_of_its_year(spark, observations):
    table = macro.macro_table(spark.createDataFrame(observations, SCHEMA))
    found = macro.baseline_macro(table).collect()[0]
    want = expected(observations, "UNRATE")
    assert found["unemployment_rate"] == pytest.approx(want[want.index.year == 2016].mean())
    assert found["financial_stress_idx"] == -0.5 and found["cpi"] is None


def test_baseline_without_observations_uses_defaults(spark):
    table = macro.macro_table(spark.createDataFrame([], SCHEMA))
    found = macro.baseline_macro(table).collect()[0]
    assert {k: found[k] for k in S.BASELINE_DEFAULTS} == S.BASELINE_DEFAULTS


def test_order_within_a_month_has_no_bounds(spark):
    day, rows = dt.date(2012, 3, 5), []
    for seq, value in ((2**62, 5.0), (2**62 - 1, 9.0), (1, 7.0)):
        rows.append(("UNRATE", day, seq, value))
    rows.append(("UNRATE", dt.date(2012, 3, 4), 2**63 - 1, 1.0))
    rows += [("MORTGAGE30US", day, 1, 3.0), ("MORTGAGE30US", day, 1, 4.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["series_id"]: r["value"] for r in macro.monthly_last(df).collect()} == {"UNRATE": 5.0, "MORTGAGE30US": 4.0}
    assert {r["series_id"]: r["value"] for r in macro.monthly_last(df.drop("obs_seq")).collect()} == {"UNRATE": 9.0, "MORTGAGE30US": 4.0}


def test_months_of_any_year_are_joined(spark):
    rows = [(dt.date(y, 5, 1), float(y)) for y in (1888, 1988, 2080)]
    table = spark.createDataFrame(rows, "date date, unemployment_rate double")
    found = macro.at_month(table, {"date": "m", "unemployment_rate": "u"}).collect()
    assert {r["m"].year: r["u"] for r in found} == {1888: 1888.0, 1988: 1988.0, 2080: 2080.0}
    with pytest.raises(Exception, match="several rows of one month"):
        macro.at_month(table.union(table), {"date": "m", "unemployment_rate": "u"}).collect()
