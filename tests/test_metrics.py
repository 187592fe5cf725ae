import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintara.operators import metrics as M
from vintara.operators.ordered import exact_quantiles, histogram, running_totals


@pytest.fixture(scope="module")
def scored_rows():
    """Two groups with many ties; one tie holds a third of all rows."""
    draw = random.Random(7)
    rows = []
    for group in ("a", "b"):
        for i in range(600):
            score = 0.25 if i % 3 == 0 else round(draw.random(), 2)
            rows.append((group, score, int(draw.random() < score)))
    return rows


@pytest.fixture(scope="module")
def scored(spark, scored_rows):
    return spark.createDataFrame(scored_rows, "g string, score double, label int")


def group_arrays(rows, group):
    data = [(s, y) for g, s, y in rows if g == group]
    return np.array([s for s, _ in data]), np.array([y for _, y in data])


def test_running_totals(spark, scored, scored_rows):
    counts = scored.groupBy("g", "score").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    found = running_totals(counts, ["g"], "score", ["n", "p"], descending=True).collect()
    for r in found:
        s, y = group_arrays(scored_rows, r["g"])
        assert (r["cum_n"], r["cum_p"]) == ((s >= r["score"]).sum(), y[s >= r["score"]].sum())


def test_running_totals_without_groups(spark):
    counts = spark.range(1000).select(F.col("id").alias("v"), F.lit(2).alias("n"))
    found = running_totals(counts, [], "v", ["n"]).collect()
    assert all(r["cum_n"] == 2 * (r["v"] + 1) for r in found) and len(found) == 1000


def test_classification_metrics_against_brute_force(scored, scored_rows):
    points = M.roc_points(scored, ["g"], "label", "score")
    for r in M.classification_metrics(points, ["g"]).collect():
        s, y = group_arrays(scored_rows, r["g"])
        pos, neg = s[y == 1], s[y == 0]
        wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
        assert r["auc"] == pytest.approx(wins / (len(pos) * len(neg)))
        cuts = sorted(set(s), reverse=True)
        tpr = [(pos >= c).mean() for c in cuts]
        assert r["ks"] == pytest.approx(max(t - (neg >= c).mean() for t, c in zip(tpr, cuts)))
        steps = np.diff([0.0, *tpr])
        precision = [y[s >= c].mean() for c in cuts]
        assert r["ap"] == pytest.approx(float((steps * precision).sum()))
        assert r["brier"] == pytest.approx(((s - y) ** 2).mean()) and r["rows"] == len(s)


def test_roc_is_monotone(scored):
    rows = M.roc_points(scored, ["g"], "label", "score").where("g = 'a'").orderBy(F.desc("score")).collect()
    assert all(a["cum_pos"] <= b["cum_pos"] and a["cum_neg"] <= b["cum_neg"] for a, b in zip(rows, rows[1:]))


def test_single_class_has_no_auc(spark):
    rows = spark.createDataFrame([("a", 0.1, 0), ("a", 0.2, 0)], "g string, score double, label int")
    found = M.classification_metrics(M.roc_points(rows, ["g"], "label", "score"), ["g"]).collect()[0]
    assert found["auc"] is None and found["ap"] is None


@pytest.mark.parametrize("size", [1, 2, 7, 500])
def test_quantiles_match_numpy(spark, size):
    draw = random.Random(size)
    values = [draw.choice([1.0, 2.5, draw.random() * 10]) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {r["q"]: r["quantile"] for r in exact_quantiles(df, [], "v", points).collect()}
    assert [found[q] for q in points] == pytest.approx([float(np.quantile(values, q)) for q in points])


def test_decile_calibration_matches_pandas(spark):
    draw = random.Random(3)
    pred = [draw.choice([0.2, 0.2, 0.2, round(draw.random(), 2)]) for _ in range(500)]
    actual = [draw.random() for _ in pred]
    df = spark.createDataFrame([("x", p, a) for p, a in zip(pred, actual)], "g string, p double, a double")
    found = M.decile_calibration(df, ["g"], "a", "p").orderBy("decile_bin").collect()
    frame = pd.DataFrame({"p": pred, "a": actual})
    frame["bin"] = pd.qcut(frame["p"], 10, labels=False, duplicates="drop")
    expected = frame.groupby("bin").agg(p=("p", "mean"), a=("a", "mean"), n=("p", "size")).reset_index()
    assert [r["decile_bin"] for r in found] == expected["bin"].tolist()
    assert [r["mean_pred"] for r in found] == pytest.approx(expected["p"].tolist())
    assert [r["mean_actual"] for r in found] == pytest.approx(expected["a"].tolist())
    assert [r["rows"] for r in found] == expected["n"].tolist()


def test_regression_metrics(spark):
    y, p = np.array([0.1, 0.4, 0.35, 0.8]), np.array([0.2, 0.3, 0.5, 0.6])
    df = spark.createDataFrame([("x", float(a), float(b)) for a, b in zip(y, p)], "g string, y double, p double")
    r = M.regression_metrics(df, ["g"], "y", "p").collect()[0]
    assert r["rmse"] == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    assert r["mae"] == pytest.approx(np.abs(y - p).mean())
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_calibration_curve_bins(scored, scored_rows):
    found = {(r["g"], r["bin"]): r for r in M.calibration_curve(scored, ["g"], "label", "score").collect()}
    s, y = group_arrays(scored_rows, "a")
    bins = np.searchsorted(np.linspace(0, 1, 11)[1:-1], s)
    for b in set(bins):
        assert found["a", b]["rows"] == (bins == b).sum()
        assert found["a", b]["fraction_positive"] == pytest.approx(y[bins == b].mean())


def test_histogram_matches_numpy(spark):
    draw = random.Random(5)
    values = [float(draw.randint(300, 850)) for _ in range(400)]
    df = spark.createDataFrame([("x", v) for v in values] + [("one", 5.0), ("one", 5.0)], "g string, v double")
    found = histogram(df, ["g"], "v", 50).collect()
    counts, _ = np.histogram(values, bins=50)
    got = {r["bin"]: r["rows"] for r in found if r["g"] == "x"}
    assert got == {i: int(c) for i, c in enumerate(counts) if c}
    assert [(r["bin"], r["rows"]) for r in found if r["g"] == "one"] == [(25, 2)]
