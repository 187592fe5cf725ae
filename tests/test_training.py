import math
import random
from threading import Barrier

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from checks import catalog
from vintara import schema as S
from vintara.plans import macro, portfolio, scenarios, training


def pd_rows(rng, n, year, states):
    fico = rng.normal(700, 40, n)
    risk = 1 / (1 + np.exp(-((680 - fico) / 25)))
    return [
        (f"{year}-{i}", int(year), int(y), float(f) if i % 17 else None, str(rng.choice(states)), float(rng.random()))
        for i, (f, y) in enumerate(zip(fico, (rng.random(n) < risk).astype(int)))
    ]


@pytest.fixture(scope="module")
def pd_data(spark):
    rng = np.random.default_rng(0)
    rows = [*pd_rows(rng, 500, 2012, ["NY", "CA", "TX"]), *pd_rows(rng, 200, 2014, ["NY", "CA"]), *pd_rows(rng, 200, 2015, ["NY", "ZZ"])]
    schema = "LOAN_SEQUENCE_NUMBER string, VINTAGE_YEAR int, PD_TARGET int, CREDIT_SCORE double, PROPERTY_STATE string, ORIGINAL_LTV double"
    return spark.createDataFrame(rows, schema).repartition(4).cache()


@pytest.fixture(scope="module")
def models(pd_data):
    few = training.PdSettings(boosting_rounds=6, boosting_depth=3, forest_trees=10, forest_depth=4, forest_min_leaf=5)
    return training.train_pd_models(pd_data, few)


def encoded(models, rows):
    return np.array([r[0] for r in models["logit"].stages[0].transform(rows).select(vector_to_array("features")).collect()])


def test_preprocessor_fills_scales_and_encodes(models, pd_data):
    train = pd_data.where("VINTAGE_YEAR = 2012").coalesce(1)
    frame = train.toPandas()
    x = encoded(models, train)
    fico = frame["CREDIT_SCORE"].fillna(frame["CREDIT_SCORE"].median())
    np.testing.assert_allclose(x[:, 0], (fico - fico.mean()) / fico.std(ddof=1), rtol=1e-9, atol=1e-9)
    assert x.shape[1] == 2 + 3
    np.testing.assert_array_equal(x[:, 2:].argmax(1), frame["PROPERTY_STATE"].map({"CA": 0, "NY": 1, "TX": 2}))


def test_unseen_category_is_all_zero_and_missing_one_kept(models, spark):
    schema = "CREDIT_SCORE double, PROPERTY_STATE string, ORIGINAL_LTV double"
    rows = spark.createDataFrame([(710.0, "ZZ", 0.5), (710.0, "TX", 0.5)], schema).coalesce(1)
    x = encoded(models, rows)
    assert x[0, 2:].sum() == 0 and x[1, 2:].sum() == 1


def test_calibration_reuses_the_fitted_parts(models, pd_data):
    """Validation lacks a category; the calibrated model keeps the training vocabulary."""
    assert models["boosted"].stages[0] is models["boosted_raw"].stages[0]
    assert models["boosted"].stages[1] is models["boosted_raw"].stages[1]
    indexer = next(s for s in models["boosted"].stages[0].stages if hasattr(s, "labelsArray"))
    assert list(indexer.labelsArray[0]) == ["CA", "NY", "TX"]
    scored = training.predict_pd(models["boosted"], pd_data.where("PROPERTY_STATE in ('TX', 'ZZ')"))
    assert scored.where("pd_pred is null or pd_pred < 0 or pd_pred > 1").count() == 0


def test_calibrated_mean_equals_the_observed_rate_on_validation(models, pd_data):
    valid = pd_data.where("VINTAGE_YEAR = 2014")
    row = training.predict_pd(models["boosted"], valid).agg(F.avg("pd_pred"), F.avg("PD_TARGET")).collect()[0]
    assert row[0] == pytest.approx(row[1], abs=1e-9)


def test_logistic_matches_a_direct_solution(models, pd_data):
    train = pd_data.where("VINTAGE_YEAR = 2012").coalesce(1)
    x, y = encoded(models, train), train.toPandas()["PD_TARGET"].to_numpy()
    n = len(y)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    design = np.hstack([np.ones((n, 1)), x])
    penalty = np.diag([0.0] + [1 / 0.1] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - y)) + penalty @ beta
        hessian = design.T @ (design * (w * p * (1 - p))[:, None]) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    fitted = models["logit"].stages[1]
    np.testing.assert_allclose(np.r_[fitted.intercept, fitted.coefficients.toArray()], beta, atol=2e-4)


def test_models_rank_the_planted_signal(models, pd_data):
    chosen = {k: models[k] for k in ("logit", "boosted", "forest")}
    scored = training.scored_splits(chosen, pd_data, training.predict_pd, "pd_pred", "PD_TARGET")
    found = training.pd_metrics(scored).collect()
    assert {(r["model"], r["split"]) for r in found} == {(m, s) for m in chosen for s in ("valid", "test")}
    assert all(r["auc"] > 0.7 and r["rows"] == 200 for r in found)


def test_importance_names_every_slot(models, pd_data):
    model = models["boosted_raw"]
    table = training.importance_table(pd_data, model.stages[0], model.stages[1], S.PD_NUMERIC, S.PD_CATEGORICAL)
    rows = {r["feature"]: r["importance"] for r in table.collect()}
    assert list(rows) == ["CREDIT_SCORE", "ORIGINAL_LTV", "PROPERTY_STATE_CA", "PROPERTY_STATE_NY", "PROPERTY_STATE_TX"]
    assert training.top_features(table, 2).collect()[0]["feature"] == "CREDIT_SCORE"
    assert sum(rows.values()) == pytest.approx(1.0)


def test_save_and_load(models, pd_data, tmp_path):
    path = str(tmp_path / "model")
    training.save_model(models["boosted"], path)
    loaded = training.load_model(path)
    a = training.predict_pd(models["boosted"], pd_data).select(S.LOAN, "pd_pred")
    b = training.predict_pd(loaded, pd_data).select(S.LOAN, "pd_pred")
    assert a.exceptAll(b).count() == 0


@pytest.fixture(scope="module")
def lgd_data(spark):
    rng = np.random.default_rng(1)
    rows = []
    for year, n in ((2011, 300), (2014, 80), (2016, 80)):
        ltv = rng.uniform(40, 120, n)
        loss = np.clip(0.2 + (ltv - 40) / 100 + rng.normal(0, 0.05, n), 0, 1)
        rows += [(f"{year}-{i}", year, float(v), float(t), str(rng.choice(["SF", "CO"]))) for i, (v, t) in enumerate(zip(loss, ltv))]
    schema = "LOAN_SEQUENCE_NUMBER string, VINTAGE_YEAR int, lgd_observed double, ORIGINAL_LTV double, PROPERTY_TYPE string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def lgd_models(lgd_data):
    return training.train_lgd_models(lgd_data, training.LgdSettings(boosting_rounds=20, boosting_step=0.3))


def test_ridge_matches_the_closed_form(lgd_models, lgd_data):
    train = lgd_data.where("VINTAGE_YEAR = 2011").coalesce(1)
    pre, fitted = lgd_models["ridge"].stages[0], lgd_models["ridge"].stages[1]
    x = np.array([r[0] for r in pre.transform(train).select(vector_to_array("features")).collect()])
    y = train.toPandas()["lgd_observed"].to_numpy()
    centred, target = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(centred.T @ centred + np.eye(x.shape[1]), centred.T @ target)
    np.testing.assert_allclose(fitted.coefficients.toArray(), beta, atol=1e-7)


def test_lgd_models_predict_within_bounds(lgd_models, lgd_data):
    scored = training.scored_splits(lgd_models, lgd_data, training.predict_lgd, "lgd_pred", "lgd_observed")
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0
    assert all(r["r2"] > 0.6 for r in training.lgd_metrics(scored).collect())


def test_lgd_training_without_validation_vintages(lgd_data):
    only_train = lgd_data.where("VINTAGE_YEAR = 2011")
    models = training.train_lgd_models(only_train, kinds=("ridge",))
    assert set(models) == {"ridge"}


def test_scenarios_with_trained_models(spark, models, lgd_models):
    """Models plug into the scenario run; a rate shock does not move the rate spread."""
    loans = spark.createDataFrame(
        [("A", 640.0, "NY", 95.0, 1e5, "SF", 12), ("B", 760.0, "TX", 60.0, 2e5, "CO", 3)],
        "LOAN_SEQUENCE_NUMBER string, CREDIT_SCORE double, PROPERTY_STATE string, ORIGINAL_LTV double, ORIGINAL_UPB double, PROPERTY_TYPE string, LOAN_AGE_MONTHS int",
    )
    scoring = portfolio.Scoring(
        lambda rows: training.predict_pd(models["boosted"], rows),
        lambda rows: training.predict_lgd(lgd_models["boosted"], rows),
    )
    rolled = scenarios.run_scenarios(loans, macro.default_baseline(spark), S.SCENARIOS, scoring)
    kpis = portfolio.portfolio_kpis(rolled).collect()
    assert len(kpis) == 4 and all(r["loan_count"] == 2 and 0 < r["total_ecl"] <= 3e5 for r in kpis)
    rows = portfolio.with_scenarios(loans.withColumn("ORIGINAL_INTEREST_RATE", F.lit(5.0)), macro.default_baseline(spark))
    seen = []
    portfolio.expected_credit_loss(rows, portfolio.Scoring(lambda r: seen.append(r) or r.withColumn("pd_pred", F.lit(0.1)), None))
    spreads = {round(r["RATE_SPREAD"], 6) for r in seen[0].collect()}
    assert spreads == {1.35} and {r["LOAN_AGE_AT_OBS"] for r in seen[0].collect()} == {12, 3}


def test_best_round_waits():
    assert training.best_round([3.0, 2.0, 2.5, 2.4, 1.0], 2) == (2, True)
    assert training.best_round([3.0, 2.0, 2.5, 1.0, 1.1], 2) == (4, False)
    assert training.best_round([1.0], 5) == (1, False)


def test_boosting_uses_many_trees(spark):
    """Several rounds are better on validation rows than one, and than the constant prediction."""
    draw = random.Random(4)
    rows = []
    for i in range(1500):
        x, y = draw.random(), draw.random()
        p = 0.05 + 0.8 * (x > 0.5) * (y > 0.3) + 0.1 * (y < 0.1)
        rows.append((DenseVector([x, y]), int(draw.random() < p), 1.0, "train" if i % 3 else "valid"))
    df = spark.createDataFrame(rows, ["features", "PD_TARGET", "_w", "split"])
    train, valid = (df.where(F.col("split") == s).coalesce(1).cache() for s in ("train", "valid"))
    learner = GBTClassifier(labelCol="PD_TARGET", weightCol="_w", maxDepth=3, stepSize=0.2, seed=1)
    model = training.fit_boosted(learner, train, valid, 24, 4, lambda m, v: m.evaluateEachIteration(v))
    losses = model.evaluateEachIteration(valid)
    share = valid.agg(F.avg("PD_TARGET")).first()[0]
    constant = -2 * (share * math.log(share) + (1 - share) * math.log(1 - share))
    assert model.getNumTrees > 1 and losses[-1] < losses[0] and losses[-1] < constant


def test_learners_get_more_partitions_as_rows_grow(spark):
    """Tasks of a learner hold a bounded number of rows; few rows stay as they are."""
    rows = spark.range(5000).coalesce(1)
    sizes = [len(part) for part in training.dealt(rows, 500).rdd.glom().collect()]
    assert len(sizes) == 10 and sum(sizes) == 5000 and max(sizes) <= 510
    assert training.dealt(rows, 5000).rdd.getNumPartitions() == 1


def test_learners_read_dealt_rows(pd_data, lgd_data, monkeypatch):
    parts = []
    deal = training.dealt
    monkeypatch.setattr(training, "dealt", lambda rows: parts.append(deal(rows, 40)) or parts[-1])
    few = training.PdSettings(forest_trees=2, forest_depth=2)
    models = training.train_pd_models(pd_data, few, ("forest",))
    training.train_lgd_models(lgd_data, None, ("ridge",))
    assert [p.rdd.getNumPartitions() for p in parts] == [18, 10]
    assert models["forest"].stages[1].getCacheNodeIds()


def test_loss_rows_are_stored_before_their_splits_are_counted(spark, monkeypatch):
    seen = []
    split = training.lgd_split
    monkeypatch.setattr(training, "lgd_split", lambda rows: seen.append(rows) or split(rows))
    catalog._lgd_model_scores(spark, "/root/testdata/sf0.001", ("ridge",))
    assert "lineitem" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_the_two_models_of_a_scenario_run_are_trained_at_one_time(spark, sf_dir, monkeypatch):
    """Each training waits until the other has begun; one after the other, the wait would end in an error."""
    both, pd_fit, lgd_fit = Barrier(2, timeout=120), training.train_pd_models, training.train_lgd_models

    def fit_pd(rows, kinds):
        both.wait()
        return pd_fit(rows, training.PdSettings(boosting_rounds=2, boosting_depth=2), kinds)

    def fit_lgd(rows, kinds):
        both.wait()
        return lgd_fit(rows, training.LgdSettings(boosting_rounds=2, boosting_depth=2), kinds)

    monkeypatch.setattr(training, "train_pd_models", fit_pd)
    monkeypatch.setattr(training, "train_lgd_models", fit_lgd)
    kpis = {r["scenario_name"]: r for r in catalog.CATALOG["model_scenarios"](spark, sf_dir).collect()}
    assert kpis.keys() == {s.scenario_name for s in S.SCENARIOS}
    assert all(0 <= r["mean_pd"] <= 1 and 0 <= r["mean_lgd"] <= 1 for r in kpis.values())


class CountedForest(RandomForestClassifier):
    fits = []

    def _fit(self, dataset):
        CountedForest.fits.append((self.getNumTrees(), self.getSeed(), dataset.rdd.getNumPartitions()))
        return super()._fit(dataset)


def test_a_forest_of_many_rows_is_fitted_in_groups_of_trees(spark, tmp_path):
    draw = random.Random(3)
    rows = [(DenseVector([draw.random(), draw.random()]), 0) for _ in range(900)]
    rows = [(x, int(draw.random() < 0.1 + 0.8 * (x[0] > 0.4))) for x, _ in rows]
    df = spark.createDataFrame(rows, ["features", "y"]).repartition(40).cache()
    learner = CountedForest(labelCol="y", numTrees=10, maxDepth=3, cacheNodeIds=True, checkpointInterval=-1, seed=5)
    CountedForest.fits = []
    forest = training.fit_forest(learner, df, 900, 900 * 4)
    sizes, seeds, parts = zip(*CountedForest.fits)
    assert sorted(sizes) == [3, 3, 4] and len(set(seeds)) == 3
    assert set(parts) == {max(spark.sparkContext.defaultParallelism, 10)}
    assert forest.getNumTrees == 10 and forest.getOrDefault("numTrees") == 10 and forest.getSeed() == 5
    scored = forest.transform(df)
    assert scored.where("prediction = y").count() > 700
    path = str(tmp_path / "forest")
    forest.save(path)
    assert type(forest).load(path).transform(df).select("probability").exceptAll(scored.select("probability")).count() == 0


def test_a_forest_of_few_rows_is_one_fit(spark):
    df = spark.createDataFrame([(DenseVector([float(i)]), i % 2) for i in range(50)], ["features", "y"]).coalesce(1)
    learner = CountedForest(labelCol="y", numTrees=6, maxDepth=2, seed=5)
    CountedForest.fits = []
    forest = training.fit_forest(learner, df, 50)
    assert [n for n, *_ in CountedForest.fits] == [6]
    assert forest.toDebugString.split("\n", 1)[1] == learner.fit(df).toDebugString.split("\n", 1)[1]


def test_dealt_rows_are_read_without_a_shuffle(spark):
    dealt = training.dealt(spark.range(3000).coalesce(2), 100)
    assert dealt.rdd.getNumPartitions() == 30 and dealt.count() == 3000
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()
    assert max(len(part) for part in dealt.rdd.glom().collect()) <= 200


class CountedBoosting(GBTClassifier):
    fits = []

    def _fit(self, dataset):
        CountedBoosting.fits.append(self.getMaxIter())
        return super()._fit(dataset)


def test_rounds_after_the_best_are_cut_off_not_fitted_again(spark):
    draw = random.Random(6)
    rows = [(DenseVector([draw.random(), draw.random()]), int(draw.random() < 0.5), 1.0) for _ in range(300)]
    df = spark.createDataFrame(rows, ["features", "y", "_w"]).coalesce(1).cache()
    learner = CountedBoosting(labelCol="y", weightCol="_w", maxDepth=2, stepSize=0.2, subsamplingRate=0.8, seed=1)
    # The best of the first 6 rounds is the last one, of the next 15 the eighth.
    losses = [9, 8, 7, 6, 5, 4, 4, 3, 5, 5, 5, 5, 5, 5, 5]
    CountedBoosting.fits = []
    model = training.fit_boosted(learner, df, df, 40, 3, lambda m, v: [float(x) for x in losses[: m.getNumTrees]])
    assert CountedBoosting.fits == [6, 15]
    again = learner.copy({learner.maxIter: 8}).fit(df)
    assert model.getNumTrees == 8 and model.getMaxIter() == 8 and model.treeWeights == again.treeWeights
    assert model.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
    assert model.featureImportances == again.featureImportances
    columns = ["prediction", "probability"]
    assert model.transform(df).select(columns).exceptAll(again.transform(df).select(columns)).count() == 0
