"""Default and loss-severity models as persistable Spark ML pipelines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara import schema as S
from vintara.functions.nullsafe import columns_present
from vintara.operators import metrics as M
from vintara.operators.ordered import exact_quantiles
from vintara.plans.datasets import fill_empty_splits, with_split
from vintara.plans.portfolio import Scoring
from vintara.session import file_a_task_session, scratch_path

UNKNOWN = "UNK"  # fixed value: stands for a missing category
# Encoded rows that a file of a learner's input holds at most: about 0.9 kB each with what boosting keeps.
ROWS_A_TASK = 100_000
# Rows times trees of one fit of a forest at most: about 12 bytes each (a count, two nodes), in memory or on disk.
NODES_KEPT = 600_000_000


@dataclass(frozen=True)
class PdSettings:
    """Fixed values as defaults. Boosting keeps the best round of at most ``boosting_rounds``."""

    inverse_penalty: float = 0.1
    logistic_iterations: int = 1000
    boosting_rounds: int = 500
    boosting_depth: int = 6
    boosting_step: float = 0.05
    patience: int = 30
    forest_trees: int = 300
    forest_depth: int = 10
    forest_min_leaf: int = 50
    sampled_share: float = 0.8
    seed: int = 42


@dataclass(frozen=True)
class LgdSettings:
    """Fixed values as defaults. Boosting keeps the best round of at most ``boosting_rounds``."""

    ridge_alpha: float = 1.0
    boosting_rounds: int = 600
    boosting_depth: int = 5
    boosting_step: float = 0.03
    patience: int = 40
    min_leaf: int = 20
    sampled_share: float = 0.8
    seed: int = 42


def median_table(train: DataFrame, columns: list[str]) -> DataFrame:
    """Exact median of each numeric column in one job: (feature, median_value)."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    long = train.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")
    medians = exact_quantiles(long, ["feature"], "value", [0.5])
    return medians.select("feature", F.col("quantile").alias("median_value"))


def fit_preprocessor(
    train: DataFrame, numeric: tuple[str, ...], categorical: tuple[str, ...]
) -> PipelineModel:
    """Median-filled, standardised numbers and one-hot categories in column ``features``.

    Fitted on training rows only. A category unseen in training encodes as all zeros; every
    training category keeps its own slot.
    """
    numbers, codes = columns_present(train, numeric), columns_present(train, categorical)
    # One row per numeric feature reaches the driver; they become literals of the pipeline.
    medians = {r["feature"]: r["median_value"] for r in median_table(train, numbers).collect()}
    filled = [
        f"coalesce(cast(`{c}` as double), double('{medians.get(c, 0.0)!r}')) as `_n_{c}`" for c in numbers
    ] + [f"coalesce(cast(`{c}` as string), '{UNKNOWN}') as `_c_{c}`" for c in codes]
    stages = [
        SQLTransformer(statement=f"select *, {', '.join(filled)} from __THIS__"),
        VectorAssembler(inputCols=[f"_n_{c}" for c in numbers], outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
    ]
    parts = ["_scaled"]
    if codes:
        indexed = [f"_i_{c}" for c in codes]
        hot = [f"_h_{c}" for c in codes]
        stages += [
            StringIndexer(
                inputCols=[f"_c_{c}" for c in codes], outputCols=indexed,
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ),
            # The indexer's extra slot for unseen values is the last one, which is dropped.
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        parts += hot
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def feature_names(preprocessor: PipelineModel, numeric: list[str], categorical: list[str]) -> list[str]:
    """Readable name of every slot of ``features``."""
    names = list(numeric)
    indexers = [s for s in preprocessor.stages if hasattr(s, "labelsArray")]
    for indexer in indexers:
        for column, labels in zip(categorical, indexer.labelsArray, strict=True):
            names += [f"{column}_{label}" for label in labels]
    return names


def importance_table(train: DataFrame, preprocessor: PipelineModel, model, numeric, categorical) -> DataFrame:
    """(feature, importance), one row per feature slot."""
    names = feature_names(
        preprocessor, columns_present(train, numeric), columns_present(train, categorical)
    )
    values = model.featureImportances.toArray().tolist()
    rows = list(zip(names, values, strict=True))
    return train.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def calibrate(
    preprocessor: PipelineModel, classifier: Transformer, valid: DataFrame, label: str
) -> PipelineModel:
    """Isotonic calibration of a fitted classifier on encoded validation rows.

    The fitted preprocessor and classifier are reused as they are, so the calibrated pipeline
    keeps the training vocabulary even when validation lacks some categories.
    """
    scored = classifier.transform(valid).select(label, "probability")
    isotonic = IsotonicRegression(
        featuresCol="probability", featureIndex=1, labelCol=label, predictionCol="pd_pred"
    )
    return PipelineModel([preprocessor, classifier, isotonic.fit(scored)])


def _label_weights(train: DataFrame, label: str) -> dict[int, float]:
    return {r[label]: float(r["count"]) for r in train.groupBy(label).count().collect()}  # 2 rows


def _weighted(df: DataFrame, label: str, weights: dict[int, float], name: str) -> DataFrame:
    weight = F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))
    return df.withColumn(name, weight)


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Number of rounds with the least loss, and whether ``patience`` later ones were no better.

    Rounds after such a stop don't count, also where their losses are known.
    """
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(learner, train: DataFrame, valid: DataFrame, rounds: int, patience: int, losses_of):
    """Boosted model of the round that does best on ``valid``.

    Fits some rounds and looks at the validation loss after each, until the best is ``patience``
    rounds old or ``rounds`` are reached. A longer fit starts from zero and has rounds enough to
    settle if the best then is at most twice as late. Rounds after the best are cut off, as a fit of
    that number gives the same first trees by the same seed. Without validation rows all rounds stay.
    """
    if valid.isEmpty():
        return learner.copy({learner.maxIter: rounds}).fit(train)
    size = min(rounds, 2 * patience)
    while True:
        model = learner.copy({learner.maxIter: size}).fit(train)
        best, settled = best_round(losses_of(model, valid), patience)
        if settled or size == rounds:
            break
        size = min(rounds, 2 * best + patience)
    return first_rounds(model, best)


def _with_trees(model, trees: list, extra: list, params: dict):
    """A model of the kind and settings of ``model`` that holds these JVM trees."""
    gateway = SparkContext._active_spark_context._gateway
    held = gateway.new_array(getattr(gateway.jvm, trees[0].getClass().getName()), len(trees))
    for k, tree in enumerate(trees):
        held[k] = tree
    ours = model._java_obj
    made = getattr(gateway.jvm, ours.getClass().getName())(ours.uid(), held, *extra)
    made = model._copyValues(type(model)(made), params)
    made._transfer_params_to_java()
    return made


def first_rounds(model, n: int):
    """The boosted model as it was after ``n`` rounds."""
    if n == model.getNumTrees:
        return model
    ours = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    weights = gateway.new_array(gateway.jvm.double, n)
    for k, weight in enumerate(model.treeWeights[:n]):
        weights[k] = weight
    facts = [ours.numFeatures(), *([ours.numClasses()] if hasattr(model, "numClasses") else [])]
    return _with_trees(model, list(ours.trees())[:n], [weights, *facts], {model.maxIter: n})


def _split(dataset: DataFrame, split) -> DataFrame:
    """The dataset as it is when it is split already, so that all steps see one split."""
    return dataset if "split" in dataset.columns else split(dataset)


def dealt(encoded: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Rows stored once, read in as many partitions as their number needs, so that a task does not grow with them.

    A file scan of narrow encoded rows makes about one partition a core, whatever their number. Files
    hold ``rows_a_task`` rows at most and a task reads one (or two, where writers left small ones), so
    that no reader has to shuffle the rows to deal them.
    """
    spark = encoded.sparkSession
    path = scratch_path(spark, "encoded-rows")
    encoded.write.option("maxRecordsPerFile", rows_a_task).parquet(path)
    stored = spark.read.schema(encoded.schema).parquet(path)
    needed = -(-stored.count() // rows_a_task)
    if needed <= stored.rdd.getNumPartitions():
        return stored
    return file_a_task_session(spark).read.schema(encoded.schema).parquet(path).coalesce(needed)


def fit_forest(learner, train: DataFrame, rows: int, kept: int = NODES_KEPT):
    """Forest fitted in groups of trees, so that rows times trees of a group are at most ``kept``.

    A fit keeps a count and a node for each row and tree, and each task gives the sums of all nodes
    of a level. Trees don't depend on each other, so that the groups together are the forest; each
    group has a seed of its own. Few rows are one group.
    """
    trees = learner.getNumTrees()
    groups = min(trees, max(1, -(-rows * trees // kept)))
    if groups == 1:
        return learner.fit(train)
    # The sums grow with tasks, the rows that a task reads are not held: fewer tasks write less.
    parts = train.coalesce(max(train.sparkSession.sparkContext.defaultParallelism, train.rdd.getNumPartitions() // 4))
    models = []
    for k in range(groups):
        size = trees * (k + 1) // groups - trees * k // groups
        # Seeds of neighbouring partitions are neighbours too, so those of groups lie far apart.
        models.append(learner.copy({learner.numTrees: size, learner.seed: learner.getSeed() + k * 1_000_003}).fit(parts))
        # Spark deletes the shuffle files of a finished fit once the driver has collected its garbage.
        train.sparkSession.sparkContext._jvm.System.gc()
    first = models[0]
    facts = [first.numFeatures, first.numClasses]
    return _with_trees(first, [t for m in models for t in m._java_obj.trees()], facts, {first.numTrees: trees, first.seed: learner.getSeed()})


def lgd_split(dataset: DataFrame) -> DataFrame:
    return fill_empty_splits(with_split(dataset))


def train_pd_models(
    dataset: DataFrame,
    settings: PdSettings | None = None,
    kinds: tuple[str, ...] = ("logit", "boosted", "forest"),
) -> dict[str, PipelineModel]:
    """Fit the default models on the training rows of ``dataset``, by its ``split`` or by vintage.

    Keys: "logit", "forest", "boosted" (isotonic-calibrated on validation vintages) and
    "boosted_raw". The learners pass over the training rows many times, so the encoded rows are
    written once to the shared folder.
    """
    settings = settings or PdSettings()
    label = "PD_TARGET"
    rows = _split(dataset, with_split)
    train = rows.where(F.col("split") == "train")
    preprocessor = fit_preprocessor(train, S.PD_NUMERIC, S.PD_CATEGORICAL)
    encoded = preprocessor.transform(rows.where(F.col("split").isin("train", "valid"))).select(
        "features", F.col(label).cast("int").alias(label), "split"
    )
    encoded = dealt(encoded)
    fit_rows = encoded.where(F.col("split") == "train")
    counts = _label_weights(fit_rows, label)
    negatives, positives = counts.get(0, 0.0), counts.get(1, 0.0)
    total = negatives + positives
    balanced = {0: total / (2 * max(negatives, 1.0)), 1: total / (2 * max(positives, 1.0))}
    models: dict[str, PipelineModel] = {}
    if "logit" in kinds:
        learner = LogisticRegression(
            labelCol=label, weightCol="_w", maxIter=settings.logistic_iterations, standardization=False,
            regParam=1.0 / (settings.inverse_penalty * total), elasticNetParam=0.0,
        )
        fitted = learner.fit(_weighted(fit_rows, label, balanced, "_w"))
        models["logit"] = PipelineModel([preprocessor, fitted])
    if "boosted" in kinds:
        learner = GBTClassifier(
            labelCol=label, weightCol="_w", maxDepth=settings.boosting_depth, stepSize=settings.boosting_step,
            subsamplingRate=settings.sampled_share, featureSubsetStrategy=str(settings.sampled_share),
            seed=settings.seed,
        )
        raised = _weighted(encoded, label, {0: 1.0, 1: negatives / max(positives, 1.0)}, "_w")
        parts = [raised.where(F.col("split") == name) for name in ("train", "valid")]
        fitted = fit_boosted(learner, *parts, settings.boosting_rounds, settings.patience, lambda m, v: m.evaluateEachIteration(v))
        models["boosted_raw"] = PipelineModel([preprocessor, fitted])
        models["boosted"] = calibrate(preprocessor, fitted, encoded.where(F.col("split") == "valid"), label)
    if "forest" in kinds:
        learner = RandomForestClassifier(
            labelCol=label, weightCol="_w", numTrees=settings.forest_trees,
            maxDepth=settings.forest_depth, minInstancesPerNode=settings.forest_min_leaf,
            # The node of each row and tree is kept, else every level walks all trees from their roots.
            cacheNodeIds=True, checkpointInterval=-1, seed=settings.seed,
        )
        fitted = fit_forest(learner, _weighted(fit_rows, label, balanced, "_w"), int(total))
        models["forest"] = PipelineModel([preprocessor, fitted])
    return models


def predict_pd(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``pd_pred`` to rows, keeping their own columns."""
    kept = rows.columns
    scored = model.transform(rows)
    if "pd_pred" not in scored.columns:
        scored = scored.withColumn("pd_pred", vector_to_array("probability")[1])
    return scored.select(*kept, "pd_pred")


def train_lgd_models(
    dataset: DataFrame,
    settings: LgdSettings | None = None,
    kinds: tuple[str, ...] = ("ridge", "boosted"),
) -> dict[str, PipelineModel]:
    """Fit the loss-severity models on the training rows, by ``split`` or by vintage: "ridge" and "boosted"."""
    settings = settings or LgdSettings()
    label = "lgd_observed"
    rows = _split(dataset, lgd_split)
    train = rows.where(F.col("split") == "train")
    preprocessor = fit_preprocessor(train, S.LGD_NUMERIC, S.LGD_CATEGORICAL)
    encoded = preprocessor.transform(rows.where(F.col("split").isin("train", "valid"))).select(
        "features", label, "split"
    )
    encoded = dealt(encoded)
    fit_rows = encoded.where(F.col("split") == "train")
    models: dict[str, PipelineModel] = {}
    if "ridge" in kinds:
        facts = fit_rows.agg(F.count("*").alias("n"), F.stddev_pop(label).alias("sd")).first()
        # The normal solver scales the penalty by the label's deviation.
        penalty = settings.ridge_alpha * (facts["sd"] or 1.0) / facts["n"]
        learner = LinearRegression(
            labelCol=label, predictionCol="_raw", regParam=penalty, elasticNetParam=0.0,
            standardization=False, solver="normal",
        )
        models["ridge"] = PipelineModel([preprocessor, learner.fit(fit_rows), _clipped("_raw")])
    if "boosted" in kinds:
        learner = GBTRegressor(
            labelCol=label, predictionCol="_raw", maxDepth=settings.boosting_depth, stepSize=settings.boosting_step,
            subsamplingRate=settings.sampled_share, featureSubsetStrategy=str(settings.sampled_share),
            minInstancesPerNode=settings.min_leaf, seed=settings.seed,
        )
        valid = encoded.where(F.col("split") == "valid")
        fitted = fit_boosted(learner, fit_rows, valid, settings.boosting_rounds, settings.patience, lambda m, v: m.evaluateEachIteration(v, "squared"))
        models["boosted"] = PipelineModel([preprocessor, fitted, _clipped("_raw")])
    return models


def _clipped(raw: str) -> SQLTransformer:
    return SQLTransformer(
        statement=f"select *, greatest(double(0), least(double(1), {raw})) as lgd_pred from __THIS__"
    )


def predict_lgd(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``lgd_pred`` in [0, 1] to rows, keeping their own columns."""
    return model.transform(rows).select(*rows.columns, "lgd_pred")


def scored_splits(models: dict[str, PipelineModel], dataset: DataFrame, predict, column: str, label: str) -> DataFrame:
    """Validation and test rows scored by every model: (loan, model, split, label, score)."""
    rows = _split(dataset, with_split).where(F.col("split").isin("valid", "test"))
    parts = [
        predict(model, rows).select(
            S.LOAN, F.lit(name).alias("model"), "split", F.col(label).cast("double").alias("label"),
            F.col(column).alias("score"),
        )
        for name, model in models.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def pd_metrics(scored: DataFrame) -> DataFrame:
    """AUC, average precision, KS and Brier score for every model and split, in one job."""
    groups = ["model", "split"]
    return M.classification_metrics(M.roc_points(scored, groups, "label", "score"), groups)


def lgd_metrics(scored: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 for every model and split, in one job."""
    return M.regression_metrics(scored, ["model", "split"], "label", "score")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_if_saved(spark: SparkSession, path: str) -> PipelineModel | None:
    """The model saved under ``path``, None if there is none; a damaged one is an error."""
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return load_model(path)


def saved_scoring(spark: SparkSession, folder: str) -> Scoring:
    """Scoring by the saved models of ``folder``, by the heuristic where one is missing."""
    pd_model, lgd_model = (load_if_saved(spark, f"{folder}/{name}") for name in ("pd", "lgd"))
    return Scoring(
        None if pd_model is None else lambda rows: predict_pd(pd_model, rows),
        None if lgd_model is None else lambda rows: predict_lgd(lgd_model, rows),
    )
