"""The physical plans that matter at scale."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.catalog import CATALOG
from vintara import session
from vintara.operators import metrics, ordered
from vintara.operators.ordered import running_totals


def plan(spark, sf_dir, name):
    return CATALOG[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan joins as they would be for tables above the broadcast limit."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


WHOLE = ("panel_rows", "loan_outcomes", "pd_24m", "lgd_dataset", "snapshot_active", "scenario_all", "score_applications", "vintage_curves", "vintage_curves_cumulative", "outcomes_macro")


@pytest.mark.parametrize("name", WHOLE)
def test_no_cross_or_nested_loop_joins(spark, sf_dir, name, no_broadcast):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ("lgd_observed", "loan_outcomes", "pd_12m", "pd_orig", "snapshot_active", "scenario_all", "ecl_by_stage", "vintage_curves", "vintage_curves_cumulative"))
def test_servicing_is_scanned_once(spark, sf_dir, name):
    assert plan(spark, sf_dir, name).count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ("ecl_by_stage", "scenario_all", "scenario_delta", "loan_ecl", "ead_last_nonzero", "first_default", "loan_outcomes", "snapshot_active", "pd_12m", "pd_24m"))
def test_loan_reductions_hash_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "SortAggregate" not in text and "partial_max" in text.replace("partial_bool_or", "partial_max")


def test_unused_columns_are_pruned(spark, sf_dir):
    text = plan(spark, sf_dir, "first_default")
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in lineitem and "l_tax" not in lineitem


@pytest.mark.parametrize("name", ("loan_outcomes", "scenario_all", "vintage_curves"))
def test_servicing_is_reduced_before_the_join(spark, sf_dir, name, no_broadcast):
    """Walking up from the servicing scan, a partial aggregate precedes the join to origination."""
    lines = plan(spark, sf_dir, name).splitlines()
    scan = next(i for i, line in enumerate(lines) if "lineitem.parquet" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
    joins, aggregates = [], []
    for i in range(scan, -1, -1):
        level = len(lines[i]) - len(lines[i].lstrip(" :+-*()0123456789"))
        if level < depth:
            depth = level
            if "Join" in lines[i]:
                joins.append(i)
            if "partial_" in lines[i]:
                aggregates.append(i)
    # The first join is the fixture's own (line items to orders); the next one is to loans.
    assert aggregates and aggregates[0] > joins[1]


def test_panel_join_splits_a_hot_loan(spark, no_broadcast):
    """With a loan holding most rows, AQE splits its partition and the panel stays whole."""
    from tests.helpers import origination, servicing
    from vintara.plans import panel

    hot = [("A", i, "2012-01", 12, "0", None, float(i)) for i in range(1, 4001)]
    rest = [(f"L{i}", i, "2012-01", 12, "0", None, 5.0) for i in range(2000)]
    loans = ["A", *[f"L{i}" for i in range(2000)]]
    orig = origination(spark, [(k, 2011, "2011-01", 700, 80.0, 30.0, 1.0, "NY", "FRM") for k in loans])
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = panel.loan_panel(servicing(spark, [*hot, *rest]).repartition(8), orig)
        assert len(rows.collect()) == 6000
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_deduplication_aggregates_keys_only(spark, sf_dir):
    text = plan(spark, sf_dir, "dedupe_first")
    assert "SortAggregate" not in text and "partial_count" in text


@pytest.mark.parametrize("name, one", [("auc", "pd_12m"), ("roc_points", "pd_12m"), ("decile_calibration", "loan_outcomes"), ("lgd_summary", "loan_outcomes")])
def test_the_input_of_order_statistics_is_computed_once(spark, sf_dir, name, one, monkeypatch):
    """All plans that run for a query, those of stored steps included, scan servicing as often as its input does."""
    plans = []

    def stored(df, step):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.write_through(df, step)

    for module in (ordered, metrics):
        monkeypatch.setattr(module, "write_through", stored)
    final = plan(spark, sf_dir, name)
    assert plans and 0 < "".join([*plans, final]).count("lineitem.parquet") <= plan(spark, sf_dir, one).count("lineitem.parquet")


def test_no_running_total_over_all_values(spark, monkeypatch):
    """Of 300 000 values, half of them equal, only those near the wanted ranks are put in order."""
    rows = spark.range(300_000).select((F.when(F.col("id") % 2 == 0, F.lit(0.25)).otherwise(F.col("id") * 7919 % 300_007 / 300_007)).alias("v"))
    sizes = []

    def counted(counts, *args, **kwargs):
        sizes.append(counts.count())
        return running_totals(counts, *args, **kwargs)

    monkeypatch.setattr(ordered, "running_totals", counted)
    points = [0.0, 0.1, 0.5, 0.77, 1.0]
    found = {r["q"]: r["quantile"] for r in ordered.exact_quantiles(rows, [], "v", points).collect()}
    values = np.array([r["v"] for r in rows.collect()])
    assert [found[q] for q in points] == pytest.approx(np.quantile(values, points).tolist(), abs=1e-12)
    assert sizes[0] < 1500


def test_hot_group_with_many_scores(spark):
    """One group of 100 000 distinct scores: many slices, none with a large part of the rows."""
    counts = spark.range(100_000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 100_003).cast("double").alias("v"), F.lit(1).alias("n"))
    ranked = running_totals(counts, ["g"], "v", ["n"])
    found = ranked.agg(F.max("cum_n"), F.min("all_n"), F.count_distinct("cum_n")).first()
    assert tuple(found) == (100_000, 100_000, 100_000)


def test_rows_are_sketched_once_for_both_ends_of_all_brackets(spark, monkeypatch):
    plans = []

    def stored(df, step):
        if step == "ordered-values":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return session.write_through(df, step)

    monkeypatch.setattr(ordered, "write_through", stored)
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    found = {(r["g"], r["q"]): r["quantile"] for r in ordered.exact_quantiles(rows, ["g"], "v", [0.25, 0.5]).collect()}
    assert found == {(g, q): pytest.approx(2 * 499 * q + g) for g in (0, 1) for q in (0.25, 0.5)}
    assert len(plans) == 1 and plans[0].count("percentile_approx(") == 1
