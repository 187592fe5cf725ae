"""Exact order statistics that stay distributed: running totals, quantiles, histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintara.session import write_through

# One part in ACCURACY of the rows of a group is how far a sketched rank may be off.
ACCURACY = 10_000


def running_totals(
    counts: DataFrame, groups: list[str], value: str, sums: list[str], descending: bool = False
) -> DataFrame:
    """Running sum of ``sums`` per group, by ``value``, as columns ``cum_<name>``; ``all_<name>`` is the whole.

    A prefix scan over ranges: ``counts`` (one row per group and value) is dealt by range of group
    and value and stored, so that it is computed once. Each range is summed, a range starts from
    the totals of the ranges of its group before it, and every row adds the running sum inside its
    range. No task holds more than a range, however large a group is.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    dealt = counts.repartitionByRange(*groups, order).withColumn("_range", F.spark_partition_id())
    stored = write_through(dealt, "ordered-values")
    keys = [*groups, "_range"]
    # A row per range, and one more for each group that starts inside a range.
    totals = stored.groupBy(*keys).agg(*[F.sum(s).alias(f"_total_{s}") for s in sums])
    in_group = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    earlier = in_group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_total_{s}").over(earlier), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_total_{s}").over(in_group).alias(f"all_{s}") for s in sums],
    )
    within = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = stored.withColumns({f"cum_{s}": F.sum(s).over(within) for s in sums})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return (
        inside.join(offsets, same)
        .withColumns({f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_before_{s}") for s in sums})
        .drop("_range", *[f"_of_{k}" for k in keys], *[f"_before_{s}" for s in sums])
    )


def known_values(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Groups and known values of ``df``, stored, so that ``df`` is computed once for all their uses."""
    return write_through(df.where(F.col(value).isNotNull()).select(*groups, value), "quantile-values")


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, points: list[float]
) -> DataFrame:
    """Linear-interpolation quantiles per group: columns (groups, q, quantile). Nulls are ignored."""
    return quantiles_of_rows(known_values(df, groups, value), groups, value, points)


def quantiles_of_rows(
    rows: DataFrame, groups: list[str], value: str, points: list[float]
) -> DataFrame:
    """Exact quantiles of stored ``rows`` by selection in two passes.

    The first pass sketches each group: around each wanted rank a bracket of values is sure to
    hold it. The second counts the values inside a bracket one by one and those of each gap
    between brackets as a whole, so that equal values cost one row and only about 4 in ACCURACY
    of a group's rows per point are put in order. A small group is one bracket.
    """
    points = sorted(points)
    margin = 2 / ACCURACY
    lows, highs = [max(0.0, p - margin) for p in points], [min(1.0, p + margin) for p in points]
    sketch = rows.groupBy(*groups).agg(
        F.count(value).alias("_n"), F.min(value).alias("_least"), F.max(value).alias("_most"),
        # Both ends of all brackets from one sketch: rows are sketched once.
        F.percentile_approx(value, [*lows, *highs], ACCURACY).alias("_ends"),
    )
    small = F.col("_n") <= ACCURACY

    def bracket(k: int) -> Column:
        low = F.when(small | F.lit(lows[k] == 0.0), F.col("_least")).otherwise(F.col("_ends")[k])
        high = F.when(small | F.lit(highs[k] == 1.0), F.col("_most")).otherwise(F.col("_ends")[len(points) + k])
        return F.struct(low.alias("low"), high.alias("high"))

    facts = sketch.select(*groups, F.array(*[bracket(k) for k in range(len(points))]).alias("_brackets"))
    v = F.col(value)
    inside = F.exists("_brackets", lambda b: (b["low"] <= v) & (v <= b["high"]))
    above = F.size(F.filter("_brackets", lambda b: b["low"] > v))
    counted = (
        attach(rows, facts, groups, ["_brackets"])
        .select(*groups, v, F.when(inside, v).alias("_v"), F.when(~inside, above).alias("_gap"))
        .groupBy(*groups, "_v", "_gap").agg(F.count("*").alias("n"), F.min(value).alias(value))
    )
    ranked = running_totals(counted.drop("_v"), groups, value, ["n"])
    return _interpolated(ranked, groups, value, points)


def _interpolated(ranked: DataFrame, groups: list[str], value: str, points: list[float]) -> DataFrame:
    """Quantiles from rows with count ``n``, running ``cum_n`` and ``all_n``; no wanted rank is in a ``_gap``."""
    wanted = F.array(*[F.lit(float(p)) for p in points])

    def ranks(q: Column) -> Column:
        place = q * (F.col("all_n") - 1)
        return F.struct(q.alias("q"), (place - F.floor(place)).alias("share"), F.floor(place).alias("low"), F.ceil(place).alias("high"))

    start, end = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    holds = lambda rank: (rank >= start) & (rank <= end)
    # A row gives only the points whose ranks fall on it: two rows per point in total.
    hits = ranked.select(
        *groups, F.col(value).cast("double").alias("_x"), "_gap", start.alias("_start"), end.alias("_end"),
        F.explode(F.filter(F.transform(wanted, ranks), lambda p: holds(p["low"]) | holds(p["high"]))).alias("_p"),
    )
    sure = F.when(F.col("_gap").isNull(), F.col("_x")).otherwise(F.raise_error(F.lit("a sketched rank was off by more than it may be")).cast("double"))
    at = lambda rank: F.max(F.when((rank >= F.col("_start")) & (rank <= F.col("_end")), sure))
    return (
        hits.groupBy(*groups, F.col("_p.q").alias("q"), F.col("_p.share").alias("_share"))
        .agg(at(F.col("_p.low")).alias("_a"), at(F.col("_p.high")).alias("_b"))
        .select(*groups, "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")).alias("quantile"))
    )


def histogram(df: DataFrame, groups: list[str], value: str, bins: int) -> DataFrame:
    """Equal-width bins over each group's own range; only non-empty bins are returned.

    A group with a single distinct value gets the range value +- 0.5.
    """
    known = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_x"))
    # Equal values collapse before the range is known, so the data is scanned once per use.
    counts = known.groupBy(*groups, "_x").agg(F.count("*").alias("_n"))
    span = counts.groupBy(*groups).agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    flat = F.col("_min") == F.col("_max")
    span = span.select(
        *groups,
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("bin_from"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("bin_to"),
    )
    joined = attach(counts, span, groups, ["bin_from", "bin_to"])
    width = (F.col("bin_to") - F.col("bin_from")) / F.lit(float(bins))
    place = F.floor((F.col("_x") - F.col("bin_from")) / width)
    return (
        joined.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(*groups, "bin")
        .agg(F.sum("_n").alias("rows"))
    )


def attach(rows: DataFrame, facts: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """Add per-group facts to rows as a scalar subquery; groups have few values.

    With groups the scalar is a map by group, so that rows are not shuffled by a key of a few
    values.
    """
    fact = F.struct(*names)
    if not groups:
        record = rows.withColumn("_fact", facts.select(fact).scalar())
    else:
        entry = F.struct(F.struct(*groups).alias("key"), fact.alias("fact"))
        by_group = facts.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()
        record = rows.withColumn("_facts", by_group).withColumn("_fact", F.try_element_at("_facts", F.struct(*groups))).drop("_facts")
    return record.withColumns({n: F.col(f"_fact.{n}") for n in names}).drop("_fact")


def bin_by_edges(value: Column, edges: Column) -> Column:
    """Index of the right-closed bin: how many inner edges lie below ``value``."""
    inner = F.slice(edges, 2, F.size(edges) - 2)
    return F.size(F.filter(inner, lambda e: e < value))
