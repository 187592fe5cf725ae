"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.llm.common import discard, write_through


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for each node of ``links`` (a, b).

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones;
    rounds end when the links stay the same, after about the logarithm of the longest path. A
    round is stored, so that a lost executor repeats that round only. Nothing is gathered but two
    numbers; a node with very many links is a split key of Spark's join.
    """
    stars = write_through(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links"
    )
    before = None
    while (now := _state(stars)) != before:
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(smallest.select("u", F.col("m").alias("v"))).where("u != v")
        old, stars = stars, write_through(small.distinct(), "links")
        discard(old)
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _state(stars: DataFrame) -> tuple[int, int | None]:
    return tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
