"""Document fingerprints: the k smallest shingle hashes, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import read, write_through

SHINGLE_WORDS = 5
# Hashes kept: the standard error of a likeness is at most 0.5 / sqrt(128), about 0.045.
KEPT = 128
BLANKS = " \t\n\v\f\r"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` and its lambdas name it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of word shingles; of the whole sequence where there are fewer words.

    Null texts and texts without a word have none.
    """
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    none = F.array().cast("array<bigint>")

    def windows(w: Column) -> Column:
        last = F.size(w) - words
        of_place = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)])
        return F.when(last < 0, F.array(F.xxhash64(w))).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of_place))

    return bind(inner, lambda t: F.when(t == "", none).otherwise(
        F.array_distinct(bind(F.transform(F.split(t, "[ \\t-\\r]+"), lambda w: F.xxhash64(w)), windows))
    ))


def sketch(text: Column, kept: int = KEPT) -> Column:
    return F.slice(F.sort_array(shingle_hashes(text)), 1, kept)


def merge(a: Column, b: Column, kept: int = KEPT) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, kept)


def resemblance(a: Column, b: Column, kept: int = KEPT) -> Column:
    """Estimated Jaccard likeness; exact while the union has at most ``kept`` shingles. Two empty sketches are alike."""
    common = lambda u: F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u)
    return bind(merge(a, b, kept), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(common(u)))


def distinct_shingles(a: Column, kept: int = KEPT) -> Column:
    """Estimated number of distinct shingles; exact below ``kept``."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < kept, F.size(a).cast("double")).otherwise(F.lit(kept - 1.0) / share)


def containment(a: Column, b: Column, kept: int = KEPT) -> Column:
    """Estimated part of a's shingles that b has as well."""
    share = resemblance(a, b, kept) * distinct_shingles(merge(a, b, kept), kept) / distinct_shingles(a, kept)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash, ascending."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def sketch_parts(parts: DataFrame, group: str, kept: int = KEPT) -> DataFrame:
    """One sketch for each ``group`` of ``parts`` (with ``sketch``): the smallest hashes of all parts.

    Parts meet in two steps, first by group and a hash of the part, so that a group with a third
    of all parts is merged by many tasks. Each step keeps ``kept`` hashes of what it has seen.
    """
    salted = parts.select(group, F.pmod(F.xxhash64("sketch"), F.lit(64)).alias("salt"), F.explode("sketch").alias("h")).distinct()
    place = Window.partitionBy(group, "salt").orderBy("h")
    few = salted.withColumn("place", F.row_number().over(place)).where(F.col("place") <= kept)
    return few.groupBy(group).agg(F.slice(F.sort_array(F.collect_set("h")), 1, kept).alias("sketch"))


def next_documents(docs: DataFrame) -> DataFrame:
    """For each (doc, tie) the pair that follows in order (``next_doc``, ``next_tie``), the first after the last.

    Pairs are dealt by range and ordered in each range; only the first pair of each range is known
    to the range before. Repeated rows are one pair.
    """
    pairs = docs.groupBy("doc", "tie").agg(F.max("n_chars").alias("n_chars"))
    dealt = pairs.repartitionByRange("doc", "tie").withColumn("range", F.spark_partition_id())
    stored = write_through(dealt, "document-order")
    firsts = stored.groupBy("range").agg(F.min(F.struct("doc", "tie")).alias("head"))
    ranges = Window.orderBy("range")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("range", F.coalesce(F.lead("head").over(ranges), F.first("head").over(whole)).alias("past"))
    after = F.lead(F.struct("doc", "tie")).over(Window.partitionBy("range").orderBy("doc", "tie"))
    linked = stored.withColumn("after", after).join(firsts, "range")
    follower = F.coalesce("after", "past")
    return linked.select("doc", "tie", "n_chars", follower["doc"].alias("next_doc"), follower["tie"].alias("next_tie"))


def with_edited(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``edited`` (its last quarter from the next document) and ``next_sketch``.

    A null text is empty; null doc_ids come first; equal doc_ids are ordered by a hash of the text.
    Texts are shuffled once; of the next document only the needed head and the sketch move.
    """
    body = F.coalesce("text", F.lit(""))
    doc = F.coalesce("doc_id", F.lit(-(2**63)))
    texts = docs.select(
        "doc_id", body.alias("text"), doc.alias("doc"), F.xxhash64(body, F.col("doc_id").isNull()).alias("tie"),
        F.length(body).cast("long").alias("n_chars"),
    )
    order = next_documents(texts.select("doc", "tie", "n_chars"))
    asked = order.select(
        F.col("next_doc").alias("doc"), F.col("next_tie").alias("tie"),
        F.struct(F.col("doc").alias("doc"), F.col("tie").alias("tie")).alias("asker"), (F.col("n_chars") / 4).cast("int").alias("need"),
    )
    # All columns of texts are taken along, so that both joins read one and the same shuffle of it.
    head = F.substring("text", F.lit(1), F.col("need")).alias("head")
    given = texts.join(asked, ["doc", "tie"]).select(
        F.col("asker.doc").alias("doc"), F.col("asker.tie").alias("tie"),
        F.struct(head, sketch(F.col("text")).alias("sketch"), "doc_id", "n_chars").alias("given"),
    )
    # Repeated rows of the next document give the same; one is enough.
    given = given.groupBy("doc", "tie").agg(F.max("given").alias("given"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - (F.col("n_chars") / 4).cast("long")).cast("int"))
    return texts.join(given, ["doc", "tie"]).select(
        "doc_id", "n_chars", "text", F.concat(kept, F.col("given.head")).alias("edited"), F.col("given.sketch").alias("next_sketch")
    )


def op9_bottomk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_edited(read(spark, sf_dir, "documents", "doc_id", "text"))
    found = docs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "next_sketch",
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("changed"),
    )
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"),
    )
