"""Target-distribution importance resampling by hashed n-gram features and Gumbel keys."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read, write_through
from vintara.llm.decontaminate import NORMAL
from vintara.llm.slices import PAD, equal, padded, xxh64

BUCKETS = 10_000
MIN_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
# Text whose n-grams share one table.
GROUP_BYTES = 2_000_000


class Ngrams:
    """Distinct slices of one byte string in an open-addressed table of NumPy arrays.

    A slot holds a key (xxhash64), where its bytes lie, a count and a bucket. Equal keys share a
    slot only if their bytes are equal; otherwise the later one goes on to the next free slot.
    """

    def __init__(self, octets: np.ndarray, most: int):
        self._octets = octets
        slots = 1 << max(4, (2 * most).bit_length())
        self._mask = np.uint64(slots - 1)
        self.key = np.zeros(slots, np.uint64)
        self.start = np.zeros(slots, np.int64)
        self.size = np.zeros(slots, np.int64)  # 0: free
        self.count = np.zeros(slots, np.int64)
        self.bucket = np.zeros(slots, np.int64)

    def intern(self, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
        """The slot of each slice; new ones get one, and all are counted."""
        keys = xxh64(self._octets, starts, sizes) if keys is None else keys
        slots = (keys & self._mask).astype(np.int64)
        todo = np.arange(len(starts))
        while len(todo):
            at = slots[todo]
            free = self.size[at] == 0
            claim, place = todo[free], at[free]
            # Of several that claim a slot one holds it: the one that was written last.
            self.start[place] = claim
            owner = self.start[place]
            self.key[place], self.size[place], self.start[place] = keys[owner], sizes[owner], starts[owner]
            alike = np.flatnonzero((self.key[at] == keys[todo]) & (self.size[at] == sizes[todo]))
            alike = alike[equal(self._octets, self.start[at[alike]], starts[todo[alike]], sizes[todo[alike]])]
            rest = np.ones(len(todo), bool)
            rest[alike] = False
            todo = todo[rest]
            slots[todo] = (slots[todo] + 1) & int(self._mask)
        self.count += np.bincount(slots, minlength=len(self.count))
        return slots

    def place_in_buckets(self, buckets: int) -> None:
        raw = self._octets.tobytes()
        used = np.flatnonzero(self.size)
        ends = self.start[used] + self.size[used]
        self.bucket[used] = [crc32(raw[a:b]) % buckets for a, b in zip(self.start[used].tolist(), ends.tolist(), strict=True)]


def features(texts: list[str | None], buckets: int) -> tuple[Ngrams, np.ndarray, np.ndarray, np.ndarray]:
    """Table of the one and two-word features of ``texts``; slot and text of each occurrence; words of each text."""
    lines = [b" ".join((t or "").encode().translate(NORMAL).split()) for t in texts]
    octets = padded(b"\n".join(lines) + b"\n")
    word = octets[:-PAD] > 0x20
    edge = np.flatnonzero(np.diff(np.r_[False, word, False]))
    starts, ends = edge[::2], edge[1::2]
    line_ends = np.cumsum([len(x) + 1 for x in lines])
    text = np.searchsorted(line_ends, starts, "right")
    pair = np.flatnonzero(text[1:] == text[:-1])
    begin = np.r_[starts, starts[pair]]
    size = np.r_[ends - starts, ends[pair + 1] - starts[pair]]
    table = Ngrams(octets, len(begin))
    slots = table.intern(begin, size)
    table.place_in_buckets(buckets)
    return table, slots, np.r_[text, text[pair]], np.bincount(text, minlength=len(texts))


def groups(texts: list[str | None], most: int = GROUP_BYTES) -> Iterator[slice]:
    """Runs of texts of about ``most`` characters; a longer text is alone."""
    begin = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= most or k == len(texts) - 1:
            yield slice(begin, k + 1)
            begin, size = k + 1, 0


def bucket_counts(df: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts of ``df`` (text) lie in each bucket."""

    def count(batches: Iterator[Columns]) -> Iterator[Columns]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in groups(batch["text"]):
                table, *_ = features(batch["text"][part], buckets)
                np.add.at(total, table.bucket, table.count)
        yield {"bucket": np.flatnonzero(total), "n": total[total > 0]}

    rows = map_batches(df.select("text"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # a row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed bucket shares, target to raw."""
    n = len(raw)
    s_all, t_all = int(raw.sum()), int(target.sum())
    ratios = (((int(t) + 1) * (s_all + n)) / ((int(s) + 1) * (t_all + n)) for s, t in zip(raw, target, strict=True))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, tie (hash of the text), n_words, n_features and weight.

    A weight is the floored mean gain over a text's features, 0 without a feature.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for part in groups(batch["text"]):
                table, slots, text, words = features(batch["text"][part], len(gains))
                size = np.bincount(text, minlength=len(words))
                total = np.zeros(len(words), np.int64)
                np.add.at(total, text, gains[table.bucket[slots]])
                yield {
                    "doc_id": batch["doc_id"][part], "tie": batch["tie"][part], "n_words": words, "n_features": size,
                    "weight": total // np.maximum(size, 1),
                }

    schema = "doc_id long, tie long, n_words long, n_features long, weight long"
    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("tie")), run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Floored thousandths of a Gumbel number that ``doc_id`` and ``seed`` decide."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def with_ranks(rows: DataFrame, order: list[Column], most: Column) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3... in ``order``), null past ``most`` (of the number of rows, ``total``).

    Rows are dealt by range and ranked in each range; its first rank comes from the counts of the
    ranges before, a row for each.
    """
    stored = write_through(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranked-ranges")
    counts = stored.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    every = Window.orderBy("range")
    before = F.coalesce(F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    total = F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total")
    placed = stored.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(*order)))
    ranked = placed.join(counts.select("range", before, total), "range").withColumn("place", F.col("place") + F.col("before"))
    return ranked.withColumn("rank", F.when(F.col("place") <= most, F.col("place").cast("long"))).drop("range", "place", "before", "total")


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED
) -> DataFrame:
    """Rows doc_id, n_features, weight, score and rank for ``docs`` (doc_id, text) by the texts of ``target``.

    Of the rows with at least ``min_words`` words, ``percent`` of 100 are drawn without replacement,
    with chances that grow with the likelihood of their features in ``target`` against ``docs``:
    the highest sums of weight and Gumbel number, which their doc_id and ``seed`` decide. Ties go
    to the smaller doc_id, nulls first, then to the smaller hash of the text; repeated rows rank
    one after the other. A null doc_id draws the number of an empty one. Null and empty texts have
    weight 0 and are never drawn. Two passes over the texts; only counts and scores are shuffled.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weighed(docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    stored = write_through(scored, "scored-documents")
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("tie").asc()]
    drawn = with_ranks(stored.where(F.col("n_words") >= min_words), order, F.floor(F.col("total") * percent / 100))
    rest = stored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: its score against the benchmark and, if drawn, its rank (see ``resample``)."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return resample(docs, read(spark, sf_dir, "benchmark", "text"))


# The checksum is computed bit by bit from its polynomial, eight steps for each byte of a feature.
OP13_SQL = """
with recursive steps as (
  select b::bigint as byte, 0 as step, b::bigint as c from range(256) t(b)
  union all
  select byte, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where step < 8),
crc as (select list(c order by byte) as tab from steps where step = 8),
texts as (
  select 0 as kind, doc_id, text from documents union all select 1, null, text from benchmark),
word_lists as (
  select kind, row_number() over () as row_id, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
  from texts),
feats as (
  select kind, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as feat from word_lists),
spelled as (
  select feat, hex(encode(feat)) as h from (select distinct feat from feats)),
buckets as (
  select feat, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2), lambda i:
      (16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)::bigint)),
    lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from spelled, crc),
placed as (select kind, row_id, bucket from feats join buckets using (feat)),
counts as (
  select b as bucket, coalesce(s, 0) as s, coalesce(t, 0) as t from range(10000) r(b) left join (
    select bucket, count(*) filter (kind = 0) as s, count(*) filter (kind = 1) as t from placed group by bucket) on bucket = b),
whole as (select sum(s) as s_all, sum(t) as t_all from counts),
gains as (
  select bucket, cast(floor(1000 * ln(((t + 1)::double * (s_all + 10000)::double) / ((s + 1)::double * (t_all + 10000)::double))) as bigint) as gain
  from counts, whole),
weights as (
  select row_id, count(*) as n_features, cast(floor(sum(gain)::double / count(*)) as bigint) as weight
  from placed join gains using (bucket) where kind = 0 group by row_id),
scored as (
  select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double))) as bigint) as score
  from word_lists left join weights using (row_id) where kind = 0),
eligible as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_words >= 20)
select s.doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight, cast(score as bigint) as score,
  cast(case when place <= 25 * n // 100 then place end as bigint) as rank
from scored s left join eligible e on e.doc_id = s.doc_id
"""
