"""Phrase collocations by dynamic itemset counting over cyclic shard scans."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from uuid import uuid4

import numpy as np
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read, remove, scratch_path, write_through
from vintara.llm.jaccard import word_hashes

SHARDS = 3
LONGEST = 4
THRESHOLD = 30
COVERED_PERCENT = 80
SCALE = 2_000_000
BEST = 2_000
UNKNOWN = "und"
# Bits of a bitmap of phrases (16 MB); more phrases only let more through that are too rare.
BITMAP_BITS = 1 << 27
# Text whose phrases are counted at once in a task.
GROUP_BYTES = 3_000_000

# A-Z count as a-z; a tab parts words as a space does; the signs that end a piece become line ends.
PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)

KEY = ["k", "key", "check"]
COUNTED = "k int, key long, check int, doc int, n long"
# Parts of a phrase: the left and the right one of each cut, and the middle two of four words.
PARTS = {(1, 1): "l1", (2, -1): "r1", (1, 2): "l2", (3, -1): "r2", (1, 3): "l3", (4, -1): "r3", (2, 2): "mid"}
DESCRIBED = "k int, key long, check int, lang string, phrase string, " + ", ".join(f"{name} long" for name in PARTS.values())
# Classes of documents, one of which stands with a phrase for where its words are found.
DOC_CLASSES = 1 << 16
STEP = np.uint64(0x9E3779B97F4A7C15)


def _turn(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Text:
    """Words of some texts with their languages, and numbers of the phrases at each place.

    A phrase of k words at place i has the number keys[k - 1][i] (64 bits, its language included)
    and a second one (``check``, of which 32 bits are used).
    """

    def __init__(self, texts: list[str | None], langs: list[str], docs: list[int]):
        parts = [(t or "").encode().translate(PIECES) + b"\n" for t in texts]
        self.raw = b"".join(parts)
        octets = np.frombuffer(self.raw, np.uint8)
        lines = np.flatnonzero(octets == 10)
        self.h, self.starts = word_hashes(octets)
        self.piece = np.searchsorted(lines, self.starts)
        self._blanks = np.flatnonzero((octets == 10) | (octets == 32))
        of_word = np.searchsorted(np.cumsum([len(p) for p in parts]), self.starts, "right")
        self.langs = sorted(set(langs))
        number = {x: k for k, x in enumerate(self.langs)}
        self.lang = np.array([number[x] for x in langs], np.int64)[of_word]
        self.doc = np.array(docs, np.int32)[of_word]
        salts = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs], np.uint64)
        first = self.h ^ salts[self.lang]
        self._salts = salts
        self.keys = [_turn(first)]
        self.whole = [np.ones(len(first), bool)]

    def grow(self) -> None:
        """One word more: numbers of these phrases, and where they lie within a piece (``whole``)."""
        k = len(self.keys)
        self.keys.append(_turn(self.keys[-1][:-1] * STEP + self.h[k:]))
        self.whole.append(self.piece[k:] == self.piece[: max(0, len(self.piece) - k)])

    def check(self, k: int, at: np.ndarray) -> np.ndarray:
        found = self._salts[self.lang[at]]
        for j in range(k):
            found = _turn((found ^ self.h[at + j]) * STEP)
        return found

    def distinct(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the places ``at``, one for each distinct phrase of ``k`` words, and how many have that phrase."""
        key, check = self.keys[k - 1][at], self.check(k, at)
        _, first, which, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        if (check != check[first][which]).any():
            _, first, n = np.unique(np.stack([key, check], axis=1), axis=0, return_index=True, return_counts=True)
        return at[first], n

    def named(self, k: int, at: np.ndarray) -> Columns:
        return {
            "k": np.full(len(at), k, np.int32), "key": self.keys[k - 1][at].view(np.int64),
            "check": (self.check(k, at) >> np.uint64(32)).astype(np.uint32).view(np.int32),
        }

    def counted(self, k: int, at: np.ndarray) -> Columns:
        """A row for each distinct phrase of ``k`` words that starts at one of the places ``at``."""
        places, n = self.distinct(k, at)
        return {**self.named(k, places), "doc": self.doc[places], "n": n.astype(np.int64)}

    def described(self, k: int, at: np.ndarray) -> Columns:
        """Words and parts of the distinct phrases of ``k`` words at ``at``."""
        places, _ = self.distinct(k, at)
        out = self.named(k, places)
        out["lang"] = np.array(self.langs, object)[self.lang[places]].tolist()
        ends = self._blanks[np.searchsorted(self._blanks, self.starts[places + k - 1])]
        cuts = zip(self.starts[places].tolist(), ends.tolist(), strict=True)
        out["phrase"] = [b" ".join(self.raw[a:b].split()).decode() for a, b in cuts]
        none = [None] * len(places)
        for (first, size), name in PARTS.items():
            size = k - first + 1 if size < 0 else size
            inside = size >= 1 and first + size - 1 <= k and size < k
            out[name] = self.keys[size - 1][places + first - 1].view(np.int64) if inside else none
        return out


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - (8 * len(bitmap) - 1).bit_length())
    return ((bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _in_doc(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return _turn(keys + docs.astype(np.uint64) * STEP)


def active(text: Text, reached: np.ndarray, lately: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths and places of the phrases to count: both parts reached the threshold, one of them lately."""
    for k in range(2, longest + 1):
        known = _has(reached, text.keys[-1])
        fresh = known & _has(lately, text.keys[-1])
        text.grow()
        at = np.flatnonzero(text.whole[-1] & known[:-1] & known[1:] & (fresh[:-1] | fresh[1:]))
        if len(at):
            yield k, at


def grouped(batches: Iterator[Columns]) -> Iterator[Text]:
    """Texts of several batches, of about GROUP_BYTES characters; a longer text comes with those before it."""
    texts, langs, docs, size = [], [], [], 0
    for batch in batches:
        for text, lang, doc in zip(batch["text"], batch["lang"], batch["doc"], strict=True):
            texts.append(text)
            langs.append(lang)
            docs.append(doc)
            size += len(text)
            if size >= GROUP_BYTES:
                yield Text(texts, langs, docs)
                texts, langs, docs, size = [], [], [], 0
    if texts:
        yield Text(texts, langs, docs)


def packed(bitmap: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(bitmap.tobytes())


def unpacked(bitmap: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bitmap), np.uint8)


def scan(shard: DataFrame, words: bool, longest: int, maps: Broadcast | None) -> DataFrame:
    """Counts of the active phrases in one shard, and of all ``words`` if these are active."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        known = [unpacked(m) for m in maps.value] if maps else None
        for text in grouped(batches):
            if words and len(text.h):
                yield text.counted(1, np.arange(len(text.h)))
            if known and len(text.h):
                for k, at in active(text, *known, longest):
                    yield text.counted(k, at)

    return map_batches(shard, run, COUNTED).repartition("key").groupBy(*KEY).agg(F.sum("n").alias("n"), F.min("doc").alias("doc"))


def totals(log: DataFrame, visit: int, shards: int, threshold: int) -> DataFrame:
    """Phrases with at least ``threshold`` occurrences over the shards they were counted in.

    That is, their count, and that without what is new in ``visit`` (``before``). Two visits of a
    shard give a phrase the same count; it is taken once. A sum that reaches the threshold has a
    shard with its share of it, so other phrases, nearly all, are left out before the sums, by
    ``key`` alone: what that lets through by chance is dropped after. The join uses the buckets of
    ``log`` and keeps a bucket's few keys in memory.
    """
    def over(some: Column) -> Column:
        counts = [F.coalesce(F.max(F.when((F.col("shard") == k) & some, F.col("n"))), F.lit(0)) for k in range(shards)]
        return reduce(Column.__add__, counts)

    able = log.where(F.col("n") >= -(-threshold // shards)).select("key").hint("shuffle_hash")
    sums = log.join(able, "key", "left_semi").groupBy(*KEY)
    found = sums.agg(over(F.lit(True)).alias("n"), over(F.col("visit") < visit).alias("before"), F.min("doc").alias("doc"))
    return found.where(F.col("n") >= threshold)


def bitmap(keys: DataFrame) -> np.ndarray | None:
    """BITMAP_BITS bits with that of each ``key`` set, by its first bits; None where there is none."""
    placed = keys.select((F.shiftrightunsigned("key", 64 - (BITMAP_BITS - 1).bit_length()) + 1).alias("place"))
    blocks = placed.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    rows = blocks.collect()  # BITMAP_BITS in all
    out = np.zeros((BITMAP_BITS >> 15, 1 << 12), np.uint8)
    for r in rows:
        out[r["block"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(-1) if rows else None


def _union(maps: list[np.ndarray]) -> np.ndarray | None:
    return np.bitwise_or.reduce(maps) if maps else None


def counted_phrases(texts: DataFrame, longest: int, threshold: int, shards: int) -> DataFrame:
    """Phrases (k, key, check) of the stored ``texts`` with at least ``threshold`` occurrences: n, and doc, stored.

    Shards are visited in turn, again and again. A visit counts the phrases that are active: words
    in the first cycle; a longer phrase from the visit after both its parts (without the last and
    without the first word) reached the threshold, for one cycle. Each visit's counts go to a
    bucketed log, so that sums over visits need no shuffle; in its files phrases of a length lie
    together, and lengths that can't reach the threshold any more are not read. Tasks know the phrases that reached
    the threshold, ever and in the last cycle, by two bitmaps; what a bitmap lets through by
    chance is counted in more visits, which changes no sum (``totals``). Phrases of k words are
    active for the last time in the k-th cycle. ``doc`` is the class of a document with the phrase.
    """
    spark = texts.sparkSession
    folder, name = scratch_path(spark, "phrases"), f"phrases_{uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reached, cycle, visit = None, [], 0
    while visit < shards or any(m is not None for m in cycle):
        recent = [m for m in cycle if m is not None]
        maps = spark.sparkContext.broadcast([packed(reached), packed(_union(recent))]) if recent else None
        counted = scan(texts.where(F.col("shard") == visit % shards).drop("shard"), visit < shards, longest, maps)
        counted = counted.withColumns({"visit": F.lit(visit), "shard": F.lit(visit % shards)})
        counted.write.mode("append").bucketBy(buckets, "key").sortBy("k").option("path", folder).saveAsTable(name)
        if maps:
            maps.destroy()
        log = spark.table(name)
        new = totals(log.where((F.col("k") < longest) & (F.col("k") > visit // shards)), visit, shards, threshold)
        found = bitmap(new.where(F.col("before") < threshold))
        cycle = [*cycle, found][-shards:]
        reached = _union([m for m in (reached, found) if m is not None])
        visit += 1
    counted = write_through(totals(log, visit, shards, threshold).drop("before"), "frequent-phrases")
    spark.sql(f"drop table {name}")
    remove(spark, folder)
    return counted


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Phrases of ``docs`` (doc_id, text, lang) with at least ``threshold`` occurrences, and words by language, both stored.

    The first have the columns of DESCRIBED and n; the second lang and n. Documents are dealt into
    shards and counted (``counted_phrases``). A last scan spells the frequent phrases out: each in
    documents of one class only, so that about one row a phrase moves. Phrases are told apart by 96
    bits, words by 64.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    row = F.xxhash64("doc_id", "text")
    slim = docs.where("text is not null").select(
        "text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.pmod(F.shiftright(row, 20), F.lit(DOC_CLASSES)).cast("int").alias("doc"),
        F.pmod(row, F.lit(shards)).cast("int").alias("shard"),
    )
    slim.write.partitionBy("shard").parquet(path)
    texts = spark.read.schema("text string, lang string, doc int, shard int").parquet(path)
    counted = counted_phrases(texts, longest, threshold, shards)

    def places(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            keys = np.array(batch["key"], np.int64).view(np.uint64)
            yield {"key": _in_doc(keys, np.array(batch["doc"], np.int64)).view(np.int64)}

    wanted = bitmap(map_batches(counted.select("key", "doc"), places, "key long"))
    maps = None if wanted is None else spark.sparkContext.broadcast(packed(wanted))

    def spell(batches: Iterator[Columns]) -> Iterator[Columns]:
        known = unpacked(maps.value) if maps else None
        for text in grouped(batches):
            for lang, n in zip(text.langs, np.bincount(text.lang, minlength=len(text.langs)).tolist(), strict=True):
                yield {f.split()[0]: [{"k": 0, "key": n, "check": 0, "lang": lang}.get(f.split()[0])] for f in DESCRIBED.split(", ")}
            for k in range(1, longest + 1 if maps else 1):
                if k > 1:
                    text.grow()
                at = np.flatnonzero(text.whole[-1] & _has(known, _in_doc(text.keys[-1], text.doc[: len(text.keys[-1])])))
                if len(at):
                    yield text.described(k, at)

    spelled = write_through(map_batches(texts.drop("shard"), spell, DESCRIBED), "spelled-phrases")
    words = spelled.where("k = 0").groupBy("lang").agg(F.sum("key").alias("n"))
    names = [f.split()[0] for f in DESCRIBED.split(", ")]
    phrases = write_through(counted.join(spelled.where("k > 0").dropDuplicates(KEY), KEY).select(*names, "n"), "phrases")
    words = write_through(words, "words-by-language")
    remove(spark, path)
    return phrases, words


def best_cuts(phrases: DataFrame) -> DataFrame:
    """For each phrase of several words its lowest-scoring cut: key, lang, phrase, a, l, r and score."""
    known = phrases.where("k < 4").select(F.col("key").alias("part"), F.col("n").alias("part_n"))
    cut = lambda c: F.when(F.col("k") > c, F.struct(F.lit(c).alias("cut"), F.col(f"l{c}").alias("left"), F.col(f"r{c}").alias("right")))
    whole = ["key", "check", "lang", "phrase", "a"]
    cuts = phrases.where("k > 1").select("key", "check", "lang", "phrase", F.col("n").alias("a"), F.explode(F.array_compact(F.array(cut(1), cut(2), cut(3)))).alias("c"))
    left = cuts.select(*whole, "c.cut", "c.right", F.col("c.left").alias("part")).join(known, "part").withColumnRenamed("part_n", "l").drop("part")
    both = left.withColumnRenamed("right", "part").join(known, "part").withColumnRenamed("part_n", "r")
    score = F.expr(f"(cast(a as decimal(20, 0)) * {SCALE}) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    lowest = both.groupBy(*whole).agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    return lowest.select(*whole, "best.l", "best.r", "best.score")


def longer_counts(phrases: DataFrame) -> DataFrame:
    """For each phrase (``key``) inside longer frequent ones the largest count of these (``most``)."""
    three, four = F.array("l2", "r1"), F.array("l2", "r2", "mid", "l3", "r1")
    inner = phrases.where("k > 2").select("n", F.explode(F.when(F.col("k") == 3, three).otherwise(four)).alias("key"))
    return inner.groupBy("key").agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, best: int = BEST, covered: int = COVERED_PERCENT, shards: int = SHARDS
) -> DataFrame:
    """The ``best`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has doc_id, text and lang; a null lang is "und". Phrases of two to four words with at
    least ``threshold`` occurrences, but for those inside a longer one that has ``covered`` percent
    of their occurrences. Null and empty texts have no words; repeated rows count each time.
    """
    phrases, words = frequent_phrases(docs, threshold=threshold, shards=shards)
    scored = best_cuts(phrases).join(longer_counts(phrases), "key", "left")
    scored = scored.where(F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of the documents (see ``collocations``)."""
    return collocations(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


OP11_SQL = """
with pieces as (
  select doc_id, coalesce(lang, 'und') as lang, piece_at,
    list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') as w
  from (select doc_id, lang, unnest(pieces) as piece, generate_subscripts(pieces, 1) as piece_at
        from (select doc_id, lang, string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') as pieces
              from documents where text is not null))),
places as (select lang, w, unnest(range(1, len(w) + 1)) as p from pieces),
total as (select lang, count(*) as n from places group by lang),
counts as (
  select lang, k, array_to_string(w[p : p + k - 1], ' ') as phrase, count(*) as f
  from places, (select unnest([1, 2, 3, 4]) as k) where p + k - 1 <= len(w) group by all),
frequent as (select lang, k, phrase, string_split(phrase, ' ') as w, f from counts where f >= 30),
cuts as (
  select c.lang, c.k, c.phrase, c.f as a, c.w, cut,
    array_to_string(c.w[1 : cut], ' ') as lp, array_to_string(c.w[cut + 1 : c.k], ' ') as rp
  from frequent c, (select unnest([1, 2, 3]) as cut) where cut < c.k),
scored as (
  select u.lang, u.k, u.phrase, u.a, x.f as l, y.f as r, cut, (2000000 * u.a::hugeint) // (x.f + y.f)::hugeint as score
  from cuts u join frequent x on x.lang = u.lang and x.phrase = u.lp join frequent y on y.lang = u.lang and y.phrase = u.rp),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_parts as (
  select lang, f, array_to_string(w[s : s + m - 1], ' ') as phrase
  from frequent, (select unnest([1, 2, 3]) as s), (select unnest([2, 3]) as m) where m < k and s + m - 1 <= k),
longer as (select lang, phrase, max(f) as most from inner_parts group by all),
kept as (
  select b.* from best b left join longer o on o.lang = b.lang and o.phrase = b.phrase
  where o.most is null or 100 * o.most::hugeint < 80 * b.a::hugeint),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select ranked.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
  cast(total.n as bigint) as n, cast(score as bigint) as score
from ranked join total on total.lang = ranked.lang where rank <= 2000
"""
