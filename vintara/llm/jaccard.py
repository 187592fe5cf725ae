"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, one check a pair."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, discard, map_batches, read, write_through
from vintara.llm.components import components

WORDS = 5
PERCENT = 75
# Counters of the shingle counts, and in how many blocks they are summed. A counter holds all
# shingles of one hash class, so that the table has this size for any corpus.
COUNTERS = 1 << 21
BLOCKS = 128
# Half powers of two tell counts apart; the rest of a token is its hash.
LEVEL_BITS = 6
HASH_BITS = 64 - LEVEL_BITS
# Bytes of text that are hashed at once, and the length from which words are hashed one by one.
GROUP_BYTES = 1_000_000
LONG_WORD = 32
SUFFIX_DEPTH = 3
# A shingle of at most this many nodes gives all its pairs at once; only others take turns.
FEW_NODES = 8
# Turns in which a shingle's nodes meet a pivot go on while there are many more pairs left than
# rows, and a turn leaves at most this part of the pairs or finds so many links a row and a pair tried.
# A token draws so many pivots. A node meets so many in the first turn, twice as many in each later one.
PAIRS_A_ROW = 2
OPEN_PART = 0.9
LINKS_A_ROW = 0.001
LINKS_A_PAIR = 0.02
TOKEN_PIVOTS = 8
NODE_PIVOTS = 8
# Bits of the bitmap of wanted documents: for each of them, and at most (32 MB).
BITMAP_BITS_EACH = 16
MOST_BITMAP_BITS = 1 << 28

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a byte string that ends with a blank, and where each starts."""
    word = ~BLANK[octets]
    edge = np.flatnonzero(np.diff(np.r_[False, word]))
    starts, ends = edge[::2], edge[1::2]
    size = ends - starts
    by_size = np.argsort(-size, kind="stable")
    at = starts[by_size]
    live = np.searchsorted(-size[by_size], -np.arange(LONG_WORD), "left")
    h = np.full(len(at), 0xCBF29CE484222325, np.uint64)
    for k, n in enumerate(live):
        if not n:
            break
        h[:n] = (h[:n] ^ octets[at[:n] + k]) * np.uint64(0x100000001B3)
    out = np.empty_like(h)
    out[by_size] = h
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(octets[starts[k] : ends[k]].tobytes())
    return _mixed(out), starts


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """Distinct 64-bit shingle hashes of each text, ascending; A-Z count as a-z.

    A text of fewer words is one shingle; without a word the set is empty. Two shingles share a
    hash with a chance of 2**-64.
    """
    first = 0
    while first < len(texts):
        group, size = [], 0
        while first < len(texts) and (not group or size < GROUP_BYTES):
            group.append((texts[first] or "").encode().lower() + b"\n")
            size += len(group[-1])
            first += 1
        octets = np.frombuffer(b"".join(group), np.uint8)
        h, starts = word_hashes(octets)
        ends = np.searchsorted(starts, np.cumsum([len(g) for g in group]))
        rolled = [h]
        for k in range(1, words):
            rolled.append(_mixed(rolled[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k:] + np.uint64(k)) if len(rolled[-1]) else h[:0])
        begin = 0
        for end in ends:
            n = end - begin
            k = min(n, words)
            yield np.unique(rolled[k - 1][begin : end - k + 1]) if n else h[:0]
            begin = end


def count_levels(docs: DataFrame) -> np.ndarray:
    """How frequent each hash class is in all documents, in half powers of two (COUNTERS bytes).

    Each task counts its documents' shingles; the counts are summed block by block.
    """

    def count(batches: Iterator[Columns]) -> Iterator[Columns]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch["text"]))
            if sets:
                total += np.bincount((np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        pack = zstandard.ZstdCompressor(level=1).compress
        yield {"block": list(range(BLOCKS)), "counts": [pack(part.tobytes()) for part in np.split(total, BLOCKS)]}

    def add(batches: Iterator[Columns]) -> Iterator[Columns]:
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for block, counts in zip(batch["block"], batch["counts"], strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(unpack(counts), np.int64)
        levels = {k: np.minimum(2 * np.log2(np.maximum(v, 1)), 2**LEVEL_BITS - 1).astype(np.uint8) for k, v in sums.items()}
        yield {"block": list(levels), "levels": [v.tobytes() for v in levels.values()]}

    parts = map_batches(docs.select("text"), count, "block int, counts binary").repartition("block")
    rows = sorted(map_batches(parts, add, "block int, levels binary").collect(), key=lambda r: r["block"])
    return np.frombuffer(b"".join(bytes(r["levels"]) for r in rows), np.uint8) if rows else np.zeros(COUNTERS, np.uint8)


def ordered_tokens(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Shingles as tokens whose order is rare first: level of the count, then hash."""
    level = levels[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(HASH_BITS)) | (hashes & np.uint64((1 << HASH_BITS) - 1)))


def least_overlap(n: int, percent: int = PERCENT) -> int:
    return -(-percent * n // 100)


def set_identity(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set; the second tells apart sets that share the first."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def with_nodes(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """For each row its set's size and identity (``node``, ``check``)."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"doc_id": batch["doc_id"], "tie": batch["tie"], "n": [], "node": [], "check": []}
            for hashes in shingle_sets(batch["text"]):
                node, check = set_identity(ordered_tokens(hashes, levels)) if len(hashes) else (None, None)
                for name, value in (("n", len(hashes)), ("node", node), ("check", check)):
                    out[name].append(value)
            yield out

    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("tie")), run, "doc_id long, tie long, n long, node long, check long")


def prefix_tokens(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """Rows token, node, place of each set's prefix in rare-first order; place is n * 2^32 + pos.

    Sets that reach the threshold share a token of their prefixes. Within a task only the first of
    equal sets gives its prefix, so that copies don't add to it. The rows come from the texts and are not
    stored; they name their set, so that nothing has to be joined to them.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        seen: set[int] = set()
        for batch in batches:
            tokens, nodes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for hashes in shingle_sets(batch["text"]):
                n = len(hashes)
                whole = ordered_tokens(hashes, levels)
                node = set_identity(whole)[0]
                if n and node not in seen:
                    seen.add(node)
                    tokens.append(whole[: n - least_overlap(n, percent) + 1])
                    nodes.append(np.full(len(tokens[-1]), node, np.int64))
                    places.append((n << 32) + np.arange(len(tokens[-1])))
            yield {"token": np.concatenate(tokens).view(np.int64), "node": np.concatenate(nodes), "place": np.concatenate(places)}

    return map_batches(docs.select("text"), run, "token long, node long, place long")


def suffix_distance(x: np.ndarray, y: np.ndarray, most: int, depth: int = SUFFIX_DEPTH) -> int:
    """A lower bound of the number of tokens that only one of two ordered sets has.

    Both are parted at the middle token of y; what differs in the sizes of parts can't be shared.
    """
    differ = abs(len(x) - len(y))
    if differ > most or not depth or not len(x) or not len(y):
        return differ
    pivot = y[len(y) // 2]
    i, j = np.searchsorted(x, pivot), len(y) // 2
    left = suffix_distance(x[:i], y[:j], most, depth - 1)
    if left + abs(len(x) - i - len(y) + j) > most:
        return left + abs(len(x) - i - len(y) + j)
    return left + suffix_distance(x[i:], y[j:], most - left, depth - 1)


def reaches(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two ordered token sets reach the threshold: the filters, then the exact overlap."""
    n = len(x) + len(y)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    need = -(-percent * n // (100 + percent))
    head = np.intersect1d(x[: len(x) - need + 1], y[: len(y) - need + 1], assume_unique=True)
    if not len(head):
        return False
    i, j = np.searchsorted(x, head[0]), np.searchsorted(y, head[0])
    if 1 + min(len(x) - i, len(y) - j) - 1 < need:
        return False
    rest_x, rest_y = x[i + 1 :], y[j + 1 :]
    most = n - 2 * need - i - j
    if suffix_distance(rest_x, rest_y, most) > most:
        return False
    overlap = 1 + len(np.intersect1d(rest_x, rest_y, assume_unique=True))
    return 100 * overlap >= percent * (n - overlap)


def sketch(tokens: np.ndarray) -> bytes:
    """The size of a set and a bit for each of 4 to 8 times as many classes: whether it has an odd number of tokens there."""
    bits = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return len(tokens).to_bytes(8, "little") + np.packbits(odd.astype(bool), bitorder="little").tobytes()


def may_reach(x: bytes, y: bytes, percent: int = PERCENT) -> bool:
    """Whether two sets can reach the threshold by their sketches.

    A class that is odd in one of them alone has a token that only one of them has, so sets of
    fewer tokens in common than the threshold asks for show in most cases, and no others do.
    """
    both = int.from_bytes(x[:8], "little") + int.from_bytes(y[:8], "little")
    u, v = np.frombuffer(x, np.uint8, offset=8), np.frombuffer(y, np.uint8, offset=8)
    while len(u) != len(v):
        u, v = (u, v) if len(u) > len(v) else (v, u)
        u = u[: len(u) // 2] ^ u[len(u) // 2 :]
    return int(np.bitwise_count(u ^ v).sum()) <= both - 2 * -(-percent * both // (100 + percent))


def sets_reach(x: bytes, y: bytes, percent: int = PERCENT) -> bool:
    return reaches(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT, test: Callable[[bytes, bytes, int], bool] = sets_reach) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose ``sets`` (node, tokens; repeated ones are one) pass the test."""

    def check(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            hits = [k for k, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)) if test(x, y, percent)]
            yield {"a": [batch["a"][k] for k in hits], "b": [batch["b"][k] for k in hits]}

    # Repeated rows give a set once for each task that has them; both joins read one shuffle of the sets.
    sets = sets.dropDuplicates(["node"])
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return map_batches(pairs.join(x, "a").join(y, "b"), check, "a long, b long")


def token_sets(docs: DataFrame, wanted: DataFrame, levels: np.ndarray, form: Callable[[np.ndarray], bytes] = np.ndarray.tobytes) -> DataFrame:
    """Whole ordered sets (binary, or another ``form``) of at least the nodes in ``wanted`` (node, doc, tie), by node.

    ``wanted`` names a document of each node. A bitmap of the hashes of these documents goes to
    the tasks, which form the sets of documents that it has as they read them, so that texts are
    not shuffled. It has BITMAP_BITS_EACH bits a node, up to MOST_BITMAP_BITS; documents that it
    has by chance give sets that no pair asks for, or a set once more.
    """
    n = wanted.count()
    bits = min(MOST_BITMAP_BITS, max(1 << 15, 1 << (BITMAP_BITS_EACH * n).bit_length()))

    def place(doc: str, tie: str) -> Column:
        return F.pmod(F.xxhash64(doc, tie), F.lit(bits)) + 1

    asked = wanted.select(place("doc", "tie").alias("place"))
    blocks = asked.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bitmap = np.zeros((bits >> 15, 1 << 12), np.uint8)
    for r in blocks.collect():  # at most MOST_BITMAP_BITS in all
        bitmap[r["block"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    bitmap = bitmap.reshape(-1)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        seen: set[int] = set()
        for batch in batches:
            at = np.array(batch["place"], dtype=np.int64) - 1
            hit = np.flatnonzero((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            sets = [ordered_tokens(h, levels) for h in shingle_sets([batch["text"][k] for k in hit])]
            named = {set_identity(t)[0]: t for t in sets if len(t)}
            new = [node for node in named if node not in seen]
            seen.update(new)
            yield {"node": new, "tokens": [form(named[node]) for node in new]}

    doc = F.coalesce("doc_id", F.lit(-(2**63)))
    texts = docs.select("text", doc.alias("doc"), F.xxhash64("text").alias("tie")).select("text", place("doc", "tie").alias("place"))
    return map_batches(texts, run, "node long, tokens binary")


def fits(n: Column, pos: Column, other_n: Column, other_pos: Column, percent: int) -> Column:
    """Length filter, and positional filter of two sets whose first common token is at these places."""
    both = n + other_n
    need = F.ceil(both * percent / (100 + percent))
    return (F.least(n, other_n) * 100 >= F.greatest(n, other_n) * percent) & (F.least(n - pos, other_n - other_pos) >= need)


def pivot_pairs(shared: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a < b) of nodes with pivots of their tokens, of other labels; other pivots each turn.

    A token's pivots are its nodes of the smallest chance in TOKEN_PIVOTS draws of its own, so that
    tokens of the same nodes have different pivots. A node meets NODE_PIVOTS of those that pass the
    filters, any of them, so that there are about as many pairs as nodes however many nodes a token
    has; twice as many each turn, but never more than rows times draws. One shuffle by token, one by node.
    """
    token = Window.partitionBy("token")
    draws = [F.xxhash64("node", "token", F.lit(turn * TOKEN_PIVOTS + k)) for k in range(TOKEN_PIVOTS)]
    drawn = F.array(*(F.min(F.struct(chance.alias("chance"), "node", "n", "pos", "label")).over(token) for chance in draws))
    near = F.filter("drawn", lambda p: (F.col("label") != p["label"]) & fits(F.col("n"), F.col("pos"), p["n"], p["pos"], percent))
    met = shared.withColumn("drawn", drawn).select("node", F.explode(F.array_distinct(F.transform(near, lambda p: p["node"]))).alias("other"))
    tried = met.distinct()
    any_of = Window.partitionBy("node").orderBy(F.xxhash64("node", "other", F.lit(turn)), "other")
    first = tried.withColumn("at", F.row_number().over(any_of)).where(F.col("at") <= NODE_PIVOTS << turn)
    return first.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def open_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """All pairs (a < b) of a token's nodes with different labels that pass the filters."""
    a, b = shared.alias("a"), shared.alias("b")
    near = fits(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), percent)
    apart = (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label"))
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & apart & near)
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def still_open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of tokens whose nodes have several labels, with these labels."""
    named = shared.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return several_values(named, "label")


def several_values(rows: DataFrame, name: str) -> DataFrame:
    """The rows of tokens that have more than one value of ``name``; one shuffle by token."""
    token = Window.partitionBy("token")
    ends = rows.withColumns({"low": F.min(name).over(token), "high": F.max(name).over(token)})
    return ends.where("low != high").drop("low", "high")


def open_size(shared: DataFrame) -> tuple[int, int]:
    """Rows of ``shared``, and pairs of a token's nodes with different labels."""
    labels = shared.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("decimal(20,0)")
    tokens = labels.groupBy("token").agg(F.sum("n").alias("n"), F.sum(n * n).alias("alike"))
    found = tokens.agg(F.sum("n"), F.sum((n * n - F.col("alike")) / 2)).first()
    return int(found[0] or 0), int(found[1] or 0)


def with_few(shared: DataFrame, percent: int) -> DataFrame:
    """Distinct rows token, node, n, pos with ``size``, the token's nodes, and its pairs where these are few.

    ``others`` are the larger nodes of a token of at most FEW_NODES that pass the filters; its rows
    without any are left out. The windows use the shuffle by token that ``shared`` comes with.
    """
    token = Window.partitionBy("token")
    later = token.orderBy("node").rowsBetween(1, FEW_NODES - 1)
    size = F.count(F.lit(1)).over(token).cast("int")
    sized = shared.withColumns({"others": F.collect_list(F.struct("node", "n", "pos")).over(later), "size": size})
    near = F.filter("others", lambda o: fits(F.col("n"), F.col("pos"), o["n"], o["pos"], percent))
    others = F.when(F.col("size") <= FEW_NODES, F.transform(near, lambda o: o["node"]))
    return sized.withColumn("others", others).where(F.col("others").isNull() | (F.size("others") > 0))


def candidates(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored rows, classes of equal sets by node, and what several nodes' prefixes share.

    That is, all pairs (a < b) of nodes that pass the filters at a token of few nodes, and the
    tokens of more nodes.
    """
    rows = write_through(with_nodes(docs, levels), "rows")
    doc = F.coalesce("doc_id", F.lit(-(2**63)))
    classes = rows.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("low"), F.min(doc).alias("doc"), F.min_by("tie", doc).alias("tie"),
        F.min("check").alias("check"), F.max("check").alias("other"),
    )
    same = F.assert_true(F.col("check") == F.col("other"), F.lit("two sets share a node number"))
    classes = write_through(classes.withColumn("sure", same).where(F.col("sure").isNull()).drop("check", "other", "sure"), "classes")

    n, pos = F.shiftright("place", 32).cast("int").alias("n"), (F.col("place") % (1 << 32)).cast("int").alias("pos")
    several = several_values(prefix_tokens(docs, levels, percent), "node").distinct().select("token", "node", n, pos)
    found = write_through(with_few(several, percent), "shared-tokens")
    few = found.where("others is not null").select(F.col("node").alias("a"), F.explode("others").alias("b")).distinct()
    shared = found.where("others is null").select("token", "node", "n", "pos", F.col("node").alias("label"))
    return rows, classes, few, shared


def checked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) of nodes whose sets reach the threshold, stored.

    Sketches, which are far smaller than the sets, go first, so that only sets of the pairs that they leave move.
    """
    def sets(some: DataFrame, form: Callable[[np.ndarray], bytes]) -> DataFrame:
        asked = some.select(F.col("a").alias("node")).union(some.select("b")).distinct()
        return token_sets(docs, classes.join(asked, "node").select("node", "doc", "tie"), levels, form)

    likely = write_through(verified(pairs, sets(pairs, sketch), percent, may_reach), "likely-pairs")
    links = write_through(verified(likely, sets(likely, np.ndarray.tobytes), percent), "verified-links")
    discard(likely)
    return links


def jaccard_links(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links of ``docs`` (doc_id, text), and rows doc_id, n_shingles, component_id, n_links.

    Links (a, b) are pairs of nodes (distinct sets, a < b) that reach the threshold: every pair that
    shares a prefix token and passes the filters is verified once, inside components too, so their
    number grows with the square of a group of near copies. ``n_links`` counts the other rows that a
    row is linked with; equal sets are linked, and counted without forming their pairs.
    """
    levels = count_levels(docs)
    rows, classes, few, shared = candidates(docs, levels, percent)
    pairs = few.unionByName(open_pairs(shared, percent)).distinct()
    links = checked(write_through(pairs, "pairs"), docs, classes, levels, percent)
    copies = rows.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ways.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    labels = write_through(components(links), "labels")
    named = classes.select("node", "low").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    component = named.groupBy("label").agg(F.min("low").alias("component_id"))
    n_links = (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    of_node = named.join(component, "label").join(copies, "node").join(others, "node", "left").select("node", "component_id", n_links)
    size = F.col("n").alias("n_shingles")
    known = rows.where("n > 0").select("doc_id", size, "node").join(of_node, "node").drop("node")
    empty = rows.where("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return links, known.unionByName(empty)


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text) to rows doc_id, n_shingles, component_id, label and tie (text hash).

    Equal sets are one node. A shingle in the prefixes of several nodes links them as candidates
    where the length and positional filters let them. A shingle of few nodes gives all its pairs at
    first. Of other shingles each node at first meets one pivot of the shingle only, so that a
    shingle of very many nodes gives as many pairs as nodes, with another pivot each turn, as long as many more pairs than rows are left and a turn leaves OPEN_PART of
    them at most; then all pairs that are left, of nodes in different components. Pairs of earlier
    turns are left out: each is verified once.
    Sets without a shingle are linked with nothing. Null doc_ids take part; the smallest doc_id
    of a component leaves them out, and is null where there is no other. Repeated rows are copies.
    """
    levels = count_levels(docs)
    rows, classes, few, shared = candidates(docs, levels, percent)
    labels, tried, turn = None, [], 0
    n_open, n_pairs = open_size(shared)
    pivots = n_pairs > PAIRS_A_ROW * n_open
    while n_open or (labels is None and not few.isEmpty()):
        pairs = pivot_pairs(shared, turn, percent) if pivots else open_pairs(shared, percent)
        if labels is None:
            pairs = few.unionByName(pairs).distinct()
        if tried:
            pairs = pairs.join(reduce(DataFrame.unionByName, tried), ["a", "b"], "left_anti")
        pairs = write_through(pairs, "pairs")
        found = checked(pairs, docs, classes, levels, percent)
        # A component so far is a star about its label, so its links are as few as its nodes.
        stars = [] if labels is None else [labels.select(F.col("node").alias("a"), F.col("label").alias("b"))]
        old, labels = labels, write_through(components(reduce(DataFrame.unionByName, stars, found)), "labels")
        tried.append(pairs)
        before = shared
        if pivots:
            shared = write_through(still_open(shared, labels), "open-tokens")
            most = OPEN_PART * n_pairs
            n_open, n_pairs = open_size(shared)
            linked = found.count() >= max(LINKS_A_ROW * n_open, LINKS_A_PAIR * pairs.count())
            turn, pivots = turn + 1, PAIRS_A_ROW * n_open < n_pairs and (n_pairs <= most or linked)
        else:
            n_open = 0
        discard(before, found, *([old] if old is not None else []))
    discard(*tried)
    if labels is None:
        labels = shared.select("node", "label")

    lows = classes.select("node", "low").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    component = lows.groupBy("label").agg(F.min("low").alias("component_id"))
    of_node = lows.join(component, "label").select("node", "component_id", "label")
    size = F.col("n").alias("n_shingles")
    known = rows.where("n > 0").select("doc_id", size, "node", "tie").join(of_node, "node")
    empty = rows.where("n = 0").select("doc_id", size, "tie", F.col("doc_id").alias("component_id"), F.col("node").alias("label"))
    return known.drop("node").unionByName(empty).select("doc_id", "n_shingles", "component_id", "label", "tie")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component: the smallest doc_id, of its texts the smallest hash.

    Repeated rows are one. Rows without a shingle are alone, and all stay.
    """
    found = write_through(jaccard_components(docs.select("doc_id", "text"), percent), "component-rows")
    first = found.where("label is not null and doc_id <=> component_id")
    keys = first.groupBy("label").agg(F.min("tie").alias("kept_tie"), F.min("doc_id").alias("kept_id"))
    tagged = docs.withColumn("kept_tie", F.xxhash64("text"))
    of_key = F.expr("doc_id <=> kept_id") & (tagged["kept_tie"] == keys["kept_tie"])
    kept = tagged.join(keys.drop("label"), of_key, "left_semi").dropDuplicates(["doc_id", "kept_tie"])
    alone = tagged.where(~F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False)))
    return kept.unionByName(alone).drop("kept_tie")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op1_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of op1_jaccard_join with ``n_links``; all links are formed for it."""
    return jaccard_links(read(spark, sf_dir, "documents", "doc_id", "text"))[1]


# Every pair with a shared shingle is counted, and every document of a component is reached from every other.
_LINKS_SQL = r"""
with recursive words as (
    select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
    ), lambda x: x <> '') as w
    from documents
), placed as (
    select doc_id, len(w) as n_words, generate_subscripts(w, 1) as k, unnest(w) as word from words
), runs as (
    select doc_id, n_words, k, concat_ws(' ', word, lead(word, 1) over d, lead(word, 2) over d, lead(word, 3) over d, lead(word, 4) over d) as shingle
    from placed window d as (partition by doc_id order by k)
), shingles as (
    select distinct doc_id, shingle from runs where k <= n_words - 4 or (k = 1 and n_words < 5)
), sets as (
    select doc_id, count(shingle) as n from documents left join shingles using (doc_id) group by doc_id
), postings as (
    select doc_id, n, shingle from shingles join sets using (doc_id)
), links as (
    select a.doc_id as a, b.doc_id as b
    from postings a join postings b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached as (
    select doc_id, doc_id as other from sets
    union
    select reached.doc_id, links.b from reached join links on links.a = reached.other
), components as (
    select doc_id, min(other) as component_id from reached group by doc_id
)
"""
OP1_SQL = _LINKS_SQL + """
select doc_id, n as n_shingles, component_id from sets join components using (doc_id)
"""
OP1_LINKS_SQL = _LINKS_SQL + """
select doc_id, n as n_shingles, component_id,
    (select count(*) from links where links.a = sets.doc_id) as n_links
from sets join components using (doc_id)
"""
