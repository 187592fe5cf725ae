"""Shortest-pack-first packing over the histogram of piece lengths."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read, write_through
from vintara.llm.tokens import word_encoder

SEQUENCE_TOKENS = 2048
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"
# Parts in which the pieces of one length are ranked; a frequent length is split over so many tasks.
RANK_PARTS = 64

Pattern = tuple[list[int], int]


def pack_histogram(counts: dict[int, int], room: int = SEQUENCE_TOKENS) -> list[Pattern]:
    """Packing patterns (lengths in order of placing, number of sequences) for a length histogram.

    Lengths are placed longest first. The pieces of a length go into the open pattern with the
    least filled sequences as long as they fit, so many at once as that pattern has sequences;
    what finds no room opens new sequences. The work depends on the number of lengths and
    patterns, not on the number of pieces.
    """
    open_at: dict[int, list[Pattern]] = {}
    fills: list[int] = []
    done: list[Pattern] = []

    def put(lengths: list[int], fill: int, n: int) -> None:
        if fill == room:
            done.append((lengths, n))
        else:
            if not open_at.get(fill):
                open_at[fill] = []
                heapq.heappush(fills, fill)
            open_at[fill].append((lengths, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and fills and fills[0] + length <= room:
            fill = fills[0]
            lengths, n = open_at[fill].pop()
            if not open_at[fill]:
                heapq.heappop(fills)
            used = min(left, n)
            if n > used:
                put(lengths, fill, n - used)
            put([*lengths, length], fill + length, used)
            left -= used
        if left:
            put([length], length, left)
    done += [p for fill in sorted(open_at) for p in open_at[fill]]
    return done


def slots_of(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each place in a pattern: length, first rank it takes, first sequence id and offset."""
    rows, taken, sequence = [], {}, 0
    for lengths, n in patterns:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, offset))
            taken[length], offset = rank + n, offset + length
        sequence += n
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 48) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, room: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces of at most ``room`` ids of each document: full ones, and one with the remainder."""

    def cut(batches: Iterator[Columns]) -> Iterator[Columns]:
        encoder, end = word_encoder(vocabulary), np.uint32(end_id).tobytes()
        for batch in batches:
            out: Columns = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"]), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, room):
                    piece = ids[4 * start : 4 * (start + room)]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(total)
            yield out

    return map_batches(docs.select("doc_id", "text"), cut, PIECES)


def pack(pieces: DataFrame, room: int = SEQUENCE_TOKENS, rank_parts: int = RANK_PARTS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored ``pieces`` (PIECES).

    The driver gets the histogram only (a row for each length, ``room`` at most). Pieces of a
    length are numbered in ``rank_parts`` parts, so that a length of a third of all pieces is
    ranked by many tasks, and each finds its place by binary search in the table of slots.
    Repeated rows are pieces of their own; which of equal pieces gets which place is open.
    """
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(rank_parts)).cast("int")
    pieces = pieces.withColumn("part", part)
    sizes = write_through(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    slots = slots_of(pack_histogram({r["length"]: r["n"] for r in histogram}, room))

    by_part = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("in_part", F.row_number().over(within) - 1).join(before, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("in_part"))

    def place(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            rank = np.array(batch.pop("rank"), dtype=np.int64)
            at = np.searchsorted(slots["key"], (np.array(batch["length"], dtype=np.int64) << 48) + rank, "right") - 1
            sequence = slots["sequence"][at] + rank - slots["rank"][at]
            yield {**batch, "sequence_id": sequence, "offset": slots["offset"][at]}

    names = [f.split()[0] for f in PIECES.split(", ")]
    return map_batches(ranked.select(*names, "rank"), place, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, room: int = SEQUENCE_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text), cut and pack them; a row for each piece.

    A null or empty text is a piece with the end id only.
    """
    return pack(write_through(token_pieces(docs, vocabulary, end_id, room), "pieces"), room)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    packed = pack_documents(docs, "word_bpe_49k.json", end_id=1)
    return packed.withColumn("length", F.col("length").cast("long"))
