"""Byte-level BPE over overlapping chunks, stitched where pre-token boundaries meet again."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read, scratch_path

# Code points of a chunk, and of its overlap with the next one. Shorter texts are one chunk.
CHUNK = 32_768
OVERLAP = 512
# A boundary is a place to stitch if a letter or digit stands before it and white space after it.
SEAM = regex.compile(r"[\p{L}\p{N}]\s").match


@cache
def encoding(name: str):
    """The tiktoken encoding of a rank file, one for each Python worker; no special tokens."""
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def pattern():
    return regex.compile(public_tokenizers.PATTERN)


def boundaries(part: str, first: bool, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Seams of a chunk: in its head (the overlap with the chunk before), and in its own overlap.

    Both are counted from the start of the overlap. A chunk starts at any character, so its first
    boundaries may be wrong until they meet those of the chunk before; its last two pre-tokens may
    be cut short and don't count.
    """
    ends = [m.end() for m in pattern().finditer(part)]
    if not last:
        ends = ends[:-2]
    head = [] if first else [e for e in ends if e <= overlap and SEAM(part, e - 1)]
    tail = [] if last else [e - chunk for e in ends if e >= chunk and SEAM(part, e - 1)]
    return head, tail


def cuts(texts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """For each ``row`` of ``texts`` (row, text) the ascending places where it may be cut.

    The chunks are dealt over the tasks and pre-tokenised there; only the boundaries inside the
    overlaps meet again, pair by pair. Two chunks without a common boundary are not cut apart.
    """
    n = F.length("text")
    numbers = F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int"))
    part = F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap))
    chunks = texts.select("row", "text", F.explode(numbers).alias("chunk")).select(
        "row", "chunk", ((F.col("chunk") + 1) * chunk >= n).alias("last"), part.alias("part")
    )

    def bound(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            found = [
                boundaries(p, k == 0, last, chunk, overlap)
                for p, k, last in zip(batch["part"], batch["chunk"], batch["last"], strict=True)
            ]
            yield {"row": batch["row"], "chunk": batch["chunk"], "head": [h for h, _ in found], "tail": [t for _, t in found]}

    bounded = map_batches(chunks.repartition("row", "chunk"), bound, "row long, chunk int, head array<int>, tail array<int>")
    in_text = Window.partitionBy("row").orderBy("chunk")
    meeting = F.array_min(F.array_intersect("head", F.lag("tail").over(in_text)))
    seams = bounded.select("row", (F.col("chunk") * chunk + meeting).alias("cut"))
    return seams.groupBy("row").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))


def encode(docs: DataFrame, ranks: str, folder: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Ids of ``docs`` (doc_id, text) as ``parts``: one binary for each piece of the text, in order.

    Texts of up to a chunk are encoded where they are read. Longer ones are stored in ``folder``
    with a number for each row, cut at the seams of their chunks, dealt piece by piece, and put
    together again: what one task holds at a time is a piece or the ids of one text. A null text
    is empty and has no ids; repeated rows stay apart.
    """

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        to_ids = encoding(ranks).encode_ordinary
        for batch in batches:
            yield {**batch, "piece": [array("I", to_ids(p)).tobytes() for p in batch["piece"]]}

    text = F.coalesce("text", F.lit(""))
    short = docs.where(F.length(text) <= chunk).select("doc_id", text.alias("piece"))
    in_one = map_batches(short, run, "doc_id long, piece binary").select("doc_id", F.array("piece").alias("parts"))

    long = docs.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    long.select("row", "doc_id", "text").write.parquet(folder)
    stored = docs.sparkSession.read.schema("row long, doc_id long, text string").parquet(folder)
    ends = F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")), F.array(F.length("text")))
    cut = stored.join(cuts(stored, chunk, overlap), "row", "left").withColumn("ends", ends)
    numbered = cut.select("row", "doc_id", "text", "ends", F.explode(F.sequence(F.lit(1), F.size("ends") - 1)).alias("k"))
    start, stop = F.element_at("ends", F.col("k")), F.element_at("ends", F.col("k") + 1)
    pieces = numbered.select("row", "doc_id", "k", F.substring("text", start + 1, stop - start).alias("piece"))
    ids = map_batches(pieces.repartition("row", "k"), run, "row long, doc_id long, k int, piece binary")
    joined = ids.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("k", "piece"))).alias("parts"))
    return in_one.unionByName(joined.select("doc_id", F.col("parts.piece").alias("parts")))


def decode(ids: bytes, ranks: str) -> bytes:
    """The bytes of ids, one token after the other."""
    return encoding(ranks).decode_bytes(memoryview(ids).cast("I").tolist())


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = "byte_bpe_multi_50k.tiktoken"
    docs = read(spark, sf_dir, "documents", "doc_id", "text")

    def digest(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            whole = [b"".join(p) for p in batch["parts"]]
            yield {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(w) // 4 for w in whole],
                "ids_sha256": [hashlib.sha256(w).hexdigest() for w in whole],
                "decoded_sha256": [hashlib.sha256(decode(w, ranks)).hexdigest() for w in whole],
            }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(encode(docs, ranks, scratch_path(spark, "long-texts")), digest, schema)
