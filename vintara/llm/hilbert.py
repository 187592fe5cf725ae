"""Sharding along a Hilbert curve over quantised metadata."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read, write_through
from vintara.operators.ordered import running_totals

SHARDS = 16
# Bits of each quantised dimension: 64 cells.
BITS = 6
QUANTILE_ACCURACY = 10_000


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of cells (rows of d coordinates below 2**bits).

    Gray-code walk from the highest bit down: each bit of a coordinate flips or swaps the lower
    bits of the first one, then the Gray code over dimensions is undone and the bits interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for i in range(dims):
            up = (x[i] >> q) & 1 == 1
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for q in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> q) & 1 == 1, (1 << q) - 1, 0)
    x ^= flips
    index = np.zeros_like(x[0])
    for q in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> q) & 1)
    return index


def quantiles(df: DataFrame, dims: list[str], bits: int = BITS) -> list[list[float]]:
    """Cell boundaries of each numeric dimension from all rows, at most 2**bits - 1 each."""
    steps = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, steps, QUANTILE_ACCURACY).alias(c) for c in dims]).first() if dims else {}
    return [sorted(set(found[c] or [])) for c in dims]


def text_boundaries(df: DataFrame, dim: str, bits: int = BITS) -> list[bytes]:
    """Cell boundaries of a dimension of strings: whole values, cut by the running share of all rows.

    Rows are counted by value; the running totals are exact and in byte order of the values. At
    most 2**bits values come to the driver.
    """
    counts = df.where(F.col(dim).isNotNull()).groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, [], dim, ["n"])
    cell = lambda n: F.floor(n * F.lit(2**bits) / F.col("all_n"))
    ends = ranked.where(cell(F.col("cum_n")) > cell(F.col("cum_n") - F.col("n"))).select(dim)
    return sorted(r[dim].encode() for r in ends.collect())


def hilbert_order(docs: DataFrame, dims: dict[str, Column], bits: int = BITS) -> DataFrame:
    """Add ``curve``, the Hilbert index of the quantised ``dims`` (numbers or strings), to ``docs``.

    Nulls share the lowest cell of a dimension. Boundaries come from all rows, so each cell of a
    dimension holds about as many rows unless values repeat. A column ``curve`` of docs is replaced.
    """
    names = [f"dim_{k}" for k in dims]
    wide = docs.withColumns({f"dim_{k}": c for k, c in dims.items()})
    texts = {f.name for f in wide.schema if f.name in names and f.dataType.simpleString() == "string"}
    numbers = [n for n in names if n not in texts]
    wide = wide.withColumns({n: F.col(n).cast("double") for n in numbers})
    edges: dict[str, list] = dict(zip(numbers, quantiles(wide, numbers, bits), strict=True))
    edges |= {n: text_boundaries(wide, n, bits) for n in texts}
    kept = [f for f in docs.schema if f.name not in (*names, "curve")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", curve long"

    def index(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            cells = []
            for name in names:
                values, edge = batch.pop(name), edges[name]
                if name in texts:
                    cell = {v: bisect_left(edge, v.encode()) for v in set(values) if v is not None}
                    cells.append(np.array([cell.get(v, 0) for v in values], np.int64))
                else:
                    cells.append(np.searchsorted(edge, [-np.inf if v is None else v for v in values], "left"))
            yield {**{f.name: batch[f.name] for f in kept}, "curve": curve_index(np.stack(cells, axis=1), bits)}

    return map_batches(wide, index, schema)


def cut_runs(ordered: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add ``shard`` and ``slot`` to ``ordered`` (doc_id, curve, tie and more), counts at most one apart.

    Rows are dealt by range of (curve, doc_id, tie) and ranked inside each range; a range's first
    rank comes from the counts of the ranges before, a row for each. Equal keys may take either
    of neighbouring places.
    """
    dealt = ordered.repartitionByRange("curve", "doc_id", "tie").withColumn("range", F.spark_partition_id())
    stored = write_through(dealt, "curve-ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    starts = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_start"))
    within = Window.partitionBy("range").orderBy("curve", "doc_id", "tie")
    ranked = stored.withColumn("in_range", F.row_number().over(within) - 1).join(starts, "range")
    rank = F.col("range_start") + F.col("in_range")
    shard = F.expr(f"int((range_start + in_range) * {shards} div {max(total, 1)})")
    first = F.expr(f"(shard * bigint({total}) + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).withColumn("slot", rank - first).drop("range", "range_start", "in_range")


def document_dims() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "size": F.col("size"), "doc": F.col("doc_id")}


def shard_documents(docs: DataFrame, shards: int = SHARDS, *, carried: bool = False) -> DataFrame:
    """Documents (doc_id, text, source, lang) to shards under the law of equal row counts.

    A null text has size 1 and the checksum of the empty text. Repeated rows take places of their
    own; null doc_ids are placed like the smallest. With ``carried`` all columns of docs come
    along; those named as the result's (size, text_crc32, tie, curve, shard, slot) are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    own = {
        "size": (F.octet_length(text) + F.lit(1)).cast("long"), "text_crc32": F.crc32(F.encode(text, "UTF-8")),
        "tie": F.xxhash64("text"),
    }
    if carried:
        wide = docs.drop("curve", "shard", "slot", "range").withColumns(own)
    else:
        wide = docs.select("doc_id", "source", "lang", *[c.alias(n) for n, c in own.items()])
    return cut_runs(hilbert_order(wide, document_dims()), shards)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as Parquet, a folder for each shard, rows in curve order.

    Every row is written once, repeated ones and those without a doc_id too: rows keep their
    columns through the placing, nothing is joined. Files of a shard hold narrow ranges of every
    dimension, so that readers skip files by their column statistics.
    """
    placed = shard_documents(docs, shards, carried=True).drop("size", "text_crc32", "tie", "curve")
    dealt = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
