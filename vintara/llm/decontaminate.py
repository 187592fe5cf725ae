"""Benchmark decontamination: one Aho-Corasick automaton over benchmark windows, each text scanned once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from math import isqrt

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read, write_through

WINDOW = 10
# Benchmark text of one automaton. A larger benchmark takes several, one after the other.
BLOCK_BYTES = 4_000_000

# Words are runs of 0-9, a-z and bytes of non-ASCII characters; A-Z count as a-z. Each byte stays
# one byte, so that places in the normalised text are places in the original.
WORD_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
NORMAL = bytes(ord(chr(b).lower()) if b in WORD_BYTES and b < 0x80 else b if b in WORD_BYTES else 0x20 for b in range(256))

FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
# A word the benchmark does not have; it ends every match.
GAP = "\0\0"

Ranges = list[tuple[int, int]]


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Automaton:
    """Finds the windows of benchmark items (item_id, text) in sequences of words.

    Each word of the benchmark is a code of two letters, each from an alphabet of its own, so that
    a node has few children and a match starts at a word. Words the benchmark does not have cut a
    text into runs; only runs as long as the shortest window are scanned.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            words = [numbers.setdefault(w, len(numbers)) for w in normal_words(text)]
            for k in range(max(1, len(words) - window + 1) if words else 0):
                own = owners.setdefault(tuple(words[k : k + window]), set())
                if item_id is not None:
                    own.add(item_id)
        base = isqrt(len(numbers)) + 1
        letters = [chr(0x100 + k // base) + chr(0x20000 + k % base) for k in range(len(numbers))]
        self._codes = {w: letters[k] for w, k in numbers.items()}
        self._found = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for words, own in owners.items():
            self._found.add_word("".join(letters[k] for k in words), (len(words), tuple(own)))
        self._found.make_automaton()
        shortest = min(map(len, owners), default=window)
        self._runs = re.compile(f"[^\0]{{{2 * shortest},}}").finditer if owners else lambda _: ()

    def ranges(self, words: list[bytes]) -> tuple[Ranges, set[str]]:
        """Word ranges of all windows in ``words``, end exclusive, and the items that have them."""
        coded = "".join(map(self._codes.get, words, repeat(GAP)))
        ranges, items = [], set()
        for run in self._runs(coded):
            for last, (n, own) in self._found.iter(coded, run.start(), run.end()):
                end = (last + 1) // 2
                ranges.append((end - n, end))
                items.update(own)
        return ranges, items


def merged(ranges: Ranges) -> Ranges:
    out: Ranges = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def original_spans(text: str, ranges: Ranges) -> list[tuple[int, int]]:
    """Code points of ``text`` from the first to the last word of each range, end exclusive."""
    raw = np.frombuffer(text.encode(), np.uint8)
    word = np.frombuffer(NORMAL, np.uint8)[raw] != 0x20
    edge = np.flatnonzero(np.diff(np.r_[False, word, False]))
    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return [(int(points[edge[2 * a]]), int(points[edge[2 * b - 1]])) for a, b in ranges]


def scanned(docs: DataFrame, items: list[tuple[str | None, str | None]], window: int, first: bool, last: bool) -> DataFrame:
    """``docs`` with the word ranges and items of one automaton added to those of the ones before.

    The last one gives the columns of FOUND in their place.
    """
    kept = docs.drop("_ranges", "_items")
    own = [f for f in kept.schema if f.name not in ("n_words", "n_hit", "items", "spans")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    schema = f"{fields}, {FOUND if last else '_ranges array<struct<a:long,b:long>>, _items array<string>'}"
    names = [f.name for f in own]

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        automaton = Automaton(items, window)
        for batch in batches:
            size = len(batch["text"])
            before = zip(batch["_ranges"], batch["_items"], strict=True) if not first else repeat(([], []), size)
            out: Columns = {n: batch[n] for n in names}
            out |= {n: [] for n in (("n_words", "n_hit", "items", "spans") if last else ("_ranges", "_items"))}
            for text, (ranges, hit) in zip(batch["text"], before, strict=True):
                words = normal_words(text)
                more, more_items = automaton.ranges(words)
                ranges = merged([*((r["a"], r["b"]) for r in ranges), *more])
                hit = sorted({*hit, *more_items})
                if last:
                    values = len(words), sum(b - a for a, b in ranges), hit, original_spans(text, ranges) if ranges else []
                    for name, value in zip(("n_words", "n_hit", "items", "spans"), values, strict=True):
                        out[name].append([{"start": a, "end": b} for a, b in value] if name == "spans" else value)
                else:
                    out["_ranges"].append([{"a": a, "b": b} for a, b in ranges])
                    out["_items"].append(hit)
            yield out

    return map_batches(docs, run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (with text) and n_words, n_hit, items (ascending strings) and spans, a row for each row.

    Columns of docs with such a name are replaced. Spans are code points of the original text, one
    for each unbroken run of hit words. ``benchmark`` has item_id and text; an item of fewer words
    than ``window`` is one window, one without a word has none. Windows of an item without an id
    are hit, but no item is named for them. Repeated items count once. A null text has no words.

    The driver takes ``block_bytes`` of benchmark text at a time and sends it to the tasks, which
    build the automaton. A benchmark within that is one automaton; of a larger one the blocks are
    met one after the other, and what a block found goes with the document to the next.
    """
    asked = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else asked
        items = [(r["item_id"], r["text"]) for r in block.collect()]
        docs = scanned(docs, items, window, k == 0, k == blocks - 1)
        if k < blocks - 1:
            docs = write_through(docs, "scanned-documents")
    return docs


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: benchmark windows of ten words it has (see ``contamination``)."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = contamination(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP12_SQL = """
with item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[p : p + 9], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from item_words where len(w) > 0)),
doc_words as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
  from documents),
places as (
  select doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p
        from doc_words, (select distinct n from windows))),
hits as (select doc_id, p, places.n, item_id from places join windows using (n, win)),
hit_words as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from hits) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct doc_id, cast(item_id as varchar) as item from hits where item_id is not null) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit_words h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
"""
