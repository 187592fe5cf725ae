"""op7 and op10: archives read back, shards along the curve; and the pipeline."""

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import odd, table, write_tables
from tests.llm.test_pairs import brute_components
from tests.llm.test_rules import base_spans
from vintara.llm import hilbert, warc

PAGES = [(10**6, "http://a/", "same"), (10**6 + 5, "http://b/", "same"), (10**6 + 2, None, "same"), (10**6 + 3, "u", None), (10**6 + 4, "u", ""), (10**6 + 6, "é\r\nx", "é𝒳" * 40_000), (None, "n", "same"), (10**6 + 5, "http://b/", "same"), (None, "n", "alone")]


def test_op7(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = write_tables(spark, tmp_path / "d", pages=given.unionByName(spark.createDataFrame(PAGES, given.schema)))
    rows = warc.op7_warc(spark, folder).collect()
    pages = [(i, (h or "").encode()) for i, h in table(sf_dir, "pages", "page_id, html")] + [(i, (h or "").encode()) for i, _, h in PAGES]
    ids = defaultdict(list)
    for page_id, payload in pages:
        ids[payload].append(page_id)
    expected = Counter()
    for page_id, payload in pages:
        top = max((i for i in ids[payload] if i is not None), default=None)
        revisit = page_id != top
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected[(page_id, len(payload), digest, "revisit" if revisit else "response", top if revisit else None)] += 1
    assert Counter(tuple(r) for r in rows) == expected


def test_archives_have_their_dictionary_in_front(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = warc.write_archives(pages.repartition(2), str(tmp_path)).collect()
    raw = (tmp_path / manifest[0]["file"]).read_bytes()
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_FRAME
    size = int.from_bytes(raw[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    assert dictionary.dict_id()
    row = next(r for r in manifest if r["file"] == manifest[0]["file"])
    one = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(raw[row["at"] : row["at"] + row["size"]])
    assert one.startswith(b"WARC/1.1\r\nWARC-Type: re")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(one[:-5] + b"x" + one[-4:])


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path / "w"), least=3)
    rows = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read_archives(manifest, str(tmp_path / "w")).collect()}
    assert rows == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_no_pages(spark, empty_dir):
    assert warc.op7_warc(spark, empty_dir).collect() == []


def test_op10(spark, mixed_dir):
    rows = hilbert.op10_hilbert_shards(spark, mixed_dir).collect()
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, len(t) + 1, zlib.crc32(t)) for d, t in docs)
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    counts = [len(v) for v in slots.values()]
    assert sorted(slots) == list(range(16)) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_few_rows_and_none(spark, empty_dir, tmp_path):
    assert hilbert.op10_hilbert_shards(spark, empty_dir).collect() == []
    folder = write_tables(spark, tmp_path / "d", odd(spark))
    rows = hilbert.op10_hilbert_shards(spark, folder).collect()
    assert len(rows) == odd(spark).count() and all(0 <= r["shard"] < 16 for r in rows)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims), axis=-1).reshape(-1, dims)
    index = hilbert.curve_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    walk = grid[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_narrow(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = hilbert.shard_documents(docs, shards=8).join(docs.select("doc_id", F.col("source").alias("s")), "doc_id")
    per_shard = placed.groupBy("shard").agg(F.countDistinct("s").alias("n")).agg(F.avg("n")).first()[0]
    assert per_shard < 0.8 * docs.select("source").distinct().count()


def test_written_shards(spark, sf_dir, tmp_path):
    """Every row once, repeated ones and those without a doc_id too, with its own columns."""
    extra = spark.createDataFrame([(None, None, None, None, None), (7, "x", "en", "s", 1), (7, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(odd(spark)).unionByName(extra).withColumn("shard", F.lit("own"))
    hilbert.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter(tuple(r) for r in back.select(*names).collect()) == Counter(tuple(r) for r in docs.select(*names).collect())
    counts = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 1


def test_sources_with_a_common_beginning_are_told_apart(spark, tmp_path):
    """Whole values are ranked: shards hold few of many long names, and readers skip files by them."""
    rows = [(k, "t", "en", f"https://a-long-common-beginning/{k % 32:02d}", 1) for k in range(2048)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    placed = hilbert.shard_documents(docs, shards=16).select("shard", "source").distinct()
    assert placed.groupBy("shard").count().agg(F.max("count")).first()[0] <= 16
    hilbert.write_shards(docs, str(tmp_path / "out"), 16)
    import pyarrow.parquet as pq

    spans = [pq.read_metadata(f).row_group(0).column(3).statistics for f in (tmp_path / "out").rglob("*.parquet")]
    asked = "https://a-long-common-beginning/03"
    assert sum(x.min <= asked <= x.max for x in spans) <= len(spans) / 2


def test_order_of_shards_is_that_of_the_curve(spark):
    """Cells by brute force: share of rows at or below a value; rows by curve place, then doc_id."""
    rng = np.random.default_rng(2)
    rows = [(k, "x" * int(rng.integers(1, 40)), ["de", "en", None][k % 3], f"s{int(rng.zipf(1.5)) % 9}", 1) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    def text_cells(values):
        known = sorted(v for v in values if v is not None)
        ends = [v for v in sorted(set(known)) if 64 * sum(x <= v for x in known) // len(known) > 64 * sum(x < v for x in known) // len(known)]
        return [0 if v is None else sum(e < v for e in ends) for v in values]

    def number_cells(values):
        known = sorted(values)
        edges = sorted({known[max(0, math.ceil(k * len(known) / 64) - 1)] for k in range(1, 64)})
        return [sum(e < v for e in edges) for v in values]

    dims = [text_cells([r[3] for r in rows]), text_cells([r[2] for r in rows]), number_cells([len(r[1]) + 1 for r in rows]), number_cells([r[0] for r in rows])]
    curve = hilbert.curve_index(np.array(dims).T, 6)
    order = sorted(range(400), key=lambda k: (curve[k], k))
    found = hilbert.shard_documents(docs, 16).orderBy("shard", "slot").collect()
    assert [r["doc_id"] for r in found] == order


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, mixed_dir):
    docs = spark.read.parquet(f"{mixed_dir}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, mixed_dir).cache()
        assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        seen.append(out.count())
        if name == "jaccard_join":
            texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
            assert Counter(r["doc_id"] for r in out.collect()) == Counter({c: 1 for _, _, c in brute_components(texts)})
        if name == "pii":
            assert not any(base_spans(r["text"]) for r in out.collect())
            assert out.where("n_chars != length(text)").count() == 0
        docs = out
    assert seen[0] > seen[1] > seen[2] > seen[3] == seen[4] > 0.5 * seen[0]
    pieces = corpus_pipeline.run(spark, mixed_dir).collect()
    last = {r["doc_id"] for r in docs.collect()}
    assert {p["doc_id"] for p in pieces} == last
    whole = Counter()
    for p in pieces:
        whole[p["doc_id"]] += p["length"]
    assert all(whole[p["doc_id"]] == p["doc_tokens"] for p in pieces)


def test_pipeline_without_documents(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_mixed_languages_and_corpora_without_labels_stay(spark):
    words = {"en": "the house and water", "de": "zwölf größe müßte häßlich", "fr": "où être français garçon", "es": "niño mañana señor cigüeña"}
    rows = [(i, f"{words[x]} " * 4, x, "s", 1) for i in range(80) for x in [list(words)[i % 4]]]
    rows += [(1000, " ".join(f"{w} " * 5 for w in words.values()), None, "s", 1), (1001, "123 !!", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert kept == {*range(80), 1000}
    bare = docs.withColumn("lang", docs["lang"].substr(9, 1)).selectExpr("doc_id", "text", "nullif(lang, '') lang", "source", "n_chars")
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, bare, "").collect()} == {*range(80), 1000}
