"""op4, op5, op6: ids against the libraries on whole texts, files read back, packing rules."""

import base64
import hashlib
import io
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import odd
from vintara.llm import bitplane, bytebpe, packing, tokens

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TEXT = st.text(st.sampled_from("aB éß'.,\n\t 0漢$́sİ"), max_size=40)


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXT, max_size=5))
def test_word_encoder_is_the_library(name, texts):
    encode = plain(name)
    assert tokens.word_encoder(name).encode(texts) == [encode(t) for t in texts]


@pytest.mark.parametrize("name", NAMES)
def test_special_tokens_are_those_of_the_library(name):
    tokenizer, rng = Tokenizer.from_file(public_tokenizers.path(name)), np.random.default_rng(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|ENDOFTEXT|>", "a", "B", " ", "\n", "é", "\u0301", "'s", "0", "."]
    texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)]
    expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert tokens.word_encoder(name).encode(texts) == expected


def test_special_tokens_in_op4_and_op5(spark, tmp_path):
    docs = [(1, "x <|endoftext|> y"), (2, "<|endoftext|>"), (3, "no special"), (4, "<|startoftext|>a<|endoftext|><|endoftext|>")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name, query, end in ((NAMES[0], bitplane.op4_bitplane_ids, 2), (NAMES[1], packing.op5_packing, 1)):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes() for d, t in docs}
        assert {r["doc_id"]: r["ids_crc32"] for r in query(spark, str(tmp_path)).collect()} == {d: zlib.crc32(x) for d, x in ids.items()}


@pytest.mark.parametrize("name", NAMES)
def test_a_full_store_starts_anew(name):
    encoder = tokens.WordEncoder(public_tokenizers.path(name), words_kept=3, pieces_kept=2)
    encode, texts = plain(name), ["one two three. four", None, "", "five two\nSix <|endoftext|> x"]
    for _ in range(2):
        assert encoder.encode(texts) == [encode(t) for t in texts]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits, tmp_path):
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 2**32, n, dtype=np.uint32) for n in (0, 1, 7, 64, 65, 1000)]
    writer = bitplane.PlaneWriter(pafs.LocalFileSystem().open_output_stream(f"{tmp_path}/x", compression=None), bits, block_ids=64)
    for part in parts:
        writer.add(part)
    writer.close()
    reader, whole = bitplane.PlaneReader(pafs.LocalFileSystem(), f"{tmp_path}/x"), np.concatenate(parts)
    for first, n in ((0, len(whole)), (63, 2), (64, 64), (5, 0), (len(whole) - 1, 1)):
        assert (reader.ids(first, n) == whole[first : first + n]).all()


def test_bytes_that_are_no_id_file(tmp_path):
    (tmp_path / "x").write_bytes(b"y" * 100)
    with pytest.raises(ValueError, match="no id file"):
        bitplane.PlaneReader(pafs.LocalFileSystem(), f"{tmp_path}/x")


def test_op4(spark, mixed_dir):
    rows = bitplane.op4_bitplane_ids(spark, mixed_dir).collect()
    docs = spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()
    encode, end = plain(NAMES[0]), np.uint32(2).tobytes()
    ids = [(d["doc_id"], encode(d["text"]) + end) for d in docs]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == Counter((d, len(x) // 4, zlib.crc32(x)) for d, x in ids)
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    in_order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert in_order == sorted(in_order, key=lambda d: (d is not None, d))


def test_op5(spark, mixed_dir):
    rows = packing.op5_packing(spark, mixed_dir).collect()
    docs = spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()
    encode, end = plain(NAMES[1]), np.uint32(1).tobytes()
    expected = Counter()
    for d in docs:
        ids = encode(d["text"]) + end
        for start in range(0, len(ids) // 4, 2048):
            piece = ids[4 * start : 4 * (start + 2048)]
            expected[(d["doc_id"], start, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    filled = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
        filled += at
    assert filled / (2048 * len(sequences)) > 0.97


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_patterns_place_each_piece_once(counts):
    patterns = packing.pack_histogram(counts, room=64)
    placed = Counter()
    for lengths, n in patterns:
        assert sum(lengths) <= 64
        for length in lengths:
            placed[length] += n
    assert placed == Counter(counts)


def test_a_frequent_length_is_ranked_in_parts(spark):
    rows = [(i, 0, 700, i, 700) for i in range(900)] + [(i, 0, 600, i, 600) for i in range(900, 1000)]
    placed = packing.pack(spark.createDataFrame(rows, packing.PIECES), rank_parts=5).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in placed}) == 1000
    fill = Counter()
    for r in placed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048


def tiktoken_digests(docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for doc_id, text in docs:
        ids = encoding.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        expected[(doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    return expected


def test_op6(spark, mixed_dir):
    rows = bytebpe.op6_byte_bpe(spark, mixed_dir).collect()
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in rows) == tiktoken_digests(docs)


def test_short_chunks_are_stitched(spark, tmp_path):
    texts = [f"it's  a\n\n test {i} of   seams, isn't it? " * (3 + i) + "\n" * i for i in range(12)] + ["é" * 500, " " * 300, "a b " * 80]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(odd(spark).select("doc_id", "text"))
    parts = bytebpe.encode(docs, "byte_bpe_multi_50k.tiktoken", str(tmp_path / "long"), chunk=32, overlap=12).collect()
    assert max(len(r["parts"]) for r in parts) > 3
    found = Counter((r["doc_id"], hashlib.sha256(b"".join(r["parts"])).hexdigest()) for r in parts)
    expected = Counter()
    for (doc_id, _, digest, _), n in tiktoken_digests([(d["doc_id"], d["text"]) for d in docs.collect()]).items():
        expected[(doc_id, digest)] += n
    assert found == expected


def test_tables_without_rows(spark, empty_dir):
    for query in (bitplane.op4_bitplane_ids, packing.op5_packing, bytebpe.op6_byte_bpe):
        assert query(spark, empty_dir).collect() == []


def test_writer_needs_no_ids():
    stream = io.BytesIO()
    stream.close = lambda: None
    bitplane.PlaneWriter(stream).close()
    assert stream.getvalue().endswith(bitplane.MAGIC)


def test_id_files_are_read_back_once(spark, sf_dir):
    """The rows read back are stored: they give both the result and the ids of each file."""
    back = bitplane.op4_bitplane_ids(spark, sf_dir)
    assert "MapInArrow" not in back._jdf.queryExecution().executedPlan().toString()
    assert back.agg({"start": "min"}).first()[0] == 0
