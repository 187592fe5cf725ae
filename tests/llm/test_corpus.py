"""op11, op12 and op13 against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, empty, odd, write_tables
from vintara.llm import collocations, decontaminate, resampling, slices

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


# --- op12 -------------------------------------------------------------------------------------


def brute_hits(docs, items, window=10):
    wins = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[k : k + window])].add(item_id)
    sizes = {len(x) for x in wins}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        listed = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return Counter(out)


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "one two three"), (2, "one two three"), (10, "TWO three!"), (None, "é漢 ß"), (4, ""), (5, None), (6, " ... "),
    (7, "x " * 14), (8, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
]


def test_op12(spark, mixed_dir, tmp_path):
    given_docs = spark.read.parquet(f"{mixed_dir}/documents.parquet")
    extra = [
        (200_001, "start, BETA gamma; delta\nepsilon zeta eta theta iota kappa lambda mu. end", "en", "s", 1),
        (200_002, "one-two three two three x one", "en", "s", 1), (200_003, "a É漢 b é漢 ß c", "en", "s", 1),
        (200_004, "x " * 40, "en", "s", 1), (200_005, "pad " * 200_000 + ITEMS[0][1] + " pad" * 10, "en", "s", 1),
    ]
    docs = given_docs.select(*[f.split()[0] for f in SCHEMA.split(", ")]).unionByName(spark.createDataFrame(extra, SCHEMA))
    folder = write_tables(spark, tmp_path, docs.withColumns({"items": F.lit(1), "n_hit": F.lit("a"), "_items": F.lit(2)}))
    items = [*ITEMS, (3, docs.where("doc_id = 3").first()["text"][50:300])]
    spark.createDataFrame(items, "item_id long, text string").withColumn("spans", F.lit(0)).write.parquet(f"{folder}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute_hits(rows, items)
    assert Counter(tuple(r) for r in decontaminate.op12_benchmark_decontamination(spark, folder).collect()) == expected
    assert sum(n for row, n in expected.items() if row[5]) >= 6


def test_several_automata_find_what_one_finds(spark):
    docs = [(1, "q alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu z"), (2, "one two three"), (2, "one two three"), (3, None), (4, "É漢 é漢 ß")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit(-1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one, many = (
        sorted(map(repr, decontaminate.contamination(frame, items, block_bytes=n).collect())) for n in (decontaminate.BLOCK_BYTES, 40)
    )
    assert one == many and len(one) == 5


def test_spans_are_places_of_the_original_text(spark):
    text = "É: Alpha-BETA gamma, delta epsilon zeta eta theta iota KAPPA!! rest one  TWO\nthree."
    row = decontaminate.contamination(
        spark.createDataFrame([(text,)], "text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    ).first()
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == ["Alpha-BETA gamma, delta epsilon zeta eta theta iota KAPPA", "one  TWO\nthree"]


def test_no_benchmark_and_no_documents(spark, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.contamination(odd(spark), none).collect()
    assert len(found) == len(ODD) and not any(r["n_hit"] or r["items"] or r["spans"] for r in found)
    folder = write_tables(spark, tmp_path, empty(spark))
    none.write.parquet(f"{folder}/benchmark.parquet")
    assert decontaminate.op12_benchmark_decontamination(spark, folder).collect() == []
    assert resampling.op13_importance_resampling(spark, folder).collect() == []
    assert collocations.op11_phrase_collocations(spark, folder).collect() == []


# --- op13 -------------------------------------------------------------------------------------


def brute_features(text):
    w = words(text)
    return Counter(zlib.crc32(f.encode()) % 10_000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))])


def brute_resample(docs, target):
    raw, wanted = Counter(), Counter()
    sets = [brute_features(t) for _, t in docs]
    for s in sets:
        raw.update(s)
    for t in target:
        wanted.update(brute_features(t))
    s_all, t_all = raw.total(), wanted.total()
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((raw[b] + 1) * (t_all + 10_000)))) for b in range(10_000)}
    rows = []
    for (doc_id, text), s in zip(docs, sets, strict=True):
        n = s.total()
        weight = sum(gain[b] * c for b, c in s.items()) // n if n else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, n, weight, score, len(words(text)) >= 20))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    drawn = 25 * len(order) // 100
    out = Counter((*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(order))
    return out + Counter((*r[:4], None) for r in rows if not r[4])


def test_op13(spark, mixed_dir, tmp_path):
    long_rows = [(300_000 + k % 7, f"{'Wort ' * 30}{k}", "de", "s", 1) for k in range(14)] + [(300_010, "a b " * 250_000, "de", "s", 1), (None, "n u " * 20, "de", "s", 1)]
    docs = spark.read.parquet(f"{mixed_dir}/documents.parquet").select(*[f.split()[0] for f in SCHEMA.split(", ")])
    docs = docs.unionByName(spark.createDataFrame([*long_rows, long_rows[0]], SCHEMA))
    folder = write_tables(spark, tmp_path, docs.withColumns({"weight": F.lit("x"), "tie": F.lit(1), "rank": F.lit(0)}))
    target = [(1, "Wort und a b"), (2, None), (2, "Wort und a b"), (None, "the of and")]
    spark.createDataFrame(target, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = Counter(tuple(r) for r in resampling.op13_importance_resampling(spark, folder).collect())
    assert found == brute_resample(rows, [t for _, t in target])
    assert sum(n for r, n in found.items() if r[4]) > 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB \n.0é", max_size=40)), max_size=6))
def test_features_are_counted_by_bucket(texts):
    table, slots, text, n_words = resampling.features(texts, 10_000)
    for k, t in enumerate(texts):
        assert Counter(table.bucket[slots[text == k]].tolist()) == brute_features(t) and n_words[k] == len(words(t))


def test_equal_keys_share_a_slot_only_with_equal_bytes():
    raw = b"aa bb aa cc bb aa dd"
    starts, sizes = np.arange(0, 20, 3), np.full(7, 2)
    table = resampling.Ngrams(slices.padded(raw), 7)
    slots = table.intern(starts, sizes, keys=np.zeros(7, np.uint64))
    named = defaultdict(set)
    for s, slot in zip(starts, slots, strict=True):
        named[slot].add(raw[s : s + 2])
    assert sorted(map(sorted, named.values())) == [[b"aa"], [b"bb"], [b"cc"], [b"dd"]]
    assert sorted(table.count[table.size > 0].tolist()) == [1, 1, 2, 3]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=120), st.data())
def test_slices_hash_and_compare_like_bytes(raw, data):
    place = st.integers(0, len(raw))
    cuts = [sorted((data.draw(place), data.draw(place))) for _ in range(5)]
    starts, ends = (np.array(x, np.int64) for x in zip(*cuts))
    octets = slices.padded(raw)
    assert slices.xxh64(octets, starts, ends - starts).tolist() == [xxhash.xxh64_intdigest(raw[a:b]) for a, b in cuts]
    a, size = data.draw(place), data.draw(st.integers(0, 20))
    b = data.draw(place)
    size = min(size, len(raw) - max(a, b))
    assert slices.equal(octets, np.array([a]), np.array([b]), np.array([size])).tolist() == [raw[a : a + size] == raw[b : b + size]]


# --- op11 -------------------------------------------------------------------------------------


def brute_phrases(docs):
    counts, total = Counter(), Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                counts.update((lang or "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return counts, total


def brute_collocations(docs, threshold=30, best=2000, covered=80):
    counts, total = brute_phrases(docs)
    often = {p: n for p, n in counts.items() if n >= threshold}
    most = Counter()
    for (lang, w), n in often.items():
        for m in range(2, len(w)):
            for s in range(len(w) - m + 1):
                most[lang, w[s : s + m]] = max(most[lang, w[s : s + m]], n)
    found = defaultdict(list)
    for (lang, w), a in often.items():
        if len(w) > 1 and 100 * most[lang, w] < covered * a:
            cuts = [(2_000_000 * a // (counts[lang, w[:c]] + counts[lang, w[c:]]), c) for c in range(1, len(w))]
            score, c = min(cuts)
            found[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:c]], counts[lang, w[c:]]))
    return {
        (lang, k + 1, p.decode(), -a, l, r, total[lang], -s)
        for lang, rows in found.items() for k, (s, a, p, l, r) in enumerate(sorted(rows)[:best])
    }


def rows_of(found):
    rows = found.collect()
    assert len({tuple(r) for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_op11(spark, mixed_dir):
    docs = spark.read.parquet(f"{mixed_dir}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    expected = brute_collocations(rows)
    assert rows_of(collocations.op11_phrase_collocations(spark, mixed_dir)) == expected
    assert expected


@pytest.mark.parametrize("shards", [1, 3])
def test_phrases_that_reach_the_threshold_late(spark, shards):
    """Parts that become frequent in different shards, overlaps, ties, and several languages."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(12)] + ["É漢", "a'b"]
    docs = []
    for k in range(150):
        w = [vocabulary[int(x)] for x in rng.zipf(1.4, rng.integers(1, 30)) % len(vocabulary)]
        docs.append((k % 40, ",\t".join([" ".join(w), "Aa aa AA aa aa"][: 1 + k % 2]), [None, "de", "und"][k % 3]))
    docs += [(None, None, None), (1, "", "de"), docs[0], docs[0], (900, "lone ranger " * 15_000, "xx"), (901, "z" * 30_000, "xx")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"key": F.lit("a"), "n": F.lit(1), "doc": F.lit(1), "shard": F.lit(9)})
    expected = brute_collocations([d[1:] for d in docs], threshold=12, best=25, covered=70)
    assert rows_of(collocations.collocations(frame, threshold=12, best=25, covered=70, shards=shards)) == expected
    assert len(expected) > 30


def test_counts_stay_right_when_bitmaps_let_everything_through(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_has", lambda bitmap, places: np.ones(len(places), bool))
    docs = [(k, ["a b c d a b", "b c d", "x y a b"][k % 3], "en") for k in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    found = collocations.frequent_phrases(frame, threshold=20, shards=3)[0]
    counts, _ = brute_phrases([d[1:] for d in docs])
    assert Counter((r["phrase"], r["n"]) for r in found.collect()) == Counter((" ".join(w), n) for (_, w), n in counts.items() if n >= 20)


def test_only_phrases_that_can_reach_the_threshold_are_summed(spark):
    """A log of three shards, each visited twice, with keys that differ by their check alone."""
    counts = {(2, key, check): [(key * 7 + check * 3 + shard) % 11 for shard in range(3)] for key in range(50) for check in range(2)}
    log = [(*phrase, 5, n, shard + again, shard) for phrase, ns in counts.items() for shard, n in enumerate(ns) if n for again in (0, 3)]
    frame = spark.createDataFrame(log, "k int, key long, check int, doc int, n long, visit int, shard int")
    found = collocations.totals(frame, 2, 3, 20)
    expected = {phrase: (sum(ns), sum(ns[:2])) for phrase, ns in counts.items() if sum(ns) >= 20}
    assert {(r["k"], r["key"], r["check"]): (r["n"], r["before"]) for r in found.collect()} == expected
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_phrases_with_one_key_are_told_apart():
    text = collocations.Text(["a b a b. b a", "a"], ["x", "y"], [1, 2])
    text.grow()
    text.keys = [k & np.uint64(0) for k in text.keys]
    assert sorted(text.counted(2, np.array([0, 1, 2, 4]))["n"].tolist()) == [2, 2]
    words = text.described(1, np.arange(7))
    assert sorted(zip(words["lang"], words["phrase"])) == [("x", "a"), ("x", "b"), ("y", "a")]
