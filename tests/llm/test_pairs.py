"""op1 and op9 against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintara.llm import bottomk, components, jaccard

WORDS = 5


def shingles(text, lower=True):
    words = (text or "").encode()
    words = (words.lower() if lower else words).split()
    return frozenset(tuple(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))) if words else frozenset()


def brute_components(docs):
    """doc_id, set size and smallest linked doc_id of each row."""
    sets = [(doc_id, shingles(text)) for doc_id, text in docs]
    distinct = list({s for _, s in sets if s})
    parent = list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for k, s in enumerate(distinct):
        for j, n in Counter(j for g in s for j in lists[g]).items():
            if 100 * n >= 75 * (len(s) + len(distinct[j]) - n):
                parent[root(k)] = root(j)
        for g in s:
            lists[g].append(k)
    place, low = {s: k for k, s in enumerate(distinct)}, {}
    for doc_id, s in sets:
        if s and doc_id is not None:
            low[root(place[s])] = min(low.get(root(place[s]), doc_id), doc_id)
    return Counter((d, len(s), low.get(root(place[s])) if s else d) for d, s in sets)


def near_copies(n, seed=3):
    """A group of near copies whose pairs lie about the threshold, and texts sharing a long passage."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(n):
        words = list(base)
        for k in rng.integers(0, 80, rng.integers(0, 4)):
            words[k] = f"e{i}x{k}"
        docs.append((i, " ".join(words)))
    for i in range(n, n + 20):
        docs.append((i, " ".join(base + [f"o{i}x{k}" for k in range(18 + i % 9)])))
    return docs


def test_op1(spark, mixed_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in jaccard.op1_jaccard_join(spark, mixed_dir).collect()) == brute_components(docs)


def test_a_group_about_the_threshold(spark):
    docs = near_copies(120)
    found = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert rows == brute_components(docs)
    assert len({c for _, _, c in rows}) > 1


def test_links_inside_components_are_counted(spark):
    """Every row's links, by brute force over all pairs of rows."""
    docs = [*near_copies(60), (0, near_copies(1)[0][1]), (900, None), (901, "a b"), (None, "A b"), (None, None)]
    sets = [shingles(t) for _, t in docs]
    linked = [[bool(x and y) and 100 * len(x & y) >= 75 * len(x | y) for y in sets] for x in sets]
    links, rows = jaccard.jaccard_links(spark.createDataFrame(docs, "doc_id long, text string"))
    found = rows.collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in found) == Counter((d, sum(row) - bool(s)) for (d, _), s, row in zip(docs, sets, linked))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(docs)
    nodes = list({s for s in sets if s})
    pairs = sum(100 * len(x & y) >= 75 * len(x | y) for k, x in enumerate(nodes) for y in nodes[:k])
    assert links.count() == pairs > 2 * len(nodes)


def test_only_shingles_of_many_nodes_take_turns(spark, monkeypatch):
    """Groups below, at and above the size whose pairs are formed at once; all of them are linked right."""
    taken = []

    def measured(shared, size=jaccard.open_size):
        taken.extend(r["count"] for r in shared.groupBy("token").count().collect())
        return size(shared)

    monkeypatch.setattr(jaccard, "open_size", measured)
    docs = []
    for group, n in enumerate((2, 7, 8, 9, 12)):
        docs += [(len(docs) + k, text.replace("w", f"g{group}w")) for k, (_, text) in enumerate(near_copies(n, group)[:n])]
    found = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(docs)
    assert taken and min(taken) > 8


def test_nodes_of_the_same_shingles_meet_several_pivots(spark):
    rows = [(token, node, 100, token, node) for token in range(14) for node in range(60)]
    shared = spark.createDataFrame(rows, "token long, node long, n int, pos int, label long")
    pairs = {tuple(r) for r in jaccard.pivot_pairs(shared, 0, 75).collect()}
    assert all(a < b for a, b in pairs)
    assert 60 * 4 < len(pairs) <= 60 * jaccard.NODE_PIVOTS
    assert not pairs & {tuple(r) for r in jaccard.pivot_pairs(shared.withColumn("label", F.lit(0)), 0, 75).collect()}
    assert pairs != {tuple(r) for r in jaccard.pivot_pairs(shared, 1, 75).collect()}


def test_only_sets_that_can_reach_the_threshold_move(spark, monkeypatch):
    """Texts of two passages, each in two of them, and a pair that is near enough; prefixes are not stored."""
    stored = []

    def noted(df, step, write=jaccard.write_through):
        out = write(df, step)
        stored.append((step, out.columns, out.count()))
        return out

    monkeypatch.setattr(jaccard, "write_through", noted)
    passages = [" ".join(f"p{k}x{j}" for j in range(50)) for k in range(12)]
    docs = [(k, f"{passages[k]} {passages[(k + 1) % 12]}") for k in range(12)]
    docs += [(12, "a text of its own " * 2), (13, "a text of its own " * 2 + "and more")]
    docs += [(14, " ".join(f"y{j}" for j in range(90))), (15, " ".join(f"y{j}" for j in range(92)))]
    found = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(docs)
    rows = {step: n for step, _, n in stored}
    assert rows["pairs"] > 5 and rows["likely-pairs"] < 4 and rows["verified-links"] >= 1
    assert not any("prefix" in columns for _, columns, _ in stored)


def test_links_of_repeated_and_odd_rows(spark, mixed_dir):
    """Repeated rows are linked with each other and with all that their text is linked with."""
    a, b = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(62))
    rows = [(1, a), (1, a), (2, b), (2, b), (2, b), (None, a), (7, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    links, found = jaccard.jaccard_links(frame)
    assert links.count() == 1
    assert Counter((r["doc_id"], r["n_links"]) for r in found.collect()) == Counter([(1, 5), (1, 5), (2, 5), (2, 5), (2, 5), (None, 5), (7, 0), (8, 0)])
    docs = [tuple(r) for r in spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()]
    sets = [(d, shingles(t)) for d, t in docs]
    links_of = lambda x: sum(100 * len(x & y) >= 75 * len(x | y) for _, y in sets if y) - 1 if x else 0
    assert Counter((r["doc_id"], r["n_links"]) for r in jaccard.op1_jaccard_links(spark, mixed_dir).collect()) == Counter((d, links_of(x)) for d, x in sets)


def test_no_links_of_no_documents(spark, empty_dir):
    assert jaccard.op1_jaccard_links(spark, empty_dir).collect() == []


def test_one_of_each_component_stays(spark):
    docs = [(3, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (9, None), (8, " "), (2, "other words here"), (None, "q r s"), (None, "q r s")]
    kept = jaccard.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in kept) == Counter([(2, "a b c d e f g"), (2, "other words here"), (9, None), (8, " "), (None, "q r s")])


def test_no_documents(spark, empty_dir):
    assert jaccard.op1_jaccard_join(spark, empty_dir).collect() == []
    assert bottomk.op9_bottomk_fingerprints(spark, empty_dir).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab \n\t\x0bé", max_size=30), max_size=6))
def test_hashed_sets_have_the_sizes_of_sets(texts):
    assert [len(s) for s in jaccard.shingle_sets(texts)] == [len(shingles(t)) for t in texts]


def test_long_words_and_groups(monkeypatch):
    texts = ["x" * 100 + " y", "x" * 100 + " Y", "x" * 101 + " y", "z " * 400]
    whole = list(jaccard.shingle_sets(texts))
    assert (whole[0] == whole[1]).all() and (whole[0] != whole[2]).all()
    monkeypatch.setattr(jaccard, "GROUP_BYTES", 1)
    assert all((a == b).all() for a, b in zip(whole, jaccard.shingle_sets(texts), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 40)), st.sets(st.integers(0, 40)), st.integers(50, 95))
def test_filters_lose_no_pair(a, b, percent):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    if a and b:
        assert jaccard.reaches(x, y, percent) == (100 * len(a & b) >= percent * len(a | b))
        assert jaccard.suffix_distance(x, y, 10**6) <= len(a ^ b)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=90), st.sets(st.integers(0, 300), min_size=1, max_size=40), st.integers(0, 90), st.integers(50, 95))
def test_sketches_lose_no_pair(a, b, shared, percent):
    b = b | set(sorted(a)[:shared])
    x, y = (jaccard.sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
    assert jaccard.may_reach(x, y, percent) or 100 * len(a & b) < percent * len(a | b)
    assert jaccard.may_reach(x, x, percent)


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (2, 1)]
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in rows} == {i: 0 for i in range(61)} | {k: 100 for k in range(100, 160)}
    assert len(rows) == 121


# ---------------------------------------------------------------- fingerprints


def test_op9(spark, mixed_dir):
    rows = bottomk.op9_bottomk_fingerprints(spark, mixed_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").where("doc_id is not null").collect()]
    assert len(rows) == spark.read.parquet(f"{mixed_dir}/documents.parquet").count()
    text_of = {d: t or "" for d, t in docs}
    order = sorted(text_of)
    prints = {}
    errors = []
    by_id = {r["doc_id"]: r for r in rows}
    for k, doc_id in enumerate(order):
        text, row = text_of[doc_id], by_id[doc_id]
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert row["n_chars"] == len(text)
        if k + 1 < len(order):
            edited = text[: len(text) - len(text) // 4] + text_of[order[k + 1]][: len(text) // 4]
            assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            for other, near in ((edited, row["near_edited"]), (text_of[order[k + 1]], row["near_next"])):
                a, b = shingles(text, False), shingles(other, False)
                true = len(a & b) / len(a | b) if a | b else 1.0
                errors.append(abs(true - near))
                if len(a | b) <= bottomk.KEPT:
                    assert near == pytest.approx(true)
    assert np.mean(errors) < 0.03 and max(errors) < 0.25


def test_the_first_document_follows_the_last(spark):
    docs = spark.createDataFrame([(1, "abcdefgh"), (5, "12345678"), (5, "12345678")], "doc_id long, text string")
    rows = {r["doc_id"]: r["edited"] for r in bottomk.with_edited(docs).collect()}
    assert rows == {1: "abcdef12", 5: "123456ab"}
    alone = bottomk.with_edited(docs.where("doc_id = 1")).first()
    assert alone["edited"] == "abcdefab"


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3_000)]
    texts = {"a": words[:2000], "b": words[1000:], "c": words[:50]}
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "name string, text string")
    made = df.withColumn("sketch", bottomk.sketch(F.col("text")))
    parts = spark.createDataFrame([("a", " ".join(words[k : k + 104])) for k in range(0, 1900, 100)] + [("a", " ".join(words[1900:2000]))], "name string, text string")
    merged = bottomk.sketch_parts(parts.withColumn("sketch", bottomk.sketch(F.col("text"))), "name").first()["sketch"]
    sketches = {r["name"]: r["sketch"] for r in made.collect()}
    assert merged == sketches["a"]
    pairs = made.alias("x").join(made.alias("y"), F.col("x.name") < F.col("y.name")).select(
        F.concat("x.name", "y.name").alias("k"), bottomk.resemblance(F.col("x.sketch"), F.col("y.sketch")).alias("r"),
        bottomk.containment(F.col("y.sketch"), F.col("x.sketch")).alias("inside"), bottomk.distinct_shingles(F.col("x.sketch")).alias("n"),
    )
    got = {r["k"]: r for r in pairs.collect()}
    assert got["ab"]["r"] == pytest.approx(996 / 2996, abs=0.12)
    assert got["ac"]["inside"] == pytest.approx(1.0, abs=0.35)
    assert got["ab"]["n"] == pytest.approx(1996, rel=0.3)
