"""op2, op3, op8 against brute force, planted cases and held-out accuracy."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import table
from vintara.llm import crf, pii, repetition

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    "a@b.c_d@e.f a@b@c.d x..y@z.w é𝒳 q@r.st a@b.c..d", "1.2.3.4.5.6.7.8 0001.2.3.255 300.1.1.1 1.2.3 1.2.3.256",
    "4111 1111 1111 1111 5 55-55 4111-1111-1111-1111-4 4111  1111", "+1 (743) 555-3824, +1234567890123456 ++49 30 1234567 +1((",
    "a" * 30_000, "1" * 30_000, "1 " * 9_000, "+" + "(" * 3_000, "a@b" + ".c" * 20_000, "1.1.1.1" * 500, "." * 20_000, "a@" * 5_000,
]
WIDER = [
    "john (at) mail dot com, call 212-555-0187", "card 4111.1111.1111.1111", "mail: eve at example dot org",
    "phone (212) 555-0199 or a@b.com", "host 2001:0db8:0000:0000:0000:ff00:0042:8329 ok",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


@pytest.fixture(scope="module")
def pii_dir(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pii")
    given = table(sf_dir, "documents", "doc_id, text")
    docs = given + [(10**6 + i, t) for i, t in enumerate([None, "", *HARD, *WIDER])] + [(None, "x@y.zz"), (0, "x@y.zz")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_op2(spark, pii_dir):
    rows = pii.op2_pii(spark, pii_dir).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{pii_dir}/documents.parquet").collect()]
    expected = Counter()
    for doc_id, text in texts:
        spans = base_spans(text)
        expected[(doc_id, *[sum(s.startswith(k) for s in spans) for k in BASE], hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in rows) == expected
    text_of = {d: t for d, t in texts if d}
    added = {}
    for r in rows:
        if r["doc_id"]:
            spans, base = r["spans"].split(",") if r["spans"] else [], base_spans(text_of[r["doc_id"]])
            assert set(base) <= set(spans)
            found = [text_of[r["doc_id"]][int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans if s not in base]
            if found:
                added[r["doc_id"] - 10**6 - 2 - len(HARD)] = found
    assert added[0] == ["john (at) mail dot com", "212-555-0187"]
    assert added[1] == ["4111.1111.1111.1111"] and added[2] == ["eve at example dot org"]
    assert all(k >= 0 for k in added)


def test_masked_text(spark, pii_dir):
    docs = spark.createDataFrame([("call +1 (743) 555-3824 or a@b.com, é", 1), (None, 2), ("", 3), ("1.2.3.4", 4)], "text string, k int")
    found = pii.detect(docs, pii.learn(docs))
    rows = {r["k"]: r["t"] for r in found.select("k", pii.masked(found["text"], found["spans"]).alias("t")).collect()}
    assert rows == {1: "call <PHONE> or <EMAIL>, é", 2: None, 3: "", 4: "<IP>"}


def plain_mask(text, spans):
    at, out = 0, ""
    for start, kind, end in spans:
        if start >= at:
            out += text[at:start] + f"<{list(BASE)[kind].upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_many_spans_in_long_texts(spark):
    """Texts of thousands of spans, of a million characters, and with cuts at every edge of pieces and blocks."""
    phones = " call +1 (743) 555-3824 or 212-555-0187, é𝒳@" * 8_000
    texts = [phones, "+49 30 1234567 4111 1111 1111 1111 " * 6_000, "x " * 500_000 + " a@b.com " + "é" * 5_000]
    texts += ["é" * n + "+12345678901;a@b.cc" + "z" * m for n in (1022, 1023, 1024, 2047) for m in (0, 1, 1005)]
    texts += ["1.2.3.4 " * n for n in (127, 128, 129, 256, 257)]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    found = pii.detect(docs, pii.learn(docs))
    rows = found.select("k", "base", "spans", pii.masked(found["text"], found["spans"]).alias("masked")).collect()
    for r in rows:
        text, kinds = texts[r["k"]], list(BASE)
        assert [f"{kinds[s['kind']]}:{s['start']}:{s['end']}" for s in r["base"]] == base_spans(text)
        assert r["masked"] == plain_mask(text, r["spans"])
    assert max(len(r["spans"]) for r in rows) == 16_000


def test_added_spans_keep_clear_of_base_spans(spark):
    rng = np.random.default_rng(1)

    def drawn(n):
        starts = rng.integers(0, 3_000, n)
        return sorted((int(a), int(k), int(a + w)) for a, k, w in zip(starts, rng.integers(0, 4, n), rng.integers(1, 9, n), strict=True))

    cases = [(k, drawn(n), drawn(m)) for k, (n, m) in enumerate([(0, 5), (5, 0), (1, 1), (300, 700), (700, 300), (400, 400)])]
    kind = "array<struct<start:int,kind:int,end:int>>"
    df = spark.createDataFrame(cases, f"k int, base {kind}, more {kind}")
    for r in df.select("k", F.array_sort(pii.apart(F.col("more"), F.col("base"))).alias("kept")).collect():
        _, base, more = cases[r["k"]]
        assert [tuple(s) for s in r["kept"]] == [m for m in more if not any(b[0] < m[2] and m[0] < b[2] for b in base)]


def test_reliable_labelers_are_told_from_noise():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    said = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 for p in (0.95, 0.9, 0.85, 0.5)], axis=1)
    posterior, tables = pii.expectation_maximisation(said.astype(float), np.ones(4000))
    assert ((posterior > 0.5) == truth).mean() > 0.94
    right = [tables[k, 2, 1] for k in range(4)]
    assert right[0] > right[2] > right[3] and abs(right[3] - 0.5) < 0.1


def test_no_candidates(spark, empty_dir):
    assert pii.op2_pii(spark, empty_dir).collect() == []
    docs = spark.createDataFrame([(1, "plain words")], "doc_id long, text string")
    assert pii.detect(docs, pii.learn(docs)).first()["spans"] == []


# ---------------------------------------------------------------- language


def test_op3_on_held_out_documents(spark, sf_dir):
    rows = crf.op3_crf_language(spark, sf_dir).collect()
    lang = dict(table(sf_dir, "documents", "doc_id, lang"))
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_op3_takes_odd_rows_and_uses_text_only(spark, mixed_dir):
    rows = crf.op3_crf_language(spark, mixed_dir).collect()
    assert len(rows) == spark.read.parquet(f"{mixed_dir}/documents.parquet").count()
    by_id = {r["doc_id"]: r for r in rows}
    for k in (100_000, 100_001, 100_002, 100_006):
        assert (by_id[k]["lang_pred"], by_id[k]["score"]) == ("und", 0.0)
    assert by_id[100_005]["lang_pred"] != "und"


def test_without_labels_nothing_is_decided(spark, empty_dir):
    assert crf.op3_crf_language(spark, empty_dir).collect() == []
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert crf.predict(docs, crf.learn(docs)).first()["lang_pred"] == "und"


def test_a_rare_language_is_a_label(spark):
    """Eight documents of a language among 6000: one sample over all rows would hardly have it."""
    rows = [(i, f"the house and the water {i % 7} of many", "en") for i in range(6000)]
    rows += [(10_000 + i, "zwölf größe müßte häßlich", "de") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    how = crf.Training(documents=20, words=2000)
    field = crf.learn(docs, how)
    assert field.labels == ["de", "en"]
    langs = Counter(lang for _, lang in crf.sampled_runs(docs, how))
    assert langs["en"] <= 2 * 20 and langs["de"] == docs.where("lang = 'de'").where(~crf.held_out()).count()
    seen = spark.createDataFrame([(1, "zwölf größe müßte häßlich")], "doc_id long, text string")
    assert crf.predict(seen, field).first()["lang_pred"] == "de"


def test_no_long_text_dominates(spark):
    rows = [(i, f"the house and the water {'abcdefgh'[i % 8]}", "en") for i in range(40)] + [(i, "long words " * 50_000, "en") for i in range(40, 48)]
    runs = crf.sampled_runs(spark.createDataFrame(rows, "doc_id long, text string, lang string"), crf.Training(words=1000))
    n = sum(len(run) for run, _ in runs if run[0] in ("long", "words"))
    assert 0 < n <= 8 * crf.word_budget(1, crf.Training(words=1000)) / 20


def test_the_driver_gets_runs_not_texts(spark):
    """A sampled text of a million words gives its budget only, once for repeated rows."""
    docs = spark.createDataFrame([(1, "long words " * 500_000, "en")] * 2 + [(3, "kurze zeile", "de")], "doc_id long, text string, lang string")
    how = crf.Training(words=100)
    runs = crf.sampled_runs(docs, how)
    assert 0 < sum(len(run) for run, _ in runs if "long" in run or "words" in run) <= 50


@pytest.fixture(scope="module")
def field(sf_dir):
    rows = table(sf_dir, "documents", "text, lang")
    return crf.fit([t for t, _ in rows], [x for _, x in rows], crf.Training(documents=len(rows), words=20_000, epochs=2))


def test_code_switched_text(field, sf_dir):
    texts = {x: t for t, x in table(sf_dir, "documents", "text, lang")}
    words = {x: crf.WORD(texts[x].lower())[:25] for x in ("en", "fr", "de")}
    labelled = crf.word_labels(field, " ".join(w for x in words for w in words[x]))
    true = [x for x in words for _ in words[x]]
    assert np.mean([a == b for (_, a, _), b in zip(labelled, true, strict=True)]) > 0.9


def test_blocks_give_exact_marginals(field):
    rng = np.random.default_rng(5)
    emission = rng.random((30, len(field.labels))).astype(np.float32) + 0.01
    lengths = np.array([1, 7, 64, 65, 200, 3])
    at = rng.integers(0, 30, lengths.sum())
    step = np.exp(field.transitions).astype(np.float32)
    mass = crf.label_mass(at, lengths, emission, step, block=16)
    start = 0
    for k, n in enumerate(lengths):
        probs, _ = crf._expectations(emission[at[start : start + n]].astype(float), np.array([n]), step.astype(float))
        # the blocks put one more step before the first word, from an even start
        first = np.full(len(field.labels), 1 / len(field.labels)) @ step
        exact = emission[at[start : start + n]].astype(float)
        exact[0] = exact[0] * first
        probs, _ = crf._expectations(exact, np.array([n]), step.astype(float))
        assert mass[k] == pytest.approx(probs.sum(axis=0), rel=1e-3)
        start += n


# ---------------------------------------------------------------- quality


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_op8(spark, mixed_dir):
    rows = repetition.op8_suffix_array_repetition(spark, mixed_dir).collect()
    docs = spark.read.parquet(f"{mixed_dir}/documents.parquet").select("doc_id", "text").collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter((d["doc_id"], *brute_quality(d["text"])) for d in docs)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert sum(r["kept"] for r in rows) > 0.7 * len(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=24), min_size=1, max_size=4), st.integers(1, 4))
def test_repeats_are_those_of_brute_force(texts, least):
    words = np.array([w for t in texts for w in t], dtype=np.int64)
    covered, longest = repetition.repeats(words, np.array([len(t) for t in texts]), least)
    for k, t in enumerate(texts):
        spans = [(i, n) for n in range(1, len(t)) for i in range(len(t) - n + 1) if sum(t[j : j + n] == t[i : i + n] for j in range(len(t) - n + 1)) > 1]
        assert longest[k] == max([n for _, n in spans], default=0)
        assert covered[k] == len({i + d for i, n in spans if n >= least for d in range(n)})


def test_repeated_passages_are_rejected(spark):
    line = " ".join(f"w{i}" for i in range(120))
    rest = " ".join(f"r{i}" for i in range(1_000))
    docs = [(1, rest), (2, f"{line} {rest} {line}"), (3, f"{rest} {' '.join(f'r{i}' for i in range(40))}"), (4, None), (5, "short")]
    rows = repetition.quality(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == {1: True, 2: False, 3: True, 4: False, 5: False}
    assert {r["doc_id"]: r["longest_repeat"] for r in rows}[2] == 120


def test_quality_without_rows(spark, empty_dir):
    assert repetition.op8_suffix_array_repetition(spark, empty_dir).collect() == []
