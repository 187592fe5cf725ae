"""Language of words and documents by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import Columns, map_batches, read

WORD = re.compile(r"[^\W\d_]+").findall
UNDECIDED = "und"


class Training(NamedTuple):
    """Bounds of the labelled sample, and how the field is fitted.

    ``documents`` bounds the documents of each language. Each document of the sample may give the
    same number of words: its part of ``words``, or ``least_words`` where that is more.
    """

    documents: int = 1500
    words: int = 150_000
    least_words: int = 20
    buckets: int = 1 << 18
    lexicon_uses: int = 3
    epochs: int = 3
    sequences_a_step: int = 64
    rate: float = 0.15
    penalty: float = 1e-6
    seed: int = 17


class Field(NamedTuple):
    """Weights by feature and label (row 0 is zero), transition weights, labels and lexicon rows."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, int]
    buckets: int


def word_features(words: list[str], lexicon: dict[str, int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of words and the word of each: character n-grams of one to four, and the lexicon.

    An n-gram that takes in a word's edge is a prefix or suffix of one to three characters. Rows
    come in the order of words for each length; row 0 stands for no feature.
    """
    code = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), "<u4").astype(np.uint64)
    edge = code == 10
    owner = np.cumsum(edge) - 1
    rows, owners = [], []
    gram = np.zeros(len(code), np.uint64)
    inner = np.zeros(len(code), bool)
    for size in range(1, 5):
        n = len(code) - size + 1
        if n < 1:
            break
        gram = gram[:n] * np.uint64(0x9E3779B97F4A7C15) + code[size - 1 :] + np.uint64(1)
        inner = inner[:n] | (edge[size - 2 : size - 2 + n] if size > 2 else False)
        mixed = gram ^ (gram >> np.uint64(29))
        row = 1 + ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)) % np.uint64(buckets)
        bad = inner | (edge[:n] if size == 1 else edge[:n] & edge[size - 1 :] if size == 2 else False)
        keep = np.flatnonzero(~bad & (owner[:n] < len(words)))
        rows.append(row[keep].astype(np.int64))
        owners.append(owner[keep])
    known = [(k, lexicon[w]) for k, w in enumerate(words) if w in lexicon]
    if known:
        at, row = np.array(known, dtype=np.int64).T
        rows.append(row + 1 + buckets)
        owners.append(at)
    return np.concatenate(rows), np.concatenate(owners)


def emissions(field: Field, words: list[str]) -> np.ndarray:
    """exp(score) of each word and label, scaled so that the largest of a word is 1."""
    rows, owners = word_features(words, field.lexicon, field.buckets)
    found = field.weights[rows]
    score = np.stack([np.bincount(owners, found[:, k], len(words)) for k in range(len(field.labels))], axis=1)
    return np.exp(score - score.max(axis=1, keepdims=True)).astype(np.float32)


def label_mass(word_at: np.ndarray, lengths: np.ndarray, emission: np.ndarray, step: np.ndarray, block: int = 64) -> np.ndarray:
    """Sum over the words of each text of their label probabilities."""
    return label_sums(word_at, lengths, emission, step, block)[0]


def label_sums(
    word_at: np.ndarray, lengths: np.ndarray, emission: np.ndarray, step: np.ndarray, block: int = 64
) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the words of each text of label probabilities and of the best one, by forward-backward.

    ``word_at`` has the emission row of each word, all texts one after the other. Texts are cut in
    blocks; first each block's transfer matrix is formed for all blocks at once, then a text's
    blocks are chained in both directions, then forward and backward vectors run inside all blocks
    at once. This is exact, and a long text costs no longer loop over single words.
    """
    labels = emission.shape[1]
    n_blocks = -(-lengths // block)
    first = np.cumsum(n_blocks) - n_blocks
    total = int(n_blocks.sum())
    start = np.cumsum(lengths) - lengths
    at = np.full(total * block, len(emission), np.int64)
    at[np.arange(len(word_at)) + np.repeat(first * block - start, lengths)] = word_at
    real = (at < len(emission)).reshape(total, block).T[:, :, None]
    emit = np.vstack([emission, np.ones((1, labels), np.float32)])[at].reshape(total, block, labels).transpose(1, 0, 2)

    def scaled(v: np.ndarray) -> np.ndarray:
        return v / v.sum(axis=-1, keepdims=True)

    transfer = np.broadcast_to(np.eye(labels, dtype=np.float32), (total, labels, labels))
    for t in range(block):
        moved = (transfer.reshape(-1, labels) @ step).reshape(total, labels, labels) * emit[t][:, None, :]
        moved /= moved.sum(axis=(1, 2), keepdims=True)
        transfer = np.where(real[t][:, :, None], moved, transfer)

    ahead, behind = np.empty((total, labels), np.float32), np.empty((total, labels), np.float32)
    by_size = np.argsort(-n_blocks, kind="stable")
    live = np.searchsorted(-n_blocks[by_size], -np.arange(n_blocks.max(initial=0)), "left")
    forward = np.full((len(lengths), labels), 1 / labels, np.float32)
    for b, n in enumerate(live):
        now = first[by_size[:n]] + b
        ahead[now] = forward[:n]
        forward[:n] = scaled(np.einsum("ni,nij->nj", forward[:n], transfer[now]))
    backward = np.full((len(lengths), labels), 1 / labels, np.float32)
    for b in range(len(live) - 1, -1, -1):
        n = live[b]
        now = first[by_size[:n]] + b
        behind[now] = backward[:n]
        backward[:n] = scaled(np.einsum("nij,nj->ni", transfer[now], backward[:n]))

    alphas, vector = [], ahead
    for t in range(block):
        vector = np.where(real[t], scaled((vector @ step) * emit[t]), vector)
        alphas.append(vector)
    mass, vector = np.zeros((total, labels), np.float64), behind
    peak = np.zeros(total)
    for t in range(block - 1, -1, -1):
        probs = np.where(real[t], scaled(alphas[t] * vector), 0)
        mass += probs
        peak += probs.max(axis=1)
        vector = np.where(real[t], scaled((emit[t] * vector) @ step.T), vector)
    out, best = np.zeros((len(lengths), labels)), np.zeros(len(lengths))
    text_of = np.repeat(np.arange(len(lengths)), n_blocks)
    np.add.at(out, text_of, mass)
    np.add.at(best, text_of, peak)
    return out, best


def word_budget(documents: int, how: Training) -> int:
    """Words that each of so many sampled documents may give."""
    return max(how.least_words, how.words // max(documents, 1))


def document_runs(text: str, budget: int, seed: int) -> list[list[str]]:
    """Runs of 5 to 40 words of a text, taken in random order up to ``budget`` words in all."""
    rng = np.random.default_rng(seed)
    words, at, spans = WORD(text.lower()), 0, []
    while at < len(words):
        size = int(rng.integers(5, 41))
        spans.append((at, min(at + size, len(words))))
        at += size
    runs, left = [], budget
    for k in rng.permutation(len(spans)):
        if left <= 0:
            break
        first, end = spans[k]
        runs.append(words[first : min(end, first + left)])
        left -= len(runs[-1])
    return runs


def _sequences(runs: list[tuple[list[str], int]], how: Training) -> list[tuple[list[str], list[int]]]:
    """Training sequences with switches: the runs of all documents, mixed by four."""
    mixed = [runs[k] for k in np.random.default_rng(how.seed).permutation(len(runs))]
    joined = []
    for k in range(0, len(mixed), 4):
        words = [w for run, _ in mixed[k : k + 4] for w in run]
        tags = [label for run, label in mixed[k : k + 4] for _ in run]
        joined.append((words, tags))
    return joined


def fit(texts: list[str], langs: list[str], how: Training) -> Field | None:
    """Fit the field on texts of which each gives the same number of words at most."""
    budget = word_budget(len(texts), how)
    runs = [(run, lang) for k, (t, lang) in enumerate(zip(texts, langs, strict=True)) for run in document_runs(t, budget, how.seed + k)]
    return fit_runs(runs, how)


def fit_runs(runs: list[tuple[list[str], str]], how: Training) -> Field | None:
    """Fit the field by AdaGrad on the log likelihood of sequences of runs of words (words, language).

    Every language of a run is a label; None without any run.
    """
    labels = sorted({lang for _, lang in runs})
    number = {lang: k for k, lang in enumerate(labels)}
    sequences = _sequences([(words, number[lang]) for words, lang in runs], how)
    if not sequences:
        return None
    uses = Counter(w for words, _ in sequences for w in words)
    lexicon = {w: k for k, w in enumerate(sorted(w for w, n in uses.items() if n >= how.lexicon_uses))}
    n = len(labels)
    weights = np.zeros((1 + how.buckets + len(lexicon), n), np.float32)
    squares = np.full_like(weights, 1e-2)
    transitions, trans_squares = np.zeros((n, n), np.float64), np.full((n, n), 1e-2)
    rng = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for chosen in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // how.sequences_a_step)):
            part = sorted((sequences[k] for k in chosen), key=lambda s: -len(s[0]))
            field = Field(labels, weights, transitions, lexicon, how.buckets)
            words = [w for seq, _ in part for w in seq]
            tags = np.array([t for _, seq in part for t in seq])
            lengths = np.array([len(seq) for seq, _ in part])
            rows, owners = word_features(words, lexicon, how.buckets)
            emission = _scores(weights, rows, owners, len(words), n)
            expected, pairs = _expectations(emission, lengths, np.exp(transitions))
            observed = np.eye(n)[tags]
            slope = (observed - expected).astype(np.float32)
            starts = np.cumsum(lengths) - lengths
            follows = np.ones(len(tags), bool)
            follows[starts] = False
            seen = np.zeros((n, n))
            np.add.at(seen, (tags[:-1][follows[1:]], tags[1:][follows[1:]]), 1)
            touched, where = np.unique(rows, return_inverse=True)
            grad = np.stack([np.bincount(where, slope[owners, k], len(touched)) for k in range(n)], axis=1)
            grad = (grad - how.penalty * weights[touched]).astype(np.float32)
            squares[touched] += grad**2
            weights[touched] += how.rate * grad / np.sqrt(squares[touched])
            trans_grad = seen - pairs
            trans_squares += trans_grad**2
            transitions += how.rate * trans_grad / np.sqrt(trans_squares)
    return Field(labels, weights, transitions, lexicon, how.buckets)


def _scores(weights: np.ndarray, rows: np.ndarray, owners: np.ndarray, words: int, labels: int) -> np.ndarray:
    found = weights[rows]
    score = np.stack([np.bincount(owners, found[:, k], words) for k in range(labels)], axis=1)
    return np.exp(score - score.max(axis=1, keepdims=True))


def _expectations(emission: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word and expected transition counts; sequences longest first."""
    starts = np.cumsum(lengths) - lengths
    labels = emission.shape[1]
    live = [int((lengths > t).sum()) for t in range(int(lengths[0]))]
    alphas, betas = np.empty_like(emission), np.empty_like(emission)
    vector = np.full((len(lengths), labels), 1 / labels)
    for t, n in enumerate(live):
        at = starts[:n] + t
        moved = (vector[:n] @ step if t else vector[:n]) * emission[at]
        vector[:n] = moved / moved.sum(axis=1, keepdims=True)
        alphas[at] = vector[:n]
    pairs = np.zeros((labels, labels))
    vector = np.full((len(lengths), labels), 1 / labels)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = starts[:n] + t
        betas[at] = vector[:n]
        if t:
            weighted = emission[at] * vector[:n]
            joint = alphas[at - 1][:, :, None] * step[None] * weighted[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = weighted @ step.T
            vector[:n] = back / back.sum(axis=1, keepdims=True)
    both = alphas * betas
    return both / both.sum(axis=1, keepdims=True), pairs


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sampled_runs(docs: DataFrame, how: Training) -> list[tuple[list[str], str]]:
    """Runs of words, with their language, of a bounded sample of labelled ``docs`` (doc_id, text, lang).

    Usable rows have a language, a doc_id and a letter in the text, and are not held out. All of
    them are counted by language first (repeated rows as one); the sample has of each language the
    ``documents`` rows with the smallest hash of doc_id and text, all if there are fewer. The tasks
    cut their runs, so that the driver gets ``word_budget`` words of a document, however long it is.
    """
    usable = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out()
    known = docs.where(usable).select("lang", "text", F.xxhash64("doc_id", "text").alias("mark"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")).collect()}
    if not counts:
        return []
    budget = word_budget(sum(min(n, how.documents) for n in counts.values()), how)
    # Rows of a hash up to this are about 1.2 times as many as wanted, as the counts are close but not exact.
    shares = {lang: min(1.0, (1.2 * how.documents + 20) / max(n, 1)) for lang, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for lang, share in shares.items() for x in (lang, int(share * 2**64) - 2**63 - 1)])

    def cut(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            runs = [document_runs(t, budget, m + 2**63) for t, m in zip(batch["text"], batch["mark"], strict=True)]
            yield {"lang": batch["lang"], "mark": batch["mark"], "runs": ["\n".join(map(" ".join, r)) for r in runs]}

    some = map_batches(known.where(F.col("mark") <= limits[F.col("lang")]), cut, "lang string, mark long, runs string")
    found, taken = [], Counter()
    for r in sorted(some.distinct().collect(), key=lambda r: (r["mark"], r["lang"])):
        taken[r["lang"]] += 1
        if taken[r["lang"]] <= how.documents:
            found += [(run.split(" "), r["lang"]) for run in r["runs"].split("\n") if run]
    return found


def learn(docs: DataFrame, how: Training | None = None) -> Field | None:
    """Fit a field on the sampled runs of labelled documents; its labels are all their languages."""
    how = how or Training()
    return fit_runs(sampled_runs(docs, how), how)


def word_labels(field: Field, text: str) -> list[tuple[str, str, float]]:
    """Each word of a text with its most probable language and that probability."""
    words = WORD(text.lower())
    if not words:
        return []
    probs, _ = _expectations(emissions(field, words).astype(np.float64), np.array([len(words)]), np.exp(field.transitions))
    best = probs.argmax(axis=1)
    return [(w, field.labels[k], float(p[k])) for w, k, p in zip(words, best, probs, strict=True)]


def predict(docs: DataFrame, field: Field | None, evidence: bool = False) -> DataFrame:
    """``docs`` (with ``text``) and lang_pred, score; columns of these names are replaced.

    A document's label is the one with the most probability over its words, the score its mean
    probability. Null texts and texts without a letter (and all, if nothing could be learned) are
    ``und`` with score 0. Ties go to the first label in order of names. With ``evidence``, a column
    of this name has how far the mean of each word's best probability is above chance: 0 where all
    labels are alike for every word, 1 where each word has one label, be they of several languages.
    """
    kept = docs.drop("lang_pred", "score", *["evidence"] * evidence)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        step = None if field is None else np.exp(field.transitions).astype(np.float32)
        for batch in batches:
            labels, scores = [UNDECIDED] * len(batch["text"]), [0.0] * len(batch["text"])
            above = [0.0] * len(batch["text"])
            docs_words = [WORD(t.lower()) if t else [] for t in batch["text"]]
            usable = [k for k, ws in enumerate(docs_words) if any(c.isalpha() for w in ws for c in w)] if field else []
            if usable:
                row_of: dict[str, int] = {}
                at = [row_of.setdefault(w, len(row_of)) for k in usable for w in docs_words[k]]
                lengths = np.array([len(docs_words[k]) for k in usable])
                mass, best_sum = label_sums(np.array(at), lengths, emissions(field, list(row_of)), step)
                chance = 1 / len(field.labels)
                sure = (best_sum / lengths - chance) / (1 - chance) if chance < 1 else np.ones(len(lengths))
                for k, e in zip(usable, sure, strict=True):
                    above[k] = float(np.clip(e, 0, 1))
                share = mass / mass.sum(axis=1, keepdims=True)
                for k, best, p in zip(usable, share.argmax(axis=1), share.max(axis=1), strict=True):
                    labels[k], scores[k] = field.labels[best], min(1.0, float(p))
            yield {**batch, "lang_pred": labels, "score": scores, "evidence": above}

    return map_batches(kept, run, f"{schema}, lang_pred string, score double" + ", evidence double" * evidence)


def op3_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    field = learn(docs)
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), field).drop("text")
