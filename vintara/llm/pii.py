"""Personal data by weak supervision, in DataFrame functions only.

Regex, gazetteer and context labelers vote on candidate spans. How often each combination of votes
occurs is counted over all documents; on these counts expectation-maximisation estimates how
reliable each labeler is, and its posteriors train the final classifier of spans.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm.common import read

# ---------------------------------------------------------------- fixed values
KINDS = ("email", "ip", "card", "phone")
# Base patterns. They find what the plain ones find: a run of name characters or digits is tried
# from its start only (nothing inside can match if that fails), and what cannot be given back is
# matched possessively, so that long runs stay linear. A card of under 12 digits would be dropped.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider forms that the base leaves out: spelled-out addresses, version 6 addresses, cards in groups
# with other signs, and phone numbers without a country code.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+(?:"
    r"\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)[A-Za-z0-9-]{2,63}+){1,4}+"
    r"|\x20at\x20[A-Za-z0-9-]{1,63}+(?:\x20dot\x20[A-Za-z0-9-]{2,63}+){1,4}+)",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z._/])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"
# Gazetteers: ends of domains, issuer numbers, North American area codes and calling codes, and
# address blocks that are set aside.
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|biz|io|de|fr|es|uk|it|nl|eu|ch|at|be|us|ca|au|jp|br|mx)$",
    "ip": r"^(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|[1-9][0-9]?\.|1[0-9]{2}\.|2[0-4][0-9]\.|25[0-5]\.)|^(?i:2[0-9a-f]{3}|fe80|fd[0-9a-f]{2}):",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9]))",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-46-9]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-8][0-9])",
}
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|correo|kontakt|courriel|schreib)[^\n]{0,24}$",
    "ip": r"(?i)(?:\bip\b|host|server|address|addr|serveur|servidor|adresse)[^\n]{0,24}$",
    "card": r"(?i)(?:card|visa|master|amex|credit|karte|carte|tarjeta)[^\n]{0,24}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|anruf|appel|llama|whatsapp)[^\n]{0,24}$",
}
COUNTER_CUES = r"(?i)(?:version|release|isbn|issn|order|invoice|serial|part no|model|section|chapter|build|\bv)[^\n]{0,12}$"
CONTEXT = 40
LABELERS = ("form", "valid", "gazetteer", "cue", "counter_cue", "edges")
ACCEPT = 0.8
# Numbers folded as one block, and code points of a piece of text: both only bound the work for a span.
BLOCK = 128
PIECE = 1024
ROUNDS = 60


def found(text: Column, pattern: str) -> Column:
    """Leftmost matches of a pattern that do not overlap."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where ``use`` names it inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def running(numbers: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each of the numbers the fold, from 0, of those before it.

    A fold that keeps all its steps copies them at each, so numbers go by blocks of ``BLOCK``: the
    totals of the blocks give each block its start.
    """
    none = F.array().cast("array<array<int>>")

    def steps(values: Column, first: Column) -> Column:
        more = lambda done, v: F.concat(done, F.array(fold(F.get(done, F.size(done) - 1), v)))
        return F.aggregate(values, F.array(first), more)

    def cut(values: Column) -> Column:
        last = ((F.size(values) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(values) == 0, none).otherwise(blocks)

    def before(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), fold))
        return let(steps(totals, F.lit(0)), lambda firsts: F.flatten(F.transform(
            blocks, lambda b, k: F.slice(steps(b, F.get(firsts, k)), F.lit(1), F.size(b))
        )))

    return let(let(numbers, cut), before)


def placed(text: Column, values: Column, pattern: str) -> Column:
    """Matches with their places: the gaps between matches come from a split by the same pattern."""
    none = F.array().cast("array<struct<start:int,value:string>>")

    def spans(gaps: Column) -> Column:
        lengths = F.transform(values, lambda v, k: F.length(F.get(gaps, k)) + F.length(v))
        return let(running(lengths, lambda a, b: a + b), lambda before: F.transform(
            values, lambda v, k: F.struct((F.get(before, k) + F.length(F.get(gaps, k))).alias("start"), v.alias("value"))
        ))

    return F.when(F.size(values) == 0, none).otherwise(let(F.split(text, pattern, -1), spans))


def pieces_of(text: Column) -> Column:
    """The text cut every ``PIECE`` code points, so that a part is reached without counting from the start."""
    return F.when(F.length(text) <= PIECE, F.array(text)).otherwise(found(text, f"(?s).{{1,{PIECE}}}"))


def near(pieces: Column, start: Column, length: Column) -> Column:
    """A part of the text that is no longer than a piece, out of the two pieces that hold it."""
    first = (start / PIECE).cast("int")
    held = F.concat(F.get(pieces, first), F.coalesce(F.get(pieces, first + 1), F.lit("")))
    return F.coalesce(F.substring(held, start - first * PIECE + 1, length), F.lit(""))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to before ``end``, out of the pieces that hold it."""
    first, last = (start / PIECE).cast("int"), (end / PIECE).cast("int")
    held = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.substring(held, start - first * PIECE + 1, end - start)


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    from_right = F.reverse(digits)

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(from_right, k, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(k % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(OCTETS) | value.contains(":")
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(F.substring(digits, 1, 19))
    return F.length(digits).between(9, 15)


def in_context(pieces: Column, span: Column) -> Column:
    """A placed span with its end, the text before it and the character after it."""
    start = span["start"]
    end = start + F.length(span["value"])
    left = near(pieces, F.greatest(start - CONTEXT, F.lit(0)), F.least(start, F.lit(CONTEXT)))
    return F.struct(
        start.alias("start"), end.alias("end"), span["value"].alias("value"),
        left.alias("left"), near(pieces, end, F.lit(1)).alias("right"),
    )


def votes(kind: str, span: Column, base: bool) -> Column:
    """What each labeler says of a span, coded 0 against, 1 nothing, 2 for; and its length class."""
    value, left, right = span["value"], span["left"], span["right"]
    yes, no, silent = F.lit(2), F.lit(0), F.lit(1)
    ok = valid(kind, value)
    bare = F.regexp_replace(value, "[^0-9]", "") if kind == "card" else value
    said = {
        "form": yes if base else silent,
        "valid": F.when(value.rlike("[A-Za-z]{2}$") if kind == "email" else ok, yes).otherwise(no),
        "gazetteer": F.when(bare.rlike(GAZETTEER[kind]), yes).otherwise(no),
        "cue": F.when(left.rlike(CUES[kind]), yes).otherwise(silent),
        "counter_cue": F.when(left.rlike(COUNTER_CUES), no).otherwise(silent),
        "edges": F.when(F.right(left, F.lit(1)).rlike(r"[\p{L}\p{N}]") | right.rlike(r"[\p{L}\p{N}]"), no).otherwise(silent),
    }
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), F.lit(base).alias("base"), ok.alias("ok"),
        *[said[k].alias(k) for k in LABELERS], F.least(F.length(value) / 8, F.lit(3)).cast("int").alias("size"),
    )


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) and a column of voted candidate spans for each kind.

    The matches are a stage of their own: Spark keeps a costly value that is used several times.
    """
    text = F.coalesce("text", F.lit(""))
    guard = {"email": text.contains("@"), "ip": text.contains("."), "card": text.rlike("[0-9]"), "phone": text.contains("+")}
    loose = {"email": text.rlike("(?:\\bat\\b|[\\[({]at)"), "ip": text.contains(":"), "card": guard["card"], "phone": guard["card"]}
    none = F.array().cast("array<string>")
    first = docs.withColumns(
        {f"_{k}": F.when(guard[k], found(text, BASE[k])).otherwise(none) for k in KINDS}
        | {f"_{k}_wide": F.when(loose[k], found(text, WIDE[k])).otherwise(none) for k in KINDS}
    )
    sizes = [F.size(c) for k in KINDS for c in (f"_{k}", f"_{k}_wide")]
    second = first.withColumns(
        {f"_{k}": placed(text, F.col(f"_{k}"), BASE[k]) for k in KINDS}
        | {f"_{k}_wide": placed(text, F.col(f"_{k}_wide"), WIDE[k]) for k in KINDS}
        | {"_pieces": F.when(reduce(lambda a, b: a + b, sizes) > 0, pieces_of(text))}
    )

    def voted(kind: str, name: str, base: bool) -> Column:
        spans = F.transform(F.col(name), lambda s: in_context(F.col("_pieces"), s))
        return F.transform(spans, lambda s: votes(kind, s, base))

    both = {f"_{k}": F.concat(voted(k, f"_{k}", True), voted(k, f"_{k}_wide", False)) for k in KINDS}
    return second.withColumns(both).drop("_pieces", *[f"_{k}_wide" for k in KINDS])


def vote_counts(candidates: DataFrame) -> dict[str, np.ndarray]:
    """For each kind the combinations of votes and length class, with how many candidates have them.

    At most 3**6 * 4 combinations a kind reach the driver, however many candidates there are.
    """
    names = [*LABELERS, "size"]

    def tagged(kind: str) -> Column:
        return F.transform(F.col(f"_{kind}"), lambda s: F.struct(F.lit(kind).alias("kind"), *[s[n].alias(n) for n in names]))

    rows = candidates.select(F.explode(F.concat(*map(tagged, KINDS))).alias("c")).select("c.*")
    counts = rows.groupBy("kind", *names).count().collect()
    return {k: np.array([[*[r[n] for n in names], r["count"]] for r in counts if r["kind"] == k], dtype=float).reshape(-1, len(names) + 1) for k in KINDS}


def expectation_maximisation(said: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each combination of votes, and P(vote | truth) by labeler, vote and truth.

    Starts from the mean vote. A labeler is held to be a little better than chance at first: each
    of its votes has been seen twice where it is right and once where it is wrong.
    """
    seen_before = np.array([[2.0, 1.0], [1.0, 1.0], [1.0, 2.0]])
    posterior = 0.5 + 0.4 * np.tanh((said - 1).sum(axis=1))
    table = np.zeros((said.shape[1], 3, 2))
    for _ in range(rounds):
        weight = np.stack([n * (1 - posterior), n * posterior], axis=1)
        for labeler in range(said.shape[1]):
            for vote in range(3):
                table[labeler, vote] = weight[said[:, labeler] == vote].sum(axis=0) + seen_before[vote]
        table /= table.sum(axis=1, keepdims=True)
        share = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        logs = np.log(share) + sum(np.log(table[k, said[:, k].astype(int)]) for k in range(said.shape[1]))
        posterior = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return posterior, table


def features(table: np.ndarray) -> np.ndarray:
    """One-hot votes and length class of combinations, and a constant."""
    hot = [np.eye(3)[table[:, k].astype(int)] for k in range(len(LABELERS))]
    return np.hstack([*hot, np.eye(4)[table[:, len(LABELERS)].astype(int)], np.ones((len(table), 1))])


def train(table: np.ndarray, rounds: int = 400, penalty: float = 0.01) -> np.ndarray:
    """Weights of a logistic classifier of spans, fitted to the posteriors of the combinations."""
    x, n = features(table), table[:, -1]
    if not len(table):
        return np.zeros(x.shape[1])
    target, _ = expectation_maximisation(table[:, : len(LABELERS)], n)
    share, weights = n / n.sum(), np.zeros(x.shape[1])
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-x @ weights))
        weights -= 2.0 * (x.T @ (share * (guess - target)) + penalty * weights / len(weights))
    return weights


def learn(docs: DataFrame) -> dict[str, list[float]]:
    """Classifier weights for each kind, from the candidates of all documents."""
    return {k: train(t).tolist() for k, t in vote_counts(with_candidates(docs.select("text"))).items()}


def probability(span: Column, weights: list[float]) -> Column:
    """The classifier as a column: the weight of each vote, of the length class and the constant."""
    tables = [weights[3 * k : 3 * k + 3] for k in range(len(LABELERS))]
    parts = [F.get(F.array(*map(F.lit, t)), span[name]) for name, t in zip(LABELERS, tables, strict=True)]
    size = F.get(F.array(*map(F.lit, weights[-5:-1])), span["size"])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, parts, size + F.lit(weights[-1]))))


def detect(docs: DataFrame, model: dict[str, list[float]], accept: float = ACCEPT) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind number, end), in order.

    Base spans are the valid matches of the base patterns. Added are valid spans of wider form
    that the classifier accepts and that no base span overlaps. A null text has none; columns of
    docs named base or spans are replaced.
    """
    candidates = with_candidates(docs.drop("base", "spans"))

    def chosen(kind: int, base: bool) -> Column:
        def keep(s: Column) -> Column:
            return s["ok"] & (s["base"] if base else ~s["base"] & (probability(s, model[KINDS[kind]]) >= accept))

        spans = F.filter(F.col(f"_{KINDS[kind]}"), keep)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    base = F.concat(*[chosen(k, True) for k in range(len(KINDS))])
    more = F.concat(*[chosen(k, False) for k in range(len(KINDS))])
    both = candidates.withColumn("base", F.array_sort(base)).withColumn("_more", more).drop(*[f"_{k}" for k in KINDS])
    spans = F.array_sort(F.concat("base", apart(F.col("_more"), F.col("base"))))
    return both.withColumn("spans", spans).drop("_more")


def apart(more: Column, base: Column) -> Column:
    """The spans of ``more`` that no base span overlaps.

    Base spans at their start and the others at their end, in order: what overlaps a span starts
    before its end, so the furthest end of the base spans before it tells.
    """

    def event(at: str, is_base: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(s[at].alias("at"), F.lit(is_base).alias("is_base"), s.alias("span"))

    def free(events: Column) -> Column:
        ends = F.transform(events, lambda e: e["is_base"] * e["span"]["end"])
        return let(running(ends, larger), lambda furthest: F.transform(
            F.filter(events, lambda e, k: (e["is_base"] == 0) & (F.get(furthest, k) <= e["span"]["start"])), lambda e: e["span"]
        ))

    events = F.array_sort(F.concat(F.transform(more, event("end", 0)), F.transform(base, event("start", 1))))
    return F.when((F.size(more) == 0) | (F.size(base) == 0), more).otherwise(let(events, free))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans by the first."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def filled(pieces: Column) -> Column:
        def parts(done: Column) -> Column:
            # ``done`` is how far the spans before each one reach.
            part = lambda s, k: F.when(s["start"] < F.get(done, k), "").otherwise(
                F.concat(between(pieces, F.get(done, k), s["start"]), F.get(names, s["kind"]))
            )
            last = F.size(spans) - 1
            rest = between(pieces, F.greatest(F.get(done, last), F.get(spans, last)["end"]), F.length(text))
            return F.concat(F.array_join(F.transform(spans, part), ""), rest)

        return let(running(F.transform(spans, lambda s: s["end"]), larger), parts)

    return F.when(F.size(spans) == 0, text).otherwise(let(pieces_of(text), filled))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, their digest and all spans of each document; a null or an empty text has none.

    Rows of a repeated doc_id are told apart by nothing: each has its own result row. The work for a
    text grows with its length and its number of spans.
    """
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    spans = detect(docs, learn(docs))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = map(count, range(len(KINDS)))
    return spans.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
