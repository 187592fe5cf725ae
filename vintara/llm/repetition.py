"""Quality rules: repetition found by suffix arrays, and base counts of words, symbols and lines."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from vintara.llm.common import Columns, map_batches, read

SYMBOLS = "#*$%&|<>"
# Words whose suffixes are sorted at once; a longer text is sorted alone.
GROUP_WORDS = 200_000
# Repeats of fewer words are everyday phrases and don't count.
REPEAT_WORDS = 8
MIN_WORDS = 20
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " longest_repeat long, base_failed boolean, kept boolean"
)


class Limits(NamedTuple):
    """The verdict: part of the words in repeats, words of the longest repeat, symbols to words."""

    repeat_fraction: float = 0.25
    longest_repeat: int = 100
    symbol_ratio: float = 0.5


class Numbers(dict):
    """Numbers words in order of first use."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def suffix_array(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of the sequence ``keys`` in order, and the ranks of their prefixes of 1, 2, 4... keys.

    ``ends`` has for each place the end of its text; a suffix ends there. Prefix doubling: in each
    round only suffixes that still share their rank are sorted again, by the rank of what follows.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.r_[True, keys[order][1:] != keys[order][:-1]] if n else np.empty(0, bool)
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = heads[np.cumsum(new) - 1] if n else heads
    levels, step = [rank], 1
    size = np.diff(np.r_[heads, n])
    places = np.flatnonzero(np.repeat(size > 1, size))
    while len(places):
        members = order[places]
        after = members + step
        follow = np.where(after < ends[members], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[members] * (n + 2) + follow
        by_key = np.argsort(key, kind="stable")
        members, key = members[by_key], key[by_key]
        order[places] = members
        new = np.r_[True, key[1:] != key[:-1]]
        heads = np.flatnonzero(new)
        rank = rank.copy()
        rank[members] = places[heads[np.cumsum(new) - 1]]
        levels.append(rank)
        size = np.diff(np.r_[heads, len(places)])
        places = places[np.repeat(size > 1, size)]
        step *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Common prefix length of each suffix with the one before it in order; 0 for the first."""
    lcp = np.zeros(len(order), np.int64)
    at = np.flatnonzero(levels[0][order][1:] == levels[0][order][:-1]) + 1 if len(order) else lcp
    left, right = order[at - 1], order[at]
    shift = np.zeros(len(at), np.int64)
    n = len(order)
    for k in range(len(levels) - 1, -1, -1):
        i, j = left + shift, right + shift
        inside = (i < n) & (j < n)
        same = inside & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        shift += np.where(same, 1 << k, 0)
    lcp[at] = shift
    return lcp


def repeats(words: np.ndarray, lengths: np.ndarray, least: int = REPEAT_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """For each text: words inside repeats of ``least`` words or more, and words of the longest repeat.

    ``words`` holds the word numbers of all texts one after the other. The first key of a suffix
    has its text, so nothing repeats across texts. The innermost common-prefix interval that holds
    a suffix has the longest maximal repeat that starts there: the larger of its two common
    prefixes. Union of the spans of all maximal repeats = union of these spans.
    """
    covered, longest = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if not len(words):
        return covered, longest
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    order, levels = suffix_array(text * (int(words.max()) + 1) + words, ends)
    lcp = common_prefixes(order, levels)
    here = np.empty(len(words), np.int64)
    here[order] = np.maximum(lcp, np.r_[lcp[1:], 0])
    np.maximum.at(longest, text, here)
    starts = np.flatnonzero(here >= least)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + here[starts], -1)
    inside = np.cumsum(change[:-1]) > 0
    np.add.at(covered, text, inside)
    return covered, longest


def judge(texts: list[str | None], limits: Limits) -> Columns:
    """Counts and verdict (RESULT) for each text."""
    out: Columns = {f.split()[0]: [] for f in RESULT.split(", ")}
    words, lengths, numbers = [], [], Numbers()
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> None:
        found.append(repeats(np.array(words, dtype=np.int64), np.array(lengths, dtype=np.int64)))
        words.clear()
        lengths.clear()
        numbers.clear()

    for text in texts:
        text = text or ""
        raw = text.encode()
        mine = raw.split()
        lines = [line for line in raw.split(b"\n") if line.strip()]
        out["n_words"].append(len(mine))
        out["word_chars"].append(len(text) - sum(map(text.count, " \t\n\v\f\r")))
        out["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        words.extend(map(numbers.__getitem__, mine))
        lengths.append(len(mine))
        if len(words) >= GROUP_WORDS:
            flush()
    flush()
    out["n_repeat_words"] = np.concatenate([c for c, _ in found]).tolist()
    out["longest_repeat"] = np.concatenate([x for _, x in found]).tolist()
    for n, repeated, longest, symbols in zip(
        out["n_words"], out["n_repeat_words"], out["longest_repeat"], out["n_symbols"], strict=True
    ):
        failed = n < MIN_WORDS or 100 * repeated > 30 * n
        out["base_failed"].append(failed)
        out["kept"].append(not failed and not (
            repeated > limits.repeat_fraction * n or longest > limits.longest_repeat or symbols > limits.symbol_ratio * n
        ))
    return out


def quality(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """``docs`` (with ``text``) and the columns of RESULT, a row for each row.

    Columns of docs with such a name are replaced. A null or empty text has no words and fails.
    Whole texts are judged inside their task, in groups of GROUP_WORDS words.
    """
    limits = limits or Limits()
    own = [f.split()[0] for f in RESULT.replace("\n", "").split(", ")]
    kept = docs.drop(*[c for c in own if c != "text"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            yield {**batch, **judge(batch["text"], limits)}

    return map_batches(kept, run, f"{schema}, {RESULT}")


def op8_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(read(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.drop("text")
