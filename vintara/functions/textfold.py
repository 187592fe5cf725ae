"""Short texts as numbers, so that ordered aggregates over text run by hashing.

Spark aggregates by hashing only where the buffer of an aggregate has a fixed width; a text in a
buffer turns the whole aggregation into a sort of its input. Up to seven bytes of a text fit into
one long, below a leading one that keeps empty texts and zero bytes apart; longer texts take
several longs. A text of null is null in all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES_A_WORD = 7
# Texts longer than this many words are folded as texts, by sorting.
MOST_WORDS = 4

Fold = Callable[[Column], Column]


def words_needed(rows: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Words that the longest text of each column takes, at least one: a scan of these columns only."""
    if not names:
        return {}
    longest = rows.agg(*[F.max(F.octet_length(n)).alias(n) for n in names]).first()
    return {n: max(1, -(-(longest[n] or 0) // BYTES_A_WORD)) for n in names}


def packed(text: Column, words: int) -> list[Column]:
    """The text as ``words`` longs; one that needs more fails the job rather than lose its end."""
    octets = text.cast("binary")
    fits = F.octet_length(octets) <= words * BYTES_A_WORD
    checked = F.when(fits, octets).when(
        octets.isNotNull(), F.raise_error(F.lit(f"a text takes more than {words} words")).cast("binary")
    )
    parts = [F.substring(checked, k * BYTES_A_WORD + 1, BYTES_A_WORD) for k in range(words)]
    return [F.conv(F.concat(F.lit("1"), F.hex(p)), 16, 10).cast("long") for p in parts]


def unpacked(parts: Sequence[Column]) -> Column:
    """The text of the longs of ``packed``."""
    octets = [F.unhex(F.substring(F.hex(p), 2, 2 * BYTES_A_WORD)) for p in parts]
    return F.concat(*octets).cast("string")


class TextFolds:
    """Ordered aggregates of the text columns of one frame.

    ``prepare`` adds the numbers of each text column, ``fold`` makes the aggregates of one column,
    and ``finish`` gives the column back after the aggregation. All numbers of a text are folded
    by the same order, so they come from the same row. Columns that are not texts, and texts of
    more than ``MOST_WORDS`` words, are folded as they are.
    """

    def __init__(self, rows: DataFrame, names: Sequence[str]):
        kinds = dict(rows.dtypes)
        needed = words_needed(rows, [n for n in names if kinds.get(n) == "string"])
        self._words = {n: k for n, k in needed.items() if k <= MOST_WORDS}

    def _parts(self, name: str) -> list[str]:
        return [f"_text_{name}_{k}" for k in range(self._words[name])]

    def prepare(self, rows: DataFrame) -> DataFrame:
        numbers = {
            part: number
            for name, words in self._words.items()
            for part, number in zip(self._parts(name), packed(F.col(name), words), strict=True)
        }
        return rows.withColumns(numbers) if numbers else rows

    def names(self, alias: str, name: str) -> list[str]:
        """Names of the aggregates that ``fold`` makes of column ``name``."""
        words = self._words.get(name)
        return [alias] if words is None else [f"{alias}_{k}_of_text" for k in range(words)]

    def fold(self, name: str, fold: Fold, alias: str | None = None) -> list[Column]:
        """``fold`` of the column, or of each of its numbers, named for ``finish``."""
        columns = self._parts(name) if name in self._words else [name]
        return [fold(F.col(c)).alias(a) for c, a in zip(columns, self.names(alias or name, name), strict=True)]

    def finish(self, name: str, alias: str | None = None) -> Column:
        """The column again, from its aggregates."""
        alias = alias or name
        parts = [F.col(c) for c in self.names(alias, name)]
        return unpacked(parts).alias(alias) if name in self._words else parts[0]
