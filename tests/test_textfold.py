"""Texts folded as numbers."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import by_key
from vintara.functions.textfold import MOST_WORDS, TextFolds, packed, unpacked, words_needed

TEXTS = [None, "", "0", "01", " 3 ", "\x00", "\x00\x00a", "sevenby", "eightbyt", "ünïcödé ÿ", "x" * 28, "日本語のテキスト"]


def test_every_text_comes_back(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string")
    words = words_needed(rows, ["t"])["t"]
    assert words == 4
    back = rows.select("t", unpacked(packed(F.col("t"), words)).alias("u")).collect()
    assert all(r["t"] == r["u"] for r in back)


def test_a_text_over_the_width_fails(spark):
    rows = spark.createDataFrame([("eightbyt",)], "t string")
    with pytest.raises(Exception, match="takes more than 1 words"):
        rows.select(packed(F.col("t"), 1)[0]).collect()


@pytest.mark.parametrize("longest", [3, 20, 7 * MOST_WORDS + 1, 500])
def test_last_text_of_a_group(spark, longest):
    """Texts of any length, ties of nothing, groups of nulls only; beyond the words by sorting."""
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y" * longest), ("a", 3, None), ("b", 1, None), ("c", 1, "")], "g string, k int, t string"
    )
    texts = TextFolds(rows, ["t", "k", "missing"])
    assert ("SortAggregate" in _fold(rows, texts)._jdf.queryExecution().executedPlan().toString()) == (longest > 7 * MOST_WORDS)
    found = by_key(_fold(rows, texts), "g")
    assert (found["a"]["t"], found["b"]["t"], found["c"]["t"]) == ("y" * longest, None, "")
    assert found["a"]["k"] == 2


def _fold(rows, texts):
    def last(value):
        return F.max_by(value, F.when(F.col("t").isNotNull(), F.col("k")))

    folded = texts.prepare(rows).groupBy("g").agg(*[c for n in ("t", "k") for c in texts.fold(n, last)])
    return folded.select("g", texts.finish("t"), texts.finish("k"))


def test_empty_table(spark):
    rows = spark.createDataFrame([], "g string, k int, t string")
    assert _fold(rows, TextFolds(rows, ["t"])).collect() == []
