"""Small documents and plain versions of the operators."""

from __future__ import annotations

import duckdb

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls in any column, empty and blank texts, ties, repeated rows, and words of any script.
ODD = [
    (100_000, None, None, None, None),
    (100_001, "", "en", "s", 0),
    (100_002, " \n\t", None, "s", 3),
    (100_003, "one two three", "en", None, 13),
    (100_003, "one two three", "en", None, 13),
    (100_004, "Éa ñ ß 漢字 mixed 𝒳 words", "fr", "s", 24),
    (100_005, "x", "de", "s", 1),
    (None, "a text without a number in its row", "en", "s", 34),
    (None, None, None, None, None),
    (100_006, "12345 $$$ 67 !!", "en", "s", 15),
    (100_007, "word " * 9_000, "en", "s", 45_000),
    (100_008, "y" * 40_000, "en", "s", 40_000),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(sf_dir: str, name: str, columns: str) -> list[tuple]:
    return duckdb.sql(f"select {columns} from '{sf_dir}/{name}.parquet'").fetchall()


def write_tables(spark, folder, documents=None, pages=None):
    """A data folder whose documents or pages are the given frames."""
    if documents is not None:
        documents.write.parquet(f"{folder}/documents.parquet")
    if pages is not None:
        pages.write.parquet(f"{folder}/pages.parquet")
    return str(folder)
