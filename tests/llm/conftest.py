import pytest

from tests.llm.helpers import empty, odd, write_tables
from vintara.llm.common import prepare


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def mixed_dir(spark, sf_dir, tmp_path_factory):
    """The given documents and the odd ones, with a column more whose name operators use."""
    from pyspark.sql import functions as F

    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = given.unionByName(odd(spark)).withColumns({"node": F.lit(1), "score": F.lit("x"), "spans": F.lit(0)})
    return write_tables(spark, tmp_path_factory.mktemp("mixed"), both)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    return write_tables(spark, tmp_path_factory.mktemp("empty"), empty(spark), pages)
