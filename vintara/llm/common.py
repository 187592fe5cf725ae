"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vintara.session import scratch_path, write_through

__all__ = ["FINE", "discard", "hashed_sample", "map_batches", "open_folder", "prepare", "read", "remove", "scratch_path", "write_through"]

# Rows of an Arrow batch where a row holds a whole text: a batch of long texts stays small.
FINE = 512
# Bytes of an Arrow batch that Spark sends, and of the part of it that is taken into Python lists at once.
BATCH_BYTES = 8_000_000

Columns = dict[str, list]
Step = Callable[[Iterator[Columns]], Iterator[Columns]]


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers and keep Arrow batches small."""
    _ship(spark.sparkContext.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", FINE)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


@cache
def _ship(application_id: str) -> None:
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix=f"vintara-{application_id}-")) / "vintara_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    SparkSession.active().sparkContext.addPyFile(str(target))


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def map_batches(df: DataFrame, step: Step, schema: str) -> DataFrame:
    """Run ``step`` over each partition; it takes and gives column lists, batch by batch."""
    kind = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        parts = (part for batch in batches for part in bounded(batch))
        columns = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns, strict=True)} for b in parts)
        for out in step(columns):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, kind)


def bounded(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``most`` bytes each, but for single rows that are longer."""
    if batch.nbytes <= most or batch.num_rows == 1:
        yield batch
        return
    half = batch.num_rows // 2
    yield from bounded(batch.slice(0, half), most)
    yield from bounded(batch.slice(half), most)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stored steps that nothing reads any more."""
    for path in map(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*stored: DataFrame) -> None:
    """Delete the files of stored steps (``write_through``) that nothing reads any more."""
    for df in stored:
        remove(df.sparkSession, *{f.rsplit("/", 1)[0] for f in df.inputFiles()})


def hashed_sample(df: DataFrame, keys: list[str], rows: int) -> list[Row]:
    """About ``rows`` rows of ``df`` and no more, those with the smallest hash of ``keys``.

    The share of hashes comes from the number of rows, so that what tasks send to the driver
    stays about ``rows`` rows in all, however many tasks there are.
    """
    n = df.count()
    if not n:
        return []
    share = min(1.0, (1.2 * rows + 20) / n)
    some = df.withColumn("_hash", F.xxhash64(*keys)).where(F.col("_hash") <= F.lit(int(share * 2**64) - 2**63 - 1))
    return sorted(some.collect(), key=lambda r: r["_hash"])[:rows]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or as a URI that Arrow knows."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.removeprefix("file:")
