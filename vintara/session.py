"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. forceOptimizeSkewedJoin lets AQE split a hot
# loan in a shuffle join even when that costs one more (pre-aggregated) exchange. The method
# limit is the JIT's own: a fused stage above 8000 bytes of bytecode would run interpreted, and
# the wide cleaning projections are several times faster as separately compiled stages.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a temporary folder, removed at its end: a
    machine-local path would be lost with its executor on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"vintara-{application_id}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage durably: a lost executor re-reads files instead of recomputing the plan, and
    every reader sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_a_task_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings whose file scans read one file a task, unless it is very large."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    # Opening a file is counted as a whole split, so that no second file fits beside it.
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.unset("spark.sql.files.minPartitionNum")
    return own


def together(spark: SparkSession, *steps: Callable) -> list:
    """Results of steps that need nothing of each other, run at one time.

    Jobs of one step take the cores that the other leaves idle between its own jobs and in their
    last tasks.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]
