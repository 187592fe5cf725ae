"""Servicing files as a stream: new monthly files are cleaned as they arrive.

Cleaning needs no state, so the batch projection is applied to each micro-batch unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vintara import schema as S
from vintara.operators.cleaning import clean_servicing
from vintara.sources.loan_files import SERVICING_NAME, row_sequence, year_of_file

# Tasks that a micro-batch is cut into for each core, where its files are large enough.
TASKS_A_CORE = 4
MIN_TASKS = "spark.sql.files.minPartitionNum"


def stream_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings whose file scans are cut finer, unless they say how.

    The next micro-batch waits for the last task of this one. By Spark's own split size a batch
    makes hardly more tasks than there are cores, and most cores wait for its second round.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    if own.conf.get(MIN_TASKS, None) is None:
        own.conf.set(MIN_TASKS, str(TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    return own


def servicing_stream(
    spark: SparkSession, folder: str, name: str = SERVICING_NAME, files_per_batch: int = 64
) -> DataFrame:
    raw = (
        stream_session(spark).readStream.schema(S.text_schema(S.SERVICING_COLUMNS))
        .option("sep", "|")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(f"{folder.rstrip('/')}/{name.format(year='*')}")
    )
    tagged = raw.withColumns({"VINTAGE_YEAR": year_of_file(name), "SPLIT_START": F.col("_metadata.file_block_start")})
    return clean_servicing(tagged)


def append_servicing(
    cleaned: DataFrame, table: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append cleaned rows to a Parquet table partitioned by vintage and micro-batch.

    Each row gets its file position ``ROW_SEQ``, as in a batch read, so that the table serves all
    products. A micro-batch that is run again replaces its own partitions, so a file counts once.
    """

    def write(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("ROW_SEQ", row_sequence(F.col("SPLIT_START"))).drop("SPLIT_START")
        (
            placed.withColumn("MICRO_BATCH", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("VINTAGE_YEAR", "MICRO_BATCH")
            .parquet(table)
        )

    writer = cleaned.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
