"""Files that arrive in a folder, taken in by a stream: each row is in the sink once, whatever was stopped between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "_batch"


def take_in(spark: SparkSession, folder: str, schema: str, sink: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | None = None, kind: str = "parquet", files: int | None = None, forever: bool = False):
    """Run ``work`` on what has arrived in ``folder`` since the last time, and add it to ``sink``.

    The checkpoint says which files belong to which batch before a batch is worked on; a batch writes a folder of its own over
    whatever it left there before.  So one that was stopped after its write and before its commit is written again with the
    same rows, and none is lost or there twice.  ``files``: so many new files a batch at most.  Without ``forever`` the
    stream ends when all that is there has been taken in.
    """
    reader = spark.readStream.schema(schema).format(kind)
    arrived = (reader.option("maxFilesPerTrigger", files) if files else reader).load(folder)

    def write(rows: DataFrame, batch: int) -> None:
        (work(rows) if work else rows).write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch}")

    started = arrived.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = (started if forever else started.trigger(availableNow=True)).start()
    if not forever:
        query.awaitTermination()
    return query


def taken(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """All rows of the sink, with the number of the ``batch`` they came in."""
    rows = spark.read.schema(f"{schema}, {BATCH} LONG").parquet(sink)
    return rows.withColumn("batch", F.col(BATCH)).drop(BATCH)
