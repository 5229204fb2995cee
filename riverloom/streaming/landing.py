"""Incremental append of fragment files from a landing folder: the idempotent index append as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.corpus import new_rows
from ..schemas import FRAGMENT


def append_new(batch: DataFrame, target: str) -> None:
    """Rows of a batch whose chunk_id the target lacks; a batch seen before adds nothing."""
    spark = batch.sparkSession
    fresh = batch.where("chunk_id is not null").dropDuplicates(["chunk_id"])
    try:
        fresh = new_rows(fresh, spark.read.parquet(target))
    except Exception as e:  # the first batch finds no target
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    fresh.write.mode("append").parquet(target)


def land(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Take in every new JSON Lines file of ``folder`` and end; run again for those that came since."""
    stream = spark.readStream.schema(FRAGMENT).json(folder)
    return stream.writeStream.foreachBatch(lambda b, _: append_new(b, target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
