"""Incremental translation memory: each micro-batch adds only segments that aren't known yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import extract, memory
from ..sources.readers import MEMORY


def follow(stream: DataFrame, path: str, engines: list, checkpoint: str) -> StreamingQuery:
    """stream(file, text, lang) -> records under path/batch=N; a repeated batch overwrites its own folder.

    A batch reads the folders of earlier batches only, so it never reads what it writes.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], MEMORY).write.mode("overwrite").parquet(f"{path}/batch=-1")  # the memory exists before the first batch

    def step(batch: DataFrame, number: int) -> None:
        known = spark.read.schema(MEMORY + ", batch bigint").parquet(path).where(f"batch < {number}")
        new = memory.pending(memory.distinct_segments(extract.extract(batch)), known)
        memory.chain(new, engines).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
