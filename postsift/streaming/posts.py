"""Moderating posts as files of them arrive.

Normalisation, broadcast scoring and fusion are projections, so the batch
plan serves for a stream as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postsift.sources.posts import CSV_OPTIONS, STORY_SCHEMA


def stream_posts(
    spark: SparkSession, folder: str, fmt: str = "parquet", schema=STORY_SCHEMA, **more: str
) -> DataFrame:
    """Posts from the files of a folder; ``more`` are options of the reader."""
    options = (CSV_OPTIONS if fmt == "csv" else {}) | more
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def write_stream(df: DataFrame, folder: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Score what has arrived and stop; run it again for what comes later."""
    return (
        df.writeStream.format(fmt)
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batches(
    df: DataFrame, each: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """As :func:`write_stream`, but what has arrived goes through ``each`` as a
    batch. That allows any plan, such as the join that scores with models too
    large to be broadcast. A batch that is run again writes the same place."""

    def write(batch: DataFrame, number: int) -> None:
        each(batch).write.format(fmt).mode("overwrite").save(f"{folder}/batch={number}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
