"""Streaming sample preparation.

Preparation is narrow and keeps no state, so a stream of conversations runs
through the batch plan as it is: no watermark, append mode, Parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..options import PrepOptions
from ..plans.prepare import prepare_samples


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Folder for a query's progress under the session's shared checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    return f"{root.rstrip('/')}/{name}"


def prepare_stream(
    stream: DataFrame,
    path: str,
    name: str,
    opts: PrepOptions = PrepOptions(),
    keep: tuple[str, ...] = ("conv_id",),
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Write the samples of all conversations available now as Parquet and stop."""
    location = checkpoint or checkpoint_location(stream.sparkSession, name)
    return (
        prepare_samples(stream, opts, keep)
        .writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
