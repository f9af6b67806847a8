"""Incremental ingest as a stream: what was processed before is skipped by the stream's own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, folder: str, schema: str, transform: Callable[[DataFrame], DataFrame], out: str, state: str) -> StreamingQuery:
    """Process the Parquet files of ``folder`` that are new since the last run, then stop.

    ``state`` is the checkpoint folder; a restart after a failure repeats no file.
    """
    new = spark.readStream.schema(schema).parquet(folder)
    return transform(new).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
