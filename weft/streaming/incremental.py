"""Incremental preparation of arriving corpus files with Structured Streaming.

The reference has no streaming operators.  Its row-local operators (schema
alignment, prompt rendering, cleaning, tokenisation, truncation) are pure
column expressions, so the same functions apply unchanged to a streaming
DataFrame; this module wires them to a file source and a parquet sink with
a checkpoint on shared storage, so new files are prepared exactly once.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weft.session import checkpoint_dir, ensure_checkpoint_dir


def read_jsonl_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON Lines files arriving under ``path`` (schema required for streams)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def prepare_stream(spark: SparkSession, source: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str,
                   name: str = "weft_prepare", checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Apply a row-local ``transform`` to a streaming source and append the
    result as parquet.  The checkpoint lives under the session's shared
    checkpoint folder unless given."""
    if not source.isStreaming:
        raise ValueError("source must be a streaming DataFrame")
    ensure_checkpoint_dir(spark)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)
    w = (transform(source).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
