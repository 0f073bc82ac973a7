"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from weft.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the cluster shares (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/weft-llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    It cuts the lineage like ``checkpoint()``, but computes the plan once
    where an eager checkpoint computes it twice.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 1024


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def training_row(id_col: str, modulus: int, held: int) -> Column:
    """False for rows whose crc32(id as text) mod ``modulus`` is ``held``; a null id trains."""
    return ~F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == held, F.lit(False))


def map_columns(df: DataFrame, columns: list[Column], fn: Callable[[list[list]], list], schema: str) -> DataFrame:
    """Run ``fn`` over Arrow batches of ``columns``: lists in, one list per output field out."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = fn([c.to_pylist() for c in batch.slice(at, SLICE).columns])
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, arrow)], schema=arrow)
        give_back()

    return df.select(*columns).mapInArrow(run, schema)
