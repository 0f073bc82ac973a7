"""Blocks of documents, and byte-column messages between blocks and shards.

Texts are packed once, as compressed blocks in the shared folder.  A block
sends sorted columns to shards; a shard answers in the order of the question,
so that an answer needs no keys.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from weft.llm.common import materialise

U = np.uint64
LAST = np.iinfo(np.int64).max
MESSAGE = "block string, shard long, body binary"
ARROW_MESSAGE = pa.schema([("block", pa.string()), ("shard", pa.int64()), ("body", pa.binary())])


def pack(*columns: np.ndarray) -> bytes:
    """Unsigned columns of one length, byte plane after byte plane, so that empty high bytes cost nothing."""
    planes = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(len(columns[0]).to_bytes(8, "little") + b"".join(planes))


def unpack(body: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int.from_bytes(raw[:8], "little")
    if not n:
        return [np.zeros(0, U)] * 8
    return [np.ascontiguousarray(p.T).view("<u8").reshape(-1) for p in np.frombuffer(raw, np.uint8, offset=8).reshape(-1, 8, n)]


def steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=U(0))


def runs(sorted_shards: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each shard of a sorted column, and where it stands."""
    cuts = np.flatnonzero(np.diff(sorted_shards)) + 1
    starts = [0, *cuts.tolist()] if len(sorted_shards) else []
    for a, b in zip(starts, [*starts[1:], len(sorted_shards)]):
        yield int(sorted_shards[a]), slice(a, b)


def run_of(sorted_shards: np.ndarray, shard: int) -> slice:
    """Where one shard stands in a sorted column."""
    a, b = np.searchsorted(sorted_shards, np.array([shard, shard + 1], sorted_shards.dtype))
    return slice(int(a), int(b))


def mix(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _pack_rows(schema: pa.Schema, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = (np.cumsum(size) - size) // block_bytes
            cuts = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts, cuts[1:]):
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, schema) as out:
                    out.write_batch(pa.RecordBatch.from_arrays(batch.slice(a, b - a).columns, schema=schema))
                body = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
                yield pa.RecordBatch.from_arrays([[uuid.uuid4().hex], [int(size[a:b].sum())], [body]], ["block", "size", "body"])

    return run


def pack_documents(docs: DataFrame, id_col: str, text_col: str, carry: list[Column], block_bytes: int) -> tuple[DataFrame, int]:
    """``(block, size, body)`` in the shared folder, and the texts' bytes; ``carry`` columns follow id and text in a block."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
                       *[c.alias(f"c{i}") for i, c in enumerate(carry)])
    schema = to_arrow_schema(StructType(rows.schema.fields))
    packed = materialise(rows.mapInArrow(_pack_rows(schema, block_bytes), "block string, size long, body binary"), "blocks")
    return packed, packed.agg(F.sum("size")).first()[0] or 0


def read_block(body: bytes) -> tuple[pa.Table, list[bytes], np.ndarray]:
    """A block's rows, its texts and ids; a null text is empty, a null id comes after all others."""
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all()
    ids = table.column(0).fill_null(LAST).to_numpy()
    return table, [t or b"" for t in table.column(1).to_pylist()], ids


def to_batches(messages) -> Iterator[pa.RecordBatch]:
    for block, shard, body in messages:
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([shard], pa.int64()), pa.array([body], pa.binary())], schema=ARROW_MESSAGE)
