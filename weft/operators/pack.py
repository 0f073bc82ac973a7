"""Packing token streams into fixed blocks (T5, T6) and re-batching.

Packing never gathers a group's tokens into one row or one task:

1. texts are put in order, tokenised once and written as ids with their count;
2. each document gets its exclusive token offset inside its pack group from
   the counts (running sums inside chunks of rows, and per-chunk totals), so
   even a group holding a third of all rows is spread over many tasks;
3. each document emits one slice per block it overlaps;
4. ``groupBy(group, block)`` reassembles a block from its (at most
   block-size) pieces in offset order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER
from weft.operators.split import ordered_rows


def running_sums(df: DataFrame, group: str, order: str, cols: dict[str, str], chunk: int = 4096,
                 derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Exclusive running sums of several columns within ``group`` in
    ``order``: ``cols`` maps input column -> output column (``derive`` may add
    the input columns, see :func:`ordered_rows`).

    Rows are written in order (sparse, float or null orders and one huge group
    are all alike) and cut into chunks of ``chunk`` places.  A window runs
    inside each chunk and group.  Only the group that a chunk begins with can
    have rows in earlier chunks; its sum so far (from per-chunk totals, read
    from the narrow columns alone) is joined on the chunk, which the rows are
    already partitioned by."""
    d = ordered_rows(df, [group, order], derive).withColumn("_chunk", F.floor(F.col("_mid") / chunk))
    totals = d.groupBy("_chunk", group).agg(*[F.sum(c).alias(f"_s_{o}") for c, o in cols.items()])
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select(F.col("_chunk").alias("_c"), F.col(group).alias("_g"), F.count(F.lit(1)).over(before).alias("_earlier"),
                          *[F.sum(f"_s_{o}").over(before).alias(f"_s_{o}") for o in cols.values()]).where(F.col("_earlier") > 0)
    d = d.repartition("_chunk")
    inside = Window.partitionBy("_chunk", group).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    for c, o in cols.items():
        d = d.withColumn(o, F.coalesce(F.sum(c).over(inside), F.lit(0)))
    d = d.join(start, F.col("_chunk") == F.col("_c"), "left")   # at most one row a chunk
    for o in cols.values():
        carried = F.when(F.col(group).eqNullSafe(F.col("_g")) & F.col("_c").isNotNull(), F.col(f"_s_{o}"))
        d = d.withColumn(o, F.col(o) + F.coalesce(carried, F.lit(0)))
    return d.drop("_mid", "_chunk", "_c", "_g", "_earlier", *[f"_s_{o}" for o in cols.values()])


def running_offset(df: DataFrame, group: str, order: str, length: str, chunk: int = 4096,
                   out: str = "offset", cast: str | None = "bigint") -> DataFrame:
    """Exclusive running sum of ``length`` (see :func:`running_sums`)."""
    d = running_sums(df, group, order, {length: out}, chunk)
    return d.withColumn(out, F.col(out).cast(cast)) if cast else d


def _pieces(df: DataFrame, group: str, order: str, text: str, block: int, chunk: int,
            tokenizer, add_special: bool) -> DataFrame:
    """Offsets are running sums of token counts; one slice per overlapped
    block, built directly by ``transform`` (a document's id array is never
    copied per block)."""
    def tokenised(d: DataFrame) -> DataFrame:
        return d.withColumn("_ids", tokenizer.ids(F.col("_text"), add_special)).withColumn("_len", F.size("_ids")).drop("_text")

    d = df.select(group, order, F.col(text).alias("_text"))
    d = running_sums(d, group, order, {"_len": "offset"}, chunk, tokenised).where(F.col("_len") > 0)
    off, n = F.col("offset"), F.col("_len")
    blocks = F.sequence(F.floor(off / block), F.floor((off + n - 1) / block))

    def piece(b):
        s = F.greatest(off, b * block)
        e = F.least(off + n, (b + 1) * block)
        return F.struct(b.alias("block"), (s - b * block).alias("pos"),
                        F.slice(F.col("_ids"), (s - off + 1).cast("int"), (e - s).cast("int")).alias("piece"))

    return d.select(group, F.explode(F.transform(blocks, piece)).alias("_p")).select(group, "_p.block", "_p.pos", "_p.piece")


def _assemble(pieces: DataFrame, group: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return pieces.groupBy(group, "block").agg(F.flatten(F.transform(parts, lambda x: x["piece"])).alias("ids"))


def pack_pretrain(df: DataFrame, max_source: int, group: str = "pack_group", order: str = "doc_id",
                  text: str = "text", tokenizer=DEFAULT_TOKENIZER, chunk: int = 4096) -> DataFrame:
    """T5: concatenate the token lists of a group in ``order``, cut into
    blocks of ``max_source - 1``, drop the remainder, prepend bos; labels = ids."""
    b = max_source - 1
    blocks = _assemble(_pieces(df, group, order, text, b, chunk, tokenizer, False), group).where(F.size("ids") == b)
    ids = F.concat(F.array(F.lit(tokenizer.bos_id)), F.col("ids"))
    return blocks.select(group, "block", ids.alias("input_ids"), ids.alias("labels"))


def group_texts(df: DataFrame, block_size: int, group: str = "pack_group", order: str = "doc_id",
                text: str | None = None, tokenizer=DEFAULT_TOKENIZER, chunk: int = 4096) -> DataFrame:
    """As T5 without bos and with ``block_size``; a group shorter than one
    block keeps its single short block.  Text column: ``text`` if present,
    else the first column.  Documents are encoded with specials, as the
    reference's tokenizer call does."""
    col = text or ("text" if "text" in df.columns else df.columns[0])
    blocks = _assemble(_pieces(df, group, order, col, block_size, chunk, tokenizer, True), group)
    blocks = blocks.where((F.size("ids") == block_size) | (F.col("block") == 0))
    return blocks.select(group, "block", F.col("ids").alias("input_ids"),
                         F.transform("ids", lambda _: F.lit(1)).alias("attention_mask"), F.col("ids").alias("labels"))


def rebatch(df: DataFrame, large_batch: str, pos: str, max_size: int, small_batch_size: int,
            n_large: int) -> DataFrame:
    """Buffer ``max_size`` large batches, then emit slices of
    ``small_batch_size`` rows of each; a trailing partial buffer is never
    emitted.  ``large_batch`` ids are dense 0..n_large-1 and ``pos`` is the
    0-based row position inside the large batch."""
    complete = (n_large // max_size) * max_size
    return (df.where(F.col(large_batch) < complete)
              .withColumn("buffer", F.floor(F.col(large_batch) / max_size).cast("bigint"))
              .withColumn("small_batch", F.floor(F.col(pos) / small_batch_size).cast("bigint")))
