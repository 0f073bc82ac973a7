"""SimHash near-duplicates through a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import map_columns, materialise
from weft.llm.components import connected_components

BYTES = 8
#: Runs up to this many fingerprints are compared row against shifted row; longer ones by a search from node to node.
SHORT_RUN = 48


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text (as a signed integer).

    Words are runs without ASCII white space, A-Z in lower case.  Each shingle's
    XXH64 (seed 42) votes on each bit; a bit is 1 if over half of them set it.
    Fewer words than ``shingle`` make one shingle; none (or null) gives 0.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        votes = [xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        votes = [xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    count, raw = np.zeros(64, np.int64), np.array(votes, "<u8").view(np.uint8).reshape(-1, BYTES)
    for at in range(0, len(raw), 1 << 16):
        count += np.unpackbits(raw[at:at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * count > len(votes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                      row_col: str | None = None) -> DataFrame:
    """``(doc_id, fp, row)`` for every row; ``row`` is ``row_col`` or null."""
    row = F.col(row_col) if row_col else F.lit(None)
    return map_columns(docs, [F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t"), row.cast("long").alias("r")],
                       lambda c: [c[0], [fingerprint(t, shingle) for t in c[1]], c[2]], "doc_id long, fp long, row long")


def _byte(position: int):
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))


def index_keys(nodes: DataFrame, max_bits: int, key_bytes: int) -> DataFrame:
    """Postings ``(key, fp, node)``: a row for each choice of ``key_bytes`` byte positions.

    Two fingerprints that differ in ``max_bits`` bits agree in 8 - max_bits
    bytes at least, hence in ``key_bytes`` of the first
    ``max_bits + key_bytes`` positions: some posting list holds both.
    """
    if not 0 < key_bytes <= BYTES - max_bits:
        raise ValueError("key_bytes must lie between 1 and 8 - max_bits")
    keys = []
    for number, chosen in enumerate(combinations(range(max_bits + key_bytes), key_bytes)):
        key = F.lit(number).cast("long")
        for p in chosen:
            key = F.shiftleft(key, 8).bitwiseOR(_byte(p))
        keys.append(key)
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp", "node")


def _links(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Which XORed fingerprints link: count filter on equal bytes, then the bits."""
    alike = (x[..., None].view(np.uint8) == 0).sum(axis=-1) >= BYTES - max_bits
    out = np.zeros(x.shape, bool)
    out[alike] = np.bitwise_count(x[alike]) <= max_bits
    return out


def _forest(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect one long posting list as all its links do: each row is searched from once."""
    a, b, rest = [], [], np.arange(1, len(fp))
    front = np.array([0])
    while len(rest):
        found = []
        for i in range(0, len(front), 64):
            hit = _links(fp[front[i:i + 64], None] ^ fp[None, rest], max_bits)
            new = hit.any(axis=0)
            a.append(front[i:i + 64][hit[:, new].argmax(axis=0)])
            b.append(rest[new])
            found.append(rest[new])
            rest = rest[~new]
            if not len(rest):
                break
        front = np.concatenate(found) if found else front[:0]
        if not len(front) and len(rest):
            front, rest = rest[:1], rest[1:]
    return (np.concatenate(a), np.concatenate(b)) if a else (front[:0], front[:0])


def _run_links(key: np.ndarray, fp: np.ndarray, node: np.ndarray, max_bits: int):
    """Links among rows sorted by key, for whole runs of equal keys."""
    edges = []
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    length = np.diff(np.append(start, len(key)))
    for s, n in zip(start[length > SHORT_RUN], length[length > SHORT_RUN]):
        a, b = _forest(fp[s:s + n], max_bits)
        edges.append((node[s:s + n][a], node[s:s + n][b]))
    short = np.repeat(length <= SHORT_RUN, length)
    key, fp, node = key[short], fp[short], node[short]
    for shift in range(1, SHORT_RUN):
        at = np.flatnonzero(key[shift:] == key[:-shift])
        if not len(at):
            break
        at = at[_links(fp[at] ^ fp[at + shift], max_bits)]
        edges.append((node[at], node[at + shift]))
    return edges


def links(nodes: DataFrame, max_bits: int = 4, key_bytes: int = 3, chunk: int = 4096) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints as all pairs within ``max_bits`` do.

    Posting lists over ``chunk`` rows are cut into chunks and every pair of
    chunks becomes a list of its own, so that none grows with the data.
    """
    posts = index_keys(nodes, max_bits, key_bytes)
    hot = (posts.groupBy("key").count().where(F.col("count") > chunk)
           .select("key", F.ceil(F.col("count") / chunk).cast("int").alias("cuts")))
    cut = posts.join(hot, "key", "left").withColumn("c", F.pmod(F.xxhash64("fp"), F.coalesce("cuts", F.lit(1))).cast("int"))
    cells = F.when(F.col("cuts").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("cuts") - 1),
                    lambda o: F.least(F.col("c"), o) * F.col("cuts") + F.greatest(F.col("c"), o)))
    rows = cut.select("key", F.explode(cells).alias("cell"), "fp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def out(part):
            key = np.unique(np.stack([part[0], part[1]], 1), axis=0, return_inverse=True)[1].reshape(-1)
            found = _run_links(key, part[2].view(np.uint64), part[3], max_bits)
            if found:
                ends = np.unique(np.stack([np.concatenate([f[i] for f in found]) for i in (0, 1)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=schema)

        for batch in batches:
            now = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            kept = now if kept is None else np.concatenate([kept, now], axis=1)
            if not kept.shape[1]:
                continue
            same = (kept[0] == kept[0, -1]) & (kept[1] == kept[1, -1])  # the last run may go on in the next batch
            if not same.all():
                cut_at = kept.shape[1] - int(same.sum())
                yield from out(kept[:, :cut_at])
                kept = kept[:, cut_at:]
        if kept is not None and kept.shape[1]:
            yield from out(kept)

    return rows.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp").mapInArrow(run, "a long, b long")


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, key_bytes: int, chunk: int,
            row_col: str | None) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, fp, row)`` and ``(fp, group, least)``: each fingerprint's least reachable one and its least id.

    Fingerprints themselves are the nodes, so that ids may repeat or be null.
    """
    marked = materialise(with_fingerprints(docs, id_col, text_col, shingle, row_col), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("node", F.col("fp"))
    known = materialise(nodes, "nodes")
    label = connected_components(links(known, max_bits, key_bytes, chunk))
    return marked, known.join(label, "node", "left").select("fp", F.coalesce("component", "fp").alias("group"), "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, key_bytes: int = 3, chunk: int = 4096, row_col: str | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row (and ``row_col``, a number, if one is named).

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  Equal fingerprints collapse to one node before
    the index, so copies cost a row in an aggregate.  Null or word-less texts
    have fingerprint zero and link like any other.  Rows with a null id link
    too (their component is null if it holds no other row).  Texts that share
    an id are separate nodes.  Repeated rows come back as often as they came.
    Other columns are ignored.
    """
    marked, of = _groups(docs, id_col, text_col, shingle, max_bits, key_bytes, chunk, row_col)
    # only groups of several fingerprints need the join back
    of = materialise(of, "groups")
    many = of.groupBy("group").agg(F.min("least").alias("component_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    of = of.join(many, "group", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return (marked.join(of, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                    *([F.col("row").alias(row_col)] if row_col else [])))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each group of near-duplicates, columns unchanged.

    It is the one with the smallest id (null last); of rows with that id, any
    one.  Rows are numbered and written first, so that ids may repeat.
    """
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    marked, of = _groups(rows, "doc_id", "text", shingle, max_bits, 3, 4096, "__row")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    kept = marked.join(of, "fp").groupBy("group").agg(F.min_by("row", first).alias("__row"))
    return rows.join(kept.select("__row"), "__row", "left_semi").select(*docs.columns)
