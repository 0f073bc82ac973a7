"""Approximate nearest neighbours by cross-polytope hashing with multiprobe and exact reranking."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import map_columns, materialise


@dataclass(frozen=True)
class Plan:
    """Tables, probes a table and query, neighbours, the seed of the rotations, rows in a cell's block, norm
    bands an octave, and the factor by which probes grow with ``k``'s share of a band's rows."""

    tables: int = 16
    probes: int = 8
    k: int = 20
    seed: int = 7
    block: int = 8192
    bands: int = 4
    spread: int = 25


#: The most that probes grow.
MOST = 16


def _transform(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row (a power of two long), orthonormal."""
    rows, n = x.shape
    size = 1
    while size < n:
        x = x.reshape(rows, -1, 2, size)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, n)
        size *= 2
    return x / np.sqrt(n)


def rotations(vectors: np.ndarray, plan: Plan):
    """Each table's pseudo-rotation (three rounds of random signs and a Hadamard transform) of the unit vectors."""
    dim = vectors.shape[1]
    wide = 1 << max(1, (dim - 1).bit_length())
    scale = np.abs(vectors).max(axis=1, keepdims=True)  # before the norm, against overflow
    unit = vectors / scale
    unit = np.pad(unit / np.linalg.norm(unit, axis=1, keepdims=True), ((0, 0), (0, wide - dim)))
    signs = np.random.default_rng([plan.seed, wide]).choice([-1.0, 1.0], size=(plan.tables, 3, wide))
    for table in signs:
        x = unit
        for s in table:
            x = _transform(x * s)
        yield x


def norm_bands(vectors: np.ndarray, plan: Plan) -> np.ndarray:
    """Each row's band: its norm's logarithm, rounded down (halfway bounds keep unit norms off the edges)."""
    scale = np.abs(vectors).max(axis=1)
    norm = np.log2(scale) + np.log2(np.linalg.norm(vectors / scale[:, None], axis=1))
    return np.floor(norm * plan.bands + 0.5).astype(np.int64)


def nearest_axes(x: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` signed axes (all, if fewer) next to each row, nearest first: 2i for +i, 2i + 1 for -i."""
    along = np.empty((len(x), 2 * x.shape[1]))
    along[:, 0::2], along[:, 1::2] = x, -x
    return np.argsort(-along, axis=1, kind="stable")[:, :count]


def _hash_rows(plan: Plan):
    def run(columns):
        number, ids, vectors, query = columns
        codes: list = [None] * len(ids)
        probes: list = [None] * len(ids)
        band: list = [0] * len(ids)
        by_dim: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_dim.setdefault(len(v), []).append(i)
        for at in by_dim.values():
            x = np.array([vectors[i] for i in at], np.float64)
            ask = np.flatnonzero([query[i] for i in at])
            found, asked = [], []
            for r in rotations(x, plan):
                found.append(nearest_axes(r, 1)[:, 0])
                asked.append(nearest_axes(r[ask], MOST * plan.probes))
            for i, c, b in zip(at, np.stack(found, 1).tolist(), norm_bands(x, plan).tolist()):
                codes[i], band[i] = c, b
            for i, p in zip(ask, np.stack(asked, 1).tolist()):
                probes[at[i]] = p
        return [number, ids, vectors, codes, probes, band]

    return run


def _valid(vector: str) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def _matrix(table: pa.Table, name: str, *shape: int) -> np.ndarray:
    """A nested list column, all lists of a level alike long, as an array of one row a row."""
    column = table.column(name).combine_chunks()
    while pa.types.is_list(column.type):
        column = column.flatten()
    return column.to_numpy(zero_copy_only=False).reshape(table.num_rows, *shape, -1)


def _double(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # beyond the largest double: infinite, and ranked so
        return x.astype(np.float64, copy=False)


def _rerank(plan: Plan):
    """One cell: exact scores of its rows for its queries, the best ``k`` of each.

    A pair that an earlier table finds too is left to that table: a row among
    a query's best is among the best of every cell that holds it.
    """
    empty = pa.schema([("qn", pa.int64()), ("query_id", pa.int64()), ("rn", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return empty.empty_table()
        table = rows.column("tab")[0].as_py()
        x = _matrix(rows, "vec").astype(np.float64)
        codes = _matrix(rows, "codes")
        ids, number = rows.column("id").to_numpy(), rows.column("n").to_numpy()
        all_q = _matrix(queries, "vec").astype(np.float64)
        all_p = _matrix(queries, "probes", plan.tables) if table >= 0 else None
        q_ids, q_number = queries.column("id").to_numpy(), queries.column("n").to_numpy()
        axes = int(max(codes.max(), all_p.max() if all_p is not None else 0)) + 1
        if float(np.abs(all_q).max()) * float(np.abs(x).max()) * x.shape[1] > 1e300:  # products would overflow on the way
            all_q, x = all_q.astype(np.longdouble), x.astype(np.longdouble)
        out = []
        for a in range(0, len(all_q), 256):
            q = all_q[a:a + 256]
            score = _double(q @ x.T)
            skip = q_number[a:a + 256, None] == number[None, :]
            if table > 0:
                probed = np.zeros((len(q), table, axes), bool)
                np.put_along_axis(probed, all_p[a:a + 256, :table], True, axis=2)
                for t in range(table):
                    skip |= probed[:, t][:, codes[:, t]]
            score[skip] = -np.inf
            k = min(plan.k, len(x))
            last = np.partition(score, len(x) - k, axis=1)[:, len(x) - k]
            slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(last), last, 0)))  # sums in another order differ by less
            i, j = np.nonzero((score >= (last - slack)[:, None]) & ~skip)
            exact = _double((q[i] * x[j]).sum(axis=1))
            order = np.lexsort((number[j], ids[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            i, j, exact = (v[place < plan.k] for v in (i, j, exact))
            out.append((q_number[a + i], q_ids[a + i], number[j], ids[j], exact))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=empty)

    return run


def _search(rows: DataFrame, queries: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of the best from cells ``(dim, band, tab, cell)``, each cut into blocks of rows and of queries.

    The counts that cut them have a row a cell: bands x tables x 2 x dimension.
    """
    cell = ["dim", "band", "tab", "cell"]
    cuts = (rows.groupBy(*cell).count().withColumnRenamed("count", "r").join(queries.groupBy(*cell).count(), cell)
            .select(*cell, F.ceil(F.col("r") / plan.block).cast("int").alias("rb"), F.ceil(F.col("count") / plan.block).cast("int").alias("qb")))
    own = F.pmod(F.xxhash64("n"), F.col("rb")).cast("int"), F.pmod(F.xxhash64("n"), F.col("qb")).cast("int")
    every = [F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("rb", "qb")]
    left = rows.join(F.broadcast(cuts), cell).withColumn("rs", own[0]).withColumn("qs", every[1])
    right = queries.join(F.broadcast(cuts), cell).withColumn("qs", own[1]).withColumn("rs", every[0])
    keys = [*cell, "rs", "qs"]
    return (left.select(*keys, "n", "id", "vec", "codes").groupBy(*keys)
            .cogroup(right.select(*[F.col(c).alias(c) for c in (*keys, "n", "id", "vec", "probes")]).groupBy(*keys))
            .applyInArrow(_rerank(plan), "qn long, query_id long, rn long, vec_id long, score double"))


def nearest(vectors: DataFrame, is_query: Column, plan: Plan = Plan(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows with the largest inner product found for each query row.

    Every row is indexed under its nearest signed axis in each table; a query
    visits its ``probes`` nearest axes in each, and the rows there are scored
    exactly (doubles, on the vectors as given).  Ties go to the smaller id.  A
    query that found fewer than ``k`` rows is searched in all rows of its
    length, in blocks, so that small tables give every candidate.

    Hashing goes by direction, so rows are indexed by bands of like norms (a
    quarter of an octave) and a query visits its axes in every band.  The fewer
    rows a band has, the wider the angles its best ``k`` lie at: probes grow
    with ``spread * k / rows``, up to ``MOST`` times.
    Scores that pass the largest double are infinite and tie.
    Vectors that are null, zero, or hold a null or non-finite component take no
    part, nor do rows with a null id; vectors of different lengths do not meet.
    Rows with equal ids are separate candidates (and queries); a query skips
    only its own row.  Other columns are ignored; an empty table gives no rows.
    """
    rows = (vectors.withColumn("__q", F.coalesce(is_query, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("n"), F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), "__q")
            .where(F.col("id").isNotNull() & _valid("vec")))
    kind = vectors.schema[vec_col].dataType.simpleString()
    hashed = materialise(map_columns(rows, [F.col(c) for c in ("n", "id", "vec", "__q")], _hash_rows(plan),
                                     f"n long, id long, vec {kind}, codes array<int>, probes array<array<int>>, band long"), "hashed")
    hashed = hashed.withColumn("dim", F.size("vec"))
    columns = ["dim", "band", "n", "id", "vec"]
    cells = hashed.select(*columns, "codes", F.posexplode("codes").alias("tab", "cell"))
    asked = hashed.where("probes is not null").select("dim", "n", "id", "vec", "probes")
    share = F.lit(plan.k) / F.count("*")
    axes = F.ceil(plan.probes * F.least(F.lit(MOST), F.greatest(F.lit(1), plan.spread * share))).cast("int")
    bands = F.broadcast(hashed.groupBy("dim", "band").agg(axes.alias("axes")))  # a row a band
    probes = (asked.join(bands, "dim").withColumn("probes", F.transform("probes", lambda p: F.slice(p, F.lit(1), F.col("axes"))))
              .select(*columns, "probes", F.posexplode("probes").alias("tab", "some")).select(*columns, "probes", "tab", F.explode("some").alias("cell")))
    order = Window.partitionBy("qn").orderBy(F.desc("score"), "vec_id", "rn")

    def best(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.k)

    found = materialise(best(_search(cells, probes, plan)), "found")
    enough = found.where(F.col("rank") == plan.k).select(F.col("qn").alias("n"))
    short = materialise(asked.join(enough, "n", "left_anti"), "short")
    if not short.isEmpty():
        whole = [F.lit(0).cast("long").alias("band"), F.lit(-1).alias("tab"), F.lit(0).alias("cell")]
        again = best(_search(hashed.select("dim", "n", "id", "vec", "codes", *whole), short.select("*", *whole), plan))
        found = found.join(short.select(F.col("n").alias("qn")), "qn", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")
