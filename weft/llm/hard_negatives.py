"""Hard negatives by matrix products in a residue number system.

Integer components are taken modulo several small primes, the residues are
multiplied as float32 matrices (slices of the inner dimension are so short that
every sum stays below 2**24 and is exact), and the exact signed score comes
back by Chinese remaindering (mixed radix digits).  As many primes are used as
the largest possible score of a cell asks for.

Rows are packed once, into blocks written to the shared folder.  The anchors,
a stated set of queries, meet all rows in cells (a partition of rows x a
partition of anchors); a task holds one cell.  Cells are multiplied twice: for
the positives, which fix the score windows, and for the negatives within them.
Each cell sends at most its best few rows an anchor and window, so that results
are whole while no anchor's candidates are gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from weft.llm.common import give_back, materialise

INNER = 64                 # products summed in float32 at a time
EXACT = 1 << 24            # integers up to this are exact in float32
LONG = np.iinfo(np.int64)
PACKED = "part int, dim int, ids binary, labels binary, wide boolean, body binary"


@dataclass(frozen=True)
class Plan:
    """``positives`` an anchor, ``negatives`` a positive; a negative's score lies in [low, high] per cent of the positive's."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    rows: int = 8192        # rows of a block
    anchors: int = 1024     # anchors of a cell


def _primes() -> list[int]:
    """Largest first, such that ``INNER`` products of residues in [-p/2, p/2] stay exact in float32."""
    top = 2 * int((EXACT / INNER) ** 0.5)
    sieve = np.ones(top, bool)
    sieve[:2] = False
    for i in range(2, int(top ** 0.5) + 1):
        if sieve[i]:
            sieve[i * i::i] = False
    return [int(p) for p in np.flatnonzero(sieve)[::-1] if INNER * (p // 2) ** 2 < EXACT]


PRIMES = _primes()


def choose_primes(bound: int) -> list[int]:
    """Enough primes for every score in [-bound, bound]."""
    chosen, product = [], 1
    for p in PRIMES:
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    if product <= 2 * bound:
        raise ValueError("components too large for the residue number system")
    return chosen


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integers (as doubles) modulo ``p``, around zero, in float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Integers below 2**50 (as doubles) modulo ``p``, around zero: ``p`` is odd, so no quotient lies near a half."""
    return x - p * np.rint(x * (1.0 / p))


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, around zero; ``a`` and ``b`` hold residues modulo ``p``."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], INNER):
        total += a[:, at:at + INNER] @ b[:, at:at + INNER].T
    return centred(total, p)


def reconstruct(digits: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed integers from residues around zero: balanced mixed radix digits, summed from the highest.

    The sum is made in doubles as long as the product of the primes is exact
    there, then in 64-bit integers, and beyond in Python's integers, cut to the
    range of a long.
    """
    mixed: list[np.ndarray] = []
    for i, p in enumerate(primes):
        value, weight = digits[i], 1
        for v, q in zip(mixed, primes):
            value = value - v * weight   # weights are below p, so values stay below p * p * primes
            weight = weight * q % p
        mixed.append(centred(centred(value, p) * pow(weight, -1, p), p))
    modulus = math.prod(primes)
    kind = np.float64 if modulus < 1 << 53 else np.int64 if modulus <= LONG.max else None
    exact = [v.astype(kind) if kind else v.astype(np.int64).astype(object) for v in mixed]
    total = exact[-1]
    for v, p in zip(exact[-2::-1], primes[-2::-1]):
        total = total * p + v
    return total.astype(np.int64) if kind else np.clip(total, LONG.min, LONG.max).astype(np.int64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows (doubles), as longs; beyond a long, its nearest end."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    primes = choose_primes(max(1, bound))
    return reconstruct([product_mod(residues(a, p), residues(b, p), p) for p in primes], primes)


def best(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest allowed scores of each row, ties to smaller ids."""
    masked = np.where(allowed, score, LONG.min)
    k = min(k, masked.shape[1])
    last = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
    i, j = np.nonzero((masked >= last[:, None]) & allowed)
    order = np.lexsort((ids[j], ~masked[i, j], i))  # ~s falls as s rises, and does not overflow
    i, j = i[order], j[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep]


def _pack(plan: Plan):
    """Arrow batches of (id, label, dim, vec) to packed blocks; 16-bit components where they fit."""
    schema = to_arrow_schema(StructType.fromDDL(PACKED))

    def block(part: int, dim: int, held: list[tuple]) -> pa.RecordBatch:
        ids, labels, x = (np.concatenate(c) for c in zip(*held))
        wide = bool(np.abs(x).max(initial=0) > 32767)
        body = x.astype(np.float64 if wide else np.int16).tobytes()
        return pa.RecordBatch.from_pylist([{"part": part, "dim": dim, "ids": ids.tobytes(), "labels": labels.tobytes(), "wide": wide, "body": body}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x = own.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, dim)
                held.setdefault(dim, []).append((own.column("id").to_numpy(), own.column("label").to_numpy(), x))
                if sum(len(h[0]) for h in held[dim]) >= plan.rows:
                    yield block(part, dim, held.pop(dim))
        for dim, rest in held.items():
            yield block(part, dim, rest)
        give_back()

    return run


def _blocks(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and components of a cell's packed rows."""
    found = []
    for r in table.to_pylist():
        ids = np.frombuffer(r["ids"], np.int64)
        body = np.frombuffer(r["body"], np.float64 if r["wide"] else np.int16)
        found.append((ids, np.frombuffer(r["labels"], np.int64), body.astype(np.float64).reshape(len(ids), r["dim"])))
    return tuple(np.concatenate(c) for c in zip(*found))


SLICE = 256


def _cell(fields: list[tuple[str, pa.DataType]], pick):
    """A cell of the product: ``pick`` gets the anchors' columns, the rows and the scores of a slice of anchors."""
    schema = pa.schema(fields)

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return schema.empty_table()
        ids, labels, x = _blocks(rows)
        vectors = anchors.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(anchors.num_rows, x.shape[1])
        out = []
        for a in range(0, anchors.num_rows, SLICE):
            asked = anchors.slice(a, SLICE)
            score = scores(vectors[a:a + SLICE], x)
            same = asked.column("label").to_numpy()[:, None] == labels[None, :]
            out += pick(asked, ids, score, same)
        give_back()
        return pa.Table.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else schema.empty_table()

    return run


def _positives(plan: Plan):
    def pick(asked, ids, score, same):
        own = asked.column("id").to_numpy()
        i, j = best(score, ids, same & (own[:, None] != ids[None, :]), plan.positives)
        return [(asked.column("n").to_numpy()[i], ids[j], score[i, j])]

    return _cell([("n", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())], pick)


def window(score: int, plan: Plan) -> tuple[int, int]:
    """Lowest and highest ``s`` with low * score <= 100 s <= high * score."""
    return -(-plan.low * score // 100), plan.high * score // 100


def _negatives(plan: Plan):
    """Candidates of all of an anchor's windows are sorted once; each window takes the first of them at or below its top."""
    def pick(asked, ids, score, same):
        out, n, own = [], asked.column("n").to_numpy(), asked.column("id").to_numpy()
        wanted = asked.column("wanted").to_pylist()
        windows = [[window(w["positive_score"], plan) for w in of] for of in wanted]
        low, high = np.array([(min(x for x, _ in of), max(x for _, x in of)) for of in windows]).T
        i, j = np.nonzero(~same & (score >= low[:, None]) & (score <= high[:, None]))
        order = np.lexsort((ids[j], ~score[i, j], i))
        i, j = i[order], j[order]
        falling = ~score[i, j]
        ends = np.searchsorted(i, np.arange(len(wanted) + 1))
        for at, of in enumerate(windows):
            start, stop = ends[at], ends[at + 1]
            for slot, (least, most) in enumerate(of):
                first = start + np.searchsorted(falling[start:stop], ~most)
                last = min(first + plan.negatives, start + np.searchsorted(falling[start:stop], ~least, "right"))
                if first < last:
                    positive = wanted[at][slot]
                    fixed = (n[at], slot, own[at], positive["positive_id"], positive["positive_score"])
                    out.append((*[np.full(last - first, v) for v in fixed], ids[j[first:last]], ~falling[first:last]))
        return [tuple(np.concatenate(c) for c in zip(*out))] if out else []

    longs = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return _cell([("n", pa.int64()), ("slot", pa.int32()), *[(c, pa.int64()) for c in longs]], pick)


def _valid(vector: str) -> Column:
    """All components present, and finite as ``floor(scale * x)``."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < 2.0 ** 480)), F.lit(False))


def _floor(c: Column) -> Column:
    """Largest integer up to ``c``, as a double; from 2**53 on doubles are integers."""
    return F.when(F.abs(c) < 2.0 ** 53, F.floor(c).cast("double")).otherwise(c)


def mine(vectors: DataFrame, is_anchor: Column, plan: Plan = Plan(), id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for each anchor row.

    A component ``x`` counts as floor(scale * x); scores are exact integer inner
    products.  An anchor's positives are its best ``plan.positives`` other rows
    of its label, a positive's negatives the best ``plan.negatives`` rows of
    other labels whose score lies in the window; ties go to smaller ids, fewer
    rows are returned where there are fewer.

    Rows with a null id, label or vector, or with a component that is null, not
    finite or of 2**480 or more, take no part; labels are integers.  Empty
    vectors score 0.  Vectors of different lengths do not meet.  Rows with the
    anchor's own id are not its positives; other rows with equal ids are
    separate candidates, and equal anchors get the same rows each.  Scores
    beyond a long are cut to its range and tie there.  Other columns are
    ignored; an empty table gives no rows.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("raw"),
                           F.coalesce(is_anchor, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & _valid("raw"))
            .select("id", "label", F.size("raw").alias("dim"), "asks", F.transform("raw", lambda c: _floor(c.cast("double") * scale)).alias("vec")))
    size = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("anchors")).first()
    parts, groups = (max(1, -(-n // most)) for n, most in ((size["rows"], plan.rows), (size["anchors"], plan.anchors)))
    blocks = materialise(rows.repartition(parts).select("id", "label", "dim", "vec").mapInArrow(_pack(plan), PACKED), "blocks")
    anchors = materialise(rows.where("asks").repartition(groups)
                          .select(F.monotonically_increasing_id().alias("n"), F.spark_partition_id().alias("cell"), "id", "label", "dim", "vec"), "anchors")
    key = ["dim", "part", "cell"]
    left = blocks.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def multiplied(asked: DataFrame, fn, schema: str) -> DataFrame:
        right = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(fn, schema)

    def ranked(found: DataFrame, by: list[str], what: str, most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(f"{what}_score"), f"{what}_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    near = ranked(multiplied(anchors, _positives(plan), "n long, positive_id long, positive_score long"), ["n"], "positive", plan.positives)
    wanted = near.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("wanted"))
    asked = materialise(anchors.join(wanted, "n"), "positives")
    columns = "n long, slot int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = ranked(multiplied(asked, _negatives(plan), columns), ["n", "slot"], "negative", plan.negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
