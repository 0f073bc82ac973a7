"""Queries for sampling, permutations, splits, shards and blends
(L1, L2, X1-X4, U2, U3, J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import adapters as AD
from weft.operators import split as SP
from weft.plans import fixtures as X
from weft.plans.catalog import register
from weft.session import materialize

SEED = 42


def _perm_sql(key_sql: str) -> str:
    return f"row_number() OVER (ORDER BY md5('{SEED}:' || {key_sql}), {key_sql}) - 1"


DOC_RANK_SQL = f"dr AS (SELECT doc_id, source, {_perm_sql('CAST(doc_id AS VARCHAR)')} AS rank FROM documents)"
N_SQL = "nn AS (SELECT count(*) AS n FROM documents)"


def _bounds_sql(weights: list[float]) -> str:
    """DuckDB text of the X2 boundaries (round_even = Python round)."""
    tot = sum(weights)
    ws = [w / tot for w in weights]
    cum = ["0"]
    for i, w in enumerate(ws):
        cum.append(f"({cum[i]} + CAST(round_even({w!r} * CAST(n AS DOUBLE), 0) AS BIGINT))")
    diff = f"({cum[-1]} - n)"
    parts = ["0"] + [f"least(greatest({c} - {diff}, 0), n)" for c in cum[1:]]
    return ", ".join(f"{p} AS b{i}" for i, p in enumerate(parts))


def _part_sql(weights: list[float]) -> str:
    k = len(weights)
    cases = " ".join(f"WHEN rank >= b{i} AND rank < b{i + 1} THEN {i}" for i in range(k))
    return f"CASE {cases} END"


# -- L1 / L2 ------------------------------------------------------------------
@register("L1_first_n_per_source", sql="""
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 7
""")
def l1(spark, sf):
    d = X.documents(spark, sf).select("doc_id", "source")
    return SP.first_n_per_source(d, 7, "source", ["doc_id"])


@register("L2_seeded_permutation", sql=f"WITH {DOC_RANK_SQL} SELECT doc_id, rank FROM dr")
def l2(spark, sf):
    return SP.seeded_rank(X.documents(spark, sf).select("doc_id"), ["doc_id"], SEED)


# -- X1 -----------------------------------------------------------------------
@register("X1_train_dev_split", sql=f"""
WITH {DOC_RANK_SQL}, {N_SQL}
SELECT doc_id, CASE WHEN rank < CAST(ceil(0.1 * n) AS BIGINT) THEN 'eval' ELSE 'train' END AS split FROM dr, nn
""")
def x1(spark, sf):
    return SP.train_dev_split(X.documents(spark, sf).select("doc_id"), 0.1, True, ["doc_id"], SEED)


@register("X1_train_dev_threshold", sql=f"""
SELECT doc_id, CASE WHEN CAST(('0x' || substr(md5('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 12))::BIGINT AS DOUBLE) / {float(16 ** 12)!r} < 0.1
       THEN 'eval' ELSE 'train' END AS split FROM documents
""")
def x1_threshold(spark, sf):
    """The approximate split: no count, no shuffle."""
    return SP.train_dev_split(X.documents(spark, sf).select("doc_id"), 0.1, True, ["doc_id"], SEED, exact=False)


# -- X2 / X3 ------------------------------------------------------------------
def _x2(name, weights):
    ws = [float(w) for w in weights.split(",")]

    def build(spark, sf):
        out = SP.phase_split(X.documents(spark, sf).select("doc_id"), weights, ["doc_id"], SEED)
        return out.select("doc_id", "part")

    register(name, sql=f"""
WITH {DOC_RANK_SQL}, {N_SQL},
b AS (SELECT {_bounds_sql(ws)} FROM nn)
SELECT doc_id, {_part_sql(ws)} AS part FROM dr, b
""")(build)


_x2("X2_phase_split", "2,4,4")
_x2("X2_phase_split_zero_weight", "0,5,5")


@register("X3_eval_carveout", sql=f"""
WITH {DOC_RANK_SQL}, {N_SQL},
b AS (SELECT {_bounds_sql([9.0, 1.0])} FROM nn)
SELECT doc_id, CASE WHEN {_part_sql([9.0, 1.0])} = 0 THEN 'train' ELSE 'eval' END AS split FROM dr, b
""")
def x3(spark, sf):
    return SP.carve_eval(X.documents(spark, sf).select("doc_id"), ["doc_id"], SEED).select("doc_id", "split")


# -- X4 -----------------------------------------------------------------------
WORLD, BATCH = 7, 16  # no table here has a multiple of 7 rows


@register("X4_shards", sql=f"""
WITH {DOC_RANK_SQL}, {N_SQL},
e AS (SELECT (n + {WORLD - 1}) // {WORLD} AS each, n FROM nn),
p AS (SELECT doc_id, unnest(range(rank, each * {WORLD}, n)) AS place, each FROM dr, e),
s AS (SELECT doc_id, place % {WORLD} AS shard, place // {WORLD} AS pos, each FROM p)
SELECT doc_id, CAST(shard AS INTEGER) AS shard, pos, pos // {BATCH} AS batch FROM s WHERE pos < each // {BATCH} * {BATCH}
""")
def x4(spark, sf):
    out = SP.shard(X.documents(spark, sf).select("doc_id"), WORLD, BATCH, ["doc_id"], SEED)
    return out.select("doc_id", "shard", "pos", "batch")


# -- U2 / U3 ------------------------------------------------------------------
BLEND_SQL = f"""{X.PREFS_SQL},
u AS (SELECT 'rm-static' AS source, conv_id, turn, prompt || chosen AS prompt_and_chosen FROM prefs
      UNION ALL
      SELECT 'synthetic', conv_id, turn, ' Human: ' || prompt || ' Assistant: ' || chosen FROM prefs)"""


@register("U2_blend_reshuffle", sql=f"""
WITH {BLEND_SQL}
SELECT source, conv_id, turn, prompt_and_chosen,
  {_perm_sql("source || ':' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)")} AS rank
FROM u
""")
def u2(spark, sf):
    p = X.prefs(spark, sf)
    a = AD.identity_pairs(p).select(F.lit("rm-static").alias("source"), "conv_id", "turn", "prompt_and_chosen")
    b = AD.wrapped_pairs(p).select(F.lit("synthetic").alias("source"), "conv_id", "turn", "prompt_and_chosen")
    return SP.blend([a, b], ["source", "conv_id", "turn"], SEED)


@register("U3_append_sft_only", sql=f"""
WITH {X.PREFS_SQL},
pr AS (SELECT conv_id, turn, prompt || chosen AS prompt_and_chosen,
         {_perm_sql("CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)")} AS rank FROM prefs),
nn AS (SELECT count(*) AS n FROM pr),
b AS (SELECT {_bounds_sql([2.0, 4.0, 4.0])} FROM nn),
phase1 AS (SELECT 'pairs' AS source, conv_id, turn, prompt_and_chosen FROM pr, b WHERE {_part_sql([2.0, 4.0, 4.0])} = 0),
sft AS (SELECT 'sft' AS source, conv_id, turn, ' ' || prompt || ' ' || chosen AS prompt_and_chosen FROM prefs),
u AS (SELECT * FROM phase1 UNION ALL SELECT * FROM sft)
SELECT source, conv_id, turn, prompt_and_chosen,
  {_perm_sql("source || ':' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)")} AS rank
FROM u
""")
def u3(spark, sf):
    p = materialize(X.prefs(spark, sf), "prefs")   # read by both branches, and by the buckets of the split
    cols = ["source", "conv_id", "turn", "prompt_and_chosen"]
    pairs = AD.identity_pairs(p).withColumn("source", F.lit("pairs")).select(*cols)
    sft = AD.local_json_pairs(p).withColumn("source", F.lit("sft")).select(*cols)
    return SP.append_sft_only([pairs], [sft], "2,4,4", ["source", "conv_id", "turn"], SEED)


# -- J4 -----------------------------------------------------------------------
@register("J4_subset_by_index", sql=f"""
WITH {DOC_RANK_SQL}, {N_SQL},
b AS (SELECT {_bounds_sql([2.0, 4.0, 4.0])} FROM nn),
idx AS (SELECT rank FROM dr, b WHERE {_part_sql([2.0, 4.0, 4.0])} = 1)
SELECT doc_id, source FROM dr WHERE rank IN (SELECT rank FROM idx)
""")
def j4(spark, sf):
    d = SP.seeded_rank(X.documents(spark, sf).select("doc_id", "source"), ["doc_id"], SEED)
    n = d.count()
    lo, hi = SP.split_boundaries("2,4,4", n)[1:3]
    idx = SP.seeded_rank(X.documents(spark, sf).select("doc_id"), ["doc_id"], SEED).where((F.col("rank") >= lo) & (F.col("rank") < hi))
    return SP.subset_by_index(d, idx).select("doc_id", "source")
