"""Queries for the end-to-end flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators.history import expand_front
from weft.operators.align import align
from weft.plans import fixtures as X
from weft.plans import q_split, q_tokens
from weft.plans.catalog import register
from weft.plans.prepare import StageConfig, create_dataset, prepare


def _sql(name):
    # reuse the operator-level oracle: the flow computes the same thing
    from weft.plans.catalog import _REGISTRY
    return _REGISTRY[name].sql


@register("G5_prepare_sft", sql=_sql("T2_encode_supervised"))
def g5_sft(spark, sf):
    p = expand_front(X.pairs(spark, sf), q_tokens.T2_SRC + q_tokens.T2_TGT)
    d = align(p.select("conv_id", "turn", "query", "response", "history"), "query", None, "response", "history")
    out = prepare(d, "sft", StageConfig(max_source_length=q_tokens.T2_SRC, max_target_length=q_tokens.T2_TGT))
    return out.select("conv_id", "turn", "input_ids", "labels")


def _unsupervised(spark, sf, stage, **options):
    p = expand_front(X.pairs(spark, sf), 256)
    d = align(p.select("conv_id", "turn", "query", "response", "history"), "query", None, "response", "history")
    out = prepare(d, stage, StageConfig(max_source_length=256, max_target_length=128, **options))
    return out.select("conv_id", "turn", "input_ids", "labels")


@register("G5_prepare_ppo", sql=_sql("T3_encode_unsupervised"))
def g5_ppo(spark, sf):
    return _unsupervised(spark, sf, "ppo")


@register("G5_prepare_generate", sql=_sql("T3_encode_unsupervised"))
def g5_generate(spark, sf):
    """Supervised rows encoded for prediction with generation."""
    return _unsupervised(spark, sf, "sft", predict_with_generate=True)


@register("G5_prepare_rm", sql=_sql("T4_encode_pairwise"))
def g5_rm(spark, sf):
    p = X.prefs(spark, sf).where(F.col("rejected").isNotNull())
    d = p.select("conv_id", "turn", "prompt", F.array("chosen", "rejected").alias("response"))
    d = align(d, "prompt", None, "response", None)
    out = prepare(d, "rm", StageConfig(max_source_length=128, max_target_length=128))
    return out.select("conv_id", "turn", "accept_ids", "reject_ids")


@register("G5_prepare_pt", sql=_sql("T5_pack_pretrain"))
def g5_pt(spark, sf):
    d = X.documents(spark, sf).select("doc_id", F.col("text").alias("prompt"),
                                      (F.col("doc_id") / 100).cast("bigint").alias("pack_group"))
    out = prepare(d, "pt", StageConfig(max_source_length=q_tokens.T5_SOURCE))
    return out.select("pack_group", F.col("block").cast("bigint").alias("block"), "input_ids", "labels")


def _g6_sql(phase, columns):
    """The rows of one phase of the "2,4,4" split, without null sides, and a select list over them."""
    nulls = "chosen IS NOT NULL" if phase == 1 else "rejected IS NOT NULL" if phase == 2 else "prompt IS NOT NULL"
    return f"""
WITH {X.PREFS_SQL},
pr AS (SELECT *, row_number() OVER (ORDER BY md5('1234:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)),
              CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) - 1 AS rank FROM prefs),
nn AS (SELECT count(*) AS n FROM pr),
b AS (SELECT {q_split._bounds_sql([2.0, 4.0, 4.0])} FROM nn),
part AS (SELECT pr.* FROM pr, b WHERE {q_split._part_sql([2.0, 4.0, 4.0])} = {phase - 1} AND {nulls}),
pe AS (SELECT {q_tokens._fixed_sql('prompt || chosen', 64)} AS c, {q_tokens._fixed_sql("coalesce(prompt || rejected, '')", 64)} AS r,
              {q_tokens.ids('prompt', True)} AS q0 FROM part),
pf AS (SELECT *, CASE WHEN len(q0) > 64 THEN list_slice(q0, len(q0) - 62, len(q0)) ELSE q0 END AS q FROM pe)
SELECT {columns} FROM pf
"""


def _padded(ids, names):
    return (f"list_concat({ids}, list_transform(range(64 - len({ids})), lambda x: 0)) AS {names[0]}, "
            f"list_concat(list_transform({ids}, lambda x: 1), list_transform(range(64 - len({ids})), lambda x: 0)) AS {names[1]}")


def _phase(spark, sf, phase):
    p = X.prefs(spark, sf)
    return create_dataset(p, p, "Dahoas/rm-static", phase, "2,4,4", ["conv_id", "turn"], 1234, "<|endoftext|>", 64)


P1 = _padded("c", ("input_ids", "attention_mask")) + ", list_concat(c, list_transform(range(64 - len(c)), lambda x: 0)) AS labels"
P2 = _padded("c", ("chosen_input_ids", "chosen_attention_mask")) + ", " + _padded("r", ("rejected_input_ids", "rejected_attention_mask"))


@register("G6_preference_phase1", sql=_g6_sql(1, P1))
def g6_1(spark, sf):
    return _phase(spark, sf, 1)[0]


@register("G6_preference_phase2", sql=_g6_sql(2, P2))
def g6(spark, sf):
    return _phase(spark, sf, 2)[0]


@register("G6_preference_phase2_eval", sql=_g6_sql(2, P2))
def g6_eval(spark, sf):
    """The evaluation side (here the same table, so the same rows)."""
    return _phase(spark, sf, 2)[1]


P3 = """list_concat(list_transform(range(64 - len(q)), lambda x: 0), q) AS prompt,
       list_concat(list_transform(range(64 - len(q)), lambda x: 0), list_transform(q, lambda x: 1)) AS prompt_att_mask, 0 AS pad_token_id"""


@register("G6_preference_phase3", sql=_g6_sql(3, P3))
def g6_3(spark, sf):
    return _phase(spark, sf, 3)[0]
