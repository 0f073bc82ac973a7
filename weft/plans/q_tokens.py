"""Queries for tokenisation, stage encoders, padding and packing
(T1-T7, T13-T20, F5)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weft.functions.templates import render_dialog, render_prompt, chat_format, sql_dialog, sql_prompt
from weft.functions.tokens import DEFAULT_TOKENIZER as TK, VocabTokenizer, left_pad
from weft.operators import adapters as AD
from weft.operators import encode as EN
from weft.operators import pack as PK
from weft.operators.history import expand_front
from weft.plans import fixtures as X
from weft.plans.catalog import lit, register
from weft.plans.q_align import HIST_SQL

DEFAULT = chat_format("default")
PAD, BOS, EOS = TK.pad_id, TK.bos_id, TK.eos_id


def ids(x, special=False):
    return TK.sql_ids(x, special)


def _dialog_df(spark, sf, limit):
    """Dialogs for encoders that keep ``limit`` tokens from the front."""
    df = expand_front(X.pairs(spark, sf), limit)
    return df.withColumn("dialog", render_dialog(DEFAULT, F.col("query"), F.col("response"), F.col("history")))


DIALOG_SQL = f"""{HIST_SQL},
d AS (SELECT conv_id, turn, {sql_dialog(DEFAULT, 'query', 'response', 'history', None)} AS dialog FROM ph)"""


# -- T1 -----------------------------------------------------------------------
@register("T1_tokenize", sql=f"SELECT doc_id, {ids('text')} AS input_ids FROM documents")
def t1(spark, sf):
    return X.documents(spark, sf).select("doc_id", TK.ids(F.col("text")).alias("input_ids"))


# A vocabulary table: the V most frequent tokens of the documents, ids from 4 on (3 is the unknown token).
VOCABULARY_SIZE, UNK = 1500, 3
VOCABULARY_SQL = f"""
t AS (SELECT doc_id, {TK.sql_tokens('text')} AS toks FROM documents),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + {UNK} AS INTEGER) AS id
          FROM (SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM t) GROUP BY token) QUALIFY id <= {VOCABULARY_SIZE + UNK})"""


def vocabulary_table(spark, sf):
    tokens = X.documents(spark, sf).select(F.explode(TK.tokens(F.col("text"))).alias("token"))
    top = tokens.groupBy("token").count().orderBy(F.desc("count"), "token").limit(VOCABULARY_SIZE)
    return top.select("token", (F.row_number().over(Window.orderBy(F.desc("count"), "token")) + UNK).alias("id"))


@register("T1_vocabulary_ids", sql=f"""
WITH {VOCABULARY_SQL},
p AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM t),
j AS (SELECT doc_id, list(coalesce(id, {UNK}) ORDER BY i) AS input_ids FROM p LEFT JOIN vocab USING (token) GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN t.toks IS NOT NULL THEN coalesce(input_ids, []::INTEGER[]) END AS input_ids FROM t LEFT JOIN j USING (doc_id)
""")
def t1_vocabulary(spark, sf):
    tokenizer = VocabTokenizer(vocabulary_table(spark, sf), UNK)
    return X.documents(spark, sf).select("doc_id", tokenizer.ids(F.col("text")).alias("input_ids"))


@register("T1_vocabulary_longest_match", sql=f"""
WITH RECURSIVE {VOCABULARY_SQL},
words AS (SELECT DISTINCT unnest(toks) AS word FROM t),
g(word, pos, ids) AS (
  SELECT word, 1::BIGINT, []::INTEGER[] FROM words WHERE word NOT IN (SELECT token FROM vocab) AND length(word) <= 200
  UNION ALL
  SELECT word, pos + coalesce(n, 1), list_append(ids, coalesce(id, {UNK}))
  FROM (SELECT g.word, g.pos, g.ids, max(length(v.token)) AS n, arg_max(v.id, length(v.token)) AS id
        FROM g, range(1, 33) AS r(n) LEFT JOIN vocab v ON v.token = substr(g.word, g.pos, r.n) AND length(v.token) = r.n
        WHERE g.pos <= length(g.word) GROUP BY g.word, g.pos, g.ids)),
cut AS (SELECT token AS word, [id] AS ids FROM vocab UNION ALL SELECT word, ids FROM g WHERE pos > length(word)
        UNION ALL SELECT word, [{UNK}] FROM words WHERE length(word) > 200 AND word NOT IN (SELECT token FROM vocab)),
p AS (SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS i FROM t),
j AS (SELECT doc_id, flatten(list(ids ORDER BY i)) AS input_ids FROM p JOIN cut USING (word) GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN t.toks IS NOT NULL THEN coalesce(input_ids, []::INTEGER[]) END AS input_ids FROM t LEFT JOIN j USING (doc_id)
""")
def t1_longest_match(spark, sf):
    tokenizer = VocabTokenizer(vocabulary_table(spark, sf), UNK, greedy=True)
    return X.documents(spark, sf).select("doc_id", tokenizer.ids(F.col("text")).alias("input_ids"))


# -- T2 -----------------------------------------------------------------------
T2_SRC, T2_TGT = 128, 128


@register("T2_encode_supervised", sql=f"""
WITH {DIALOG_SQL},
t AS (SELECT conv_id, turn, list_transform(range(0, len(dialog) // 2), lambda i: {{
        'src': list_slice(CASE WHEN i = 0 THEN {ids('dialog[2 * i + 1]', True)} ELSE {ids('dialog[2 * i + 1]')} END, 1, {T2_SRC}),
        'tgt': list_slice({ids('dialog[2 * i + 2]')}, 1, {T2_TGT - 1})}}) AS turns FROM d),
l AS (SELECT *, list_transform(turns, lambda x: len(x.src) + len(x.tgt) + 1) AS lens FROM t),
k AS (SELECT *, len(list_filter(list_transform(range(1, len(lens) + 1), lambda j: list_sum(list_slice(lens, 1, j))),
                                lambda c: c <= {T2_SRC + T2_TGT})) AS k FROM l)
SELECT conv_id, turn,
  flatten(list_transform(list_slice(turns, 1, k), lambda x: list_concat(list_concat(x.src, x.tgt), [{EOS}]))) AS input_ids,
  flatten(list_transform(list_slice(turns, 1, k), lambda x: list_concat(list_concat(
      list_transform(x.src, lambda y: -100), x.tgt), [{EOS}]))) AS labels
FROM k
""")
def t2(spark, sf):
    return EN.encode_supervised(_dialog_df(spark, sf, T2_SRC + T2_TGT), T2_SRC, T2_TGT).select("conv_id", "turn", "input_ids", "labels")


# -- T3 -----------------------------------------------------------------------
@register("T3_encode_unsupervised", sql=f"""
WITH {DIALOG_SQL}
SELECT conv_id, turn,
  list_slice({ids("array_to_string(list_slice(dialog, 1, len(dialog) - 1), '')", True)}, 1, 256) AS input_ids,
  list_slice({ids('dialog[len(dialog)]', True)}, 1, 128) AS labels
FROM d
""")
def t3(spark, sf):
    return EN.encode_unsupervised(_dialog_df(spark, sf, 256), 256, 128).select("conv_id", "turn", "input_ids", "labels")


# -- T4 -----------------------------------------------------------------------
@register("T4_encode_pairwise", sql=f"""
WITH {X.PREFS_SQL},
p AS (SELECT conv_id, turn, {sql_prompt(DEFAULT, 'prompt', None, None)} AS pt, chosen, rejected
      FROM prefs WHERE rejected IS NOT NULL),
s AS (SELECT *, list_slice({ids('pt', True)}, 1, 128) AS src FROM p)
SELECT conv_id, turn,
  list_concat(list_concat(src, list_slice({ids('chosen')}, 1, 127)), [{EOS}]) AS accept_ids,
  list_concat(list_concat(src, list_slice({ids('rejected')}, 1, 127)), [{EOS}]) AS reject_ids
FROM s
""")
def t4(spark, sf):
    p = X.prefs(spark, sf).where(F.col("rejected").isNotNull())
    p = p.withColumn("response", F.array("chosen", "rejected")).drop("chosen", "rejected")
    p = EN.split_pair_response(p)
    p = p.withColumn("prompt_text", render_prompt(DEFAULT, F.col("prompt")))
    return EN.encode_pairwise(p, 128, 128).select("conv_id", "turn", "accept_ids", "reject_ids")


# -- T5 / T6 ------------------------------------------------------------------
T5_SOURCE = 256
T6_BLOCK = 200


def _pack_tokens_sql(group_expr: str, special: bool) -> str:
    return f"""
d AS (SELECT doc_id, {group_expr} AS pack_group, {ids('text', special)} AS ids FROM documents),
t AS (SELECT pack_group, doc_id, unnest(ids) AS tok, generate_subscripts(ids, 1) AS p FROM d),
r AS (SELECT pack_group, tok, row_number() OVER (PARTITION BY pack_group ORDER BY doc_id, p) - 1 AS gp FROM t)"""


@register("T5_pack_pretrain", sql=f"""
WITH {_pack_tokens_sql('doc_id // 100', False)},
b AS (SELECT pack_group, gp // {T5_SOURCE - 1} AS block, list(tok ORDER BY gp) AS ids FROM r GROUP BY ALL)
SELECT pack_group, CAST(block AS BIGINT) AS block, list_concat([{BOS}], ids) AS input_ids, list_concat([{BOS}], ids) AS labels
FROM b WHERE len(ids) = {T5_SOURCE - 1}
""")
def t5(spark, sf):
    d = X.documents(spark, sf).withColumn("pack_group", (F.col("doc_id") / 100).cast("bigint"))
    out = PK.pack_pretrain(d, T5_SOURCE, chunk=16)
    return out.select("pack_group", F.col("block").cast("bigint").alias("block"), "input_ids", "labels")


T6_GROUP_SQL = "CASE WHEN n_chars < 300 THEN 100000 + doc_id ELSE doc_id // 100 END"


@register("T6_group_texts", sql=f"""
WITH {_pack_tokens_sql(T6_GROUP_SQL, True)},
b AS (SELECT pack_group, gp // {T6_BLOCK} AS block, list(tok ORDER BY gp) AS ids FROM r GROUP BY ALL)
SELECT pack_group, CAST(block AS BIGINT) AS block, ids AS input_ids, list_transform(ids, lambda x: 1) AS attention_mask,
       ids AS labels
FROM b WHERE len(ids) = {T6_BLOCK} OR block = 0
""")
def t6(spark, sf):
    d = X.documents(spark, sf).withColumn(
        "pack_group", F.when(F.col("n_chars") < 300, 100000 + F.col("doc_id")).otherwise((F.col("doc_id") / 100).cast("bigint")))
    out = PK.group_texts(d.select("pack_group", "doc_id", "text"), T6_BLOCK, chunk=16)
    return out.select("pack_group", F.col("block").cast("bigint").alias("block"), "input_ids", "attention_mask", "labels")


# -- T7 -----------------------------------------------------------------------
@register("T7_truncate_line", sql=f"""
WITH l AS (SELECT doc_id, {ids('text')} AS ids FROM documents)
SELECT doc_id, CASE WHEN len(ids) > 512 THEN list_slice(ids, 1, 511) ELSE ids END AS input_ids FROM l
""")
def t7(spark, sf):
    d = X.documents(spark, sf)
    return d.select("doc_id", EN.truncate_line(TK.ids(F.col("text")), 512).alias("input_ids"))


# -- T13 ----------------------------------------------------------------------
def _fixed_sql(text: str, n: int) -> str:
    cut = f"list_slice({ids(text + " || '<|endoftext|>'", True)}, 1, {n})"
    return cut


@register("T13_fixed_length_pad", sql=f"""
WITH {X.PREFS_SQL},
c AS (SELECT conv_id, turn, {_fixed_sql('prompt || chosen', 128)} AS ids FROM prefs)
SELECT conv_id, turn, list_concat(ids, list_transform(range(128 - len(ids)), lambda x: {PAD})) AS input_ids,
  list_concat(list_transform(ids, lambda x: 1), list_transform(range(128 - len(ids)), lambda x: 0)) AS attention_mask
FROM c
""")
def t13(spark, sf):
    df = AD.identity_pairs(X.prefs(spark, sf))
    return EN.fixed_length(df, "prompt_and_chosen", 128).select("conv_id", "turn", "input_ids", "attention_mask")


# -- T14 ----------------------------------------------------------------------
@register("T14_prompt_left_pad", sql=f"""
WITH {X.PREFS_SQL},
c AS (SELECT conv_id, turn, {ids(f"{lit(AD.HUMAN)} || prompt || {lit(AD.ASSISTANT)}", True)} AS ids FROM prefs),
k AS (SELECT conv_id, turn, CASE WHEN len(ids) > 64 THEN list_slice(ids, len(ids) - 62, len(ids)) ELSE ids END AS ids FROM c)
SELECT conv_id, turn,
  list_concat(list_transform(range(greatest(64, len(ids)) - len(ids)), lambda x: {PAD}), ids) AS prompt,
  list_concat(list_transform(range(greatest(64, len(ids)) - len(ids)), lambda x: 0), list_transform(ids, lambda x: 1)) AS prompt_att_mask
FROM k
""")
def t14(spark, sf):
    df = AD.wrapped_pairs(X.prefs(spark, sf))
    return EN.prompt_left_pad(df, "prompt", 64, 64).select("conv_id", "turn", "prompt", "prompt_att_mask")


# -- T15 ----------------------------------------------------------------------
@register("T15_batch_pad", sql=f"""
WITH {X.PAIRS_SQL},
e AS (SELECT conv_id, turn, conv_id // 8 AS batch_id, {ids('query', True)} AS input_ids,
             {ids('response')} AS labels FROM pairs),
m AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS w, max(len(labels)) OVER (PARTITION BY batch_id) AS wl FROM e)
SELECT conv_id, turn, batch_id,
  list_concat(input_ids, list_transform(range(w - len(input_ids)), lambda x: {PAD})) AS input_ids,
  list_concat(labels, list_transform(range(wl - len(labels)), lambda x: -100)) AS labels
FROM m
""")
def t15(spark, sf):
    p = X.pairs(spark, sf).select("conv_id", "turn", (F.col("conv_id") / 8).cast("bigint").alias("batch_id"),
                                  TK.ids(F.col("query"), True).alias("input_ids"),
                                  TK.ids(F.col("response")).alias("labels"))
    return EN.batch_pad(p, "batch_id").select("conv_id", "turn", "batch_id", "input_ids", "labels")


# -- T16 / T17 ----------------------------------------------------------------
@register("T16_pad_to_target", sql=f"""
WITH {X.PAIRS_SQL},
e AS (SELECT conv_id, turn, {ids('response')} AS src, {ids('query')} AS tgt FROM pairs)
SELECT conv_id, turn, list_concat(list_transform(range(greatest(len(tgt) - len(src), 0)), lambda x: {PAD}), src) AS padded
FROM e
""")
def t16(spark, sf):
    p = X.pairs(spark, sf)
    src = TK.ids(F.col("response"))
    return p.select("conv_id", "turn", EN.pad_to_target(src, TK.ids(F.col("query")), PAD).alias("padded"))


@register("T17_strip_padding", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn, {ids('query')} AS query_ids,
       CASE WHEN conv_id % 9 = 0 THEN []::INTEGER[] ELSE {ids('response')} END AS response_ids
FROM pairs
""")
def t17(spark, sf):
    p = X.pairs(spark, sf)
    q_ids = TK.ids(F.col("query"))
    q = left_pad(q_ids, F.size(q_ids) + 5, PAD)                      # left padding of a generated batch
    r_ids = F.when(F.col("conv_id") % 9 == 0, F.array().cast("array<int>")).otherwise(TK.ids(F.col("response")))
    r = F.concat(r_ids, F.array_repeat(F.lit(PAD), 5))               # right padding
    qs, rs = EN.strip_padding(q, r, PAD)
    return p.select("conv_id", "turn", qs.alias("query_ids"), rs.alias("response_ids"))


# -- T18 / T19 ----------------------------------------------------------------
def _pair_encoded(spark, sf):
    df = AD.identity_pairs(X.prefs(spark, sf))
    df = AD.drop_null_sides(df, 2)
    df = EN.fixed_length(df, "prompt_and_chosen", 64, prefix="chosen_")
    df = EN.fixed_length(df, "prompt_and_rejected", 64, prefix="rejected_")
    return df.withColumn("batch_id", (F.col("conv_id") / 8).cast("bigint"))


PAIR_ENC_SQL = f"""{X.PREFS_SQL},
pe AS (SELECT conv_id, turn, conv_id // 8 AS batch_id,
         {_fixed_sql('prompt || chosen', 64)} AS c, {_fixed_sql('prompt || rejected', 64)} AS r
       FROM prefs WHERE rejected IS NOT NULL),
pe2 AS (SELECT conv_id, turn, batch_id,
  list_concat(c, list_transform(range(64 - len(c)), lambda x: {PAD})) AS chosen_input_ids,
  list_concat(list_transform(c, lambda x: 1), list_transform(range(64 - len(c)), lambda x: 0)) AS chosen_attention_mask,
  list_concat(r, list_transform(range(64 - len(r)), lambda x: {PAD})) AS rejected_input_ids,
  list_concat(list_transform(r, lambda x: 1), list_transform(range(64 - len(r)), lambda x: 0)) AS rejected_attention_mask
  FROM pe)"""


@register("T18_stack_pairs", sql=f"""
WITH {PAIR_ENC_SQL},
n AS (SELECT *, count(*) OVER (PARTITION BY batch_id) AS n,
             row_number() OVER (PARTITION BY batch_id ORDER BY conv_id, turn) - 1 AS r FROM pe2)
SELECT batch_id, r AS row, 0 AS side, chosen_input_ids AS input_ids, chosen_attention_mask AS attention_mask FROM n
UNION ALL
SELECT batch_id, n + r, 1, rejected_input_ids, rejected_attention_mask FROM n
""")
def t18(spark, sf):
    df = _pair_encoded(spark, sf)
    out = EN.stack_pairs(df, "batch_id", ["conv_id", "turn"], "chosen_input_ids", "rejected_input_ids",
                         "chosen_attention_mask", "rejected_attention_mask")
    return out.select("batch_id", F.col("row").cast("bigint").alias("row"), F.col("side").cast("int").alias("side"),
                      "input_ids", "attention_mask")


@register("T19_phase1_record", sql=f"""
WITH {PAIR_ENC_SQL}
SELECT chosen_input_ids AS input_ids, chosen_attention_mask AS attention_mask, chosen_input_ids AS labels FROM pe2
""")
def t19_1(spark, sf):
    df = _pair_encoded(spark, sf).select(F.col("chosen_input_ids").alias("input_ids"),
                                         F.col("chosen_attention_mask").alias("attention_mask"))
    return EN.phase_record(df, 1)


@register("T19_phase1_masked_pads", sql=f"""
WITH {PAIR_ENC_SQL}
SELECT chosen_input_ids AS input_ids, chosen_attention_mask AS attention_mask,
  list_transform(chosen_input_ids, lambda x, i: CASE WHEN chosen_attention_mask[i] = 1 THEN x ELSE -100 END) AS labels FROM pe2
""")
def t19_1_masked(spark, sf):
    df = _pair_encoded(spark, sf).select(F.col("chosen_input_ids").alias("input_ids"), F.col("chosen_attention_mask").alias("attention_mask"))
    return EN.phase_record(df, 1, mask_pads=True)


@register("T19_phase2_record", sql=f"""
WITH {PAIR_ENC_SQL}
SELECT chosen_input_ids, chosen_attention_mask, rejected_input_ids, rejected_attention_mask FROM pe2
""")
def t19_2(spark, sf):
    return EN.phase_record(_pair_encoded(spark, sf), 2)


@register("T19_phase3_record", sql=f"""
WITH {X.PREFS_SQL},
c AS (SELECT {ids('prompt', True)} AS ids FROM prefs),
k AS (SELECT CASE WHEN len(ids) > 64 THEN list_slice(ids, len(ids) - 62, len(ids)) ELSE ids END AS ids FROM c)
SELECT list_concat(list_transform(range(greatest(64, len(ids)) - len(ids)), lambda x: {PAD}), ids) AS prompt,
  list_concat(list_transform(range(greatest(64, len(ids)) - len(ids)), lambda x: 0), list_transform(ids, lambda x: 1)) AS prompt_att_mask,
  {PAD} AS pad_token_id
FROM k
""")
def t19_3(spark, sf):
    df = AD.drop_null_sides(AD.identity_pairs(X.prefs(spark, sf)), 3)
    return EN.phase_record(EN.prompt_left_pad(df, "prompt", 64, 64), 3)


# -- T20 ----------------------------------------------------------------------
@register("T20_rebatch", sql=f"""
WITH {X.PAIRS_SQL},
b AS (SELECT conv_id, turn, conv_id // 8 AS large_batch,
             row_number() OVER (PARTITION BY conv_id // 8 ORDER BY conv_id, turn) - 1 AS pos FROM pairs),
n AS (SELECT max(large_batch) + 1 AS nl FROM b)
SELECT conv_id, turn, large_batch, CAST(large_batch // 4 AS BIGINT) AS buffer, CAST(pos // 3 AS BIGINT) AS small_batch
FROM b, n WHERE large_batch < (nl // 4) * 4
""")
def t20(spark, sf):
    p = X.pairs(spark, sf).withColumn("large_batch", (F.col("conv_id") / 8).cast("bigint"))
    p = p.withColumn("pos", F.row_number().over(Window.partitionBy("large_batch").orderBy("conv_id", "turn")) - 1)
    n_large = p.agg(F.max("large_batch")).first()[0] + 1
    return PK.rebatch(p, "large_batch", "pos", 4, 3, n_large).select("conv_id", "turn", "large_batch", "buffer", "small_batch")


# -- F5 -----------------------------------------------------------------------
@register("F5_drop_short_answers", sql=f"""
WITH {X.PAIRS_SQL},
s AS (SELECT conv_id, turn,
        {ids("CASE turn % 4 WHEN 1 THEN CAST(turn AS VARCHAR) WHEN 3 THEN '' ELSE response END")} AS ans FROM pairs)
SELECT conv_id, turn FROM s WHERE len(ans) > 1
""")
def f5(spark, sf):
    """Generated sequences = left-padded prompt + answer + right padding;
    answers are a one-token text, an empty text or the whole response."""
    p = X.pairs(spark, sf)
    q_ids = TK.ids(F.col("query"))
    prompt = left_pad(q_ids, F.size(q_ids) + 3, PAD)
    text = F.when(F.col("turn") % 4 == 1, F.col("turn").cast("string")).when(F.col("turn") % 4 == 3, F.lit("")) \
        .otherwise(F.col("response"))
    seq = F.concat(prompt, TK.ids(text), F.array_repeat(F.lit(PAD), 4))
    return p.where(EN.has_answer(seq, F.size(q_ids) + 3, PAD)).select("conv_id", "turn")
