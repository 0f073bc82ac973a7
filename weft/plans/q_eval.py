"""Queries for evaluation assembly and user functions
(J1-J3, J5, W4, W5, C15, A11, G1-G4)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from weft.functions import text as TX
from weft.functions.tokens import PandasTokenizer
from weft.operators import adapters as AD
from weft.operators import evaluate as EV
from weft.operators.history import cumulative_questions, expand_history
from weft.operators.split import ordered_index
from weft.plans import fixtures as X
from weft.plans.catalog import lit, register
from weft.plans.q_clean import s_strip, s_tokens

NL = chr(10)

# Role prompt table used by the J1 query.  The key "Sea Captain" leaves the
# role "Captain of the Sea" unmatched: a role spelled differently from its
# prompt key, the situation J1 must report.
ROLE_PROMPTS = [("Tutor", "You are a patient tutor. "), ("Chef", "You are a chef. "),
                ("Poet", "You answer in verse. "), ("Sea Captain", "You are a ship's captain. ")]
ROLE_SQL = ("CASE conv_id % 4 WHEN 0 THEN 'Tutor' WHEN 1 THEN 'Chef' WHEN 2 THEN 'Poet' "
            "ELSE 'Captain of the Sea' END")
ROLE_VALUES = ", ".join(f"({lit(r)}, {lit(p)})" for r, p in ROLE_PROMPTS)


def _questions(spark, sf):
    q = cumulative_questions(X.pairs(spark, sf)).drop("prompt")
    role = (F.when(F.col("conv_id") % 4 == 0, "Tutor").when(F.col("conv_id") % 4 == 1, "Chef")
             .when(F.col("conv_id") % 4 == 2, "Poet").otherwise("Captain of the Sea"))
    return q.withColumn("role", role)


QUESTIONS_SQL = f"""{X.PAIRS_SQL},
questions AS (
  SELECT conv_id, turn, {ROLE_SQL} AS role,
    coalesce(string_agg('input: ' || query || 'output: ' || response, '') OVER (
      PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || 'input: ' || query AS question
  FROM pairs),
prompts(role, prompt) AS (VALUES {ROLE_VALUES})"""


@register("J1_role_prompts", sql=f"""
WITH {QUESTIONS_SQL}
SELECT q.conv_id, q.turn, q.role, p.prompt || q.question || {lit(NL + 'output: ')} AS combined_question
FROM questions q JOIN prompts p USING (role)
""")
def j1(spark, sf):
    prompts = spark.createDataFrame(ROLE_PROMPTS, "role string, prompt string")
    joined, _ = EV.attach_role_prompts(_questions(spark, sf), prompts, on_missing="report")
    return joined.select("conv_id", "turn", "role", "combined_question")


@register("J1_missing_roles", sql=f"""
WITH {QUESTIONS_SQL}
SELECT DISTINCT role FROM questions WHERE role NOT IN (SELECT role FROM prompts)
""")
def j1m(spark, sf):
    prompts = spark.createDataFrame(ROLE_PROMPTS, "role string, prompt string")
    _, missing = EV.attach_role_prompts(_questions(spark, sf), prompts, on_missing="report")
    return missing


@register("J1_all_roles_known", sql=f"""
WITH {QUESTIONS_SQL}
SELECT q.conv_id, q.turn, q.role, p.prompt || q.question || {lit(NL + 'output: ')} AS combined_question
FROM questions q JOIN prompts p USING (role)
""")
def j1_strict(spark, sf):
    """The default mode, which raises when a role has no prompt: here only rows whose role has one are asked."""
    prompts = spark.createDataFrame(ROLE_PROMPTS, "role string, prompt string")
    known = _questions(spark, sf).join(prompts.select("role"), "role", "left_semi")
    joined, _ = EV.attach_role_prompts(known, prompts)
    return joined.select("conv_id", "turn", "role", "combined_question")


# -- J2 / G4 ------------------------------------------------------------------
def _map_cols(df, keys):
    e = F.array_sort(F.map_entries("predict"))
    return df.select(*keys, F.transform(e, lambda x: x["key"]).alias("models"),
                     F.transform(e, lambda x: x["value"]).alias("texts"))


@register("J2_attach_predictions", sql=f"""
WITH {X.PREDICTIONS_SQL}
SELECT p.conv_id, p.turn, list(pr.model ORDER BY pr.model) AS models, list(pr.text ORDER BY pr.model) AS texts
FROM pairs p JOIN predictions pr USING (conv_id, turn) GROUP BY p.conv_id, p.turn
""")
def j2(spark, sf):
    rows = X.pairs(spark, sf).select("conv_id", "turn")
    out = EV.attach_predictions(rows, X.predictions(spark, sf), ["conv_id", "turn"])
    return _map_cols(out.where(F.col("predict").isNotNull()), ["conv_id", "turn"])


def _stub_echo(texts):
    return ["echo: " + t for t in texts]


def _stub_underscore(texts):
    return [t.replace(" ", "_") for t in texts]


@register("G4_batch_predict", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn, ['echo', 'underscore'] AS models, ['echo: ' || query, replace(query, ' ', '_')] AS texts FROM pairs
""")
def g4(spark, sf):
    rows = X.pairs(spark, sf).select("conv_id", "turn", "query")
    preds = EV.batch_predict(rows, ["conv_id", "turn"], "query", {"echo": _stub_echo, "underscore": _stub_underscore})
    out = EV.attach_predictions(rows.select("conv_id", "turn"), preds, ["conv_id", "turn"])
    return _map_cols(out, ["conv_id", "turn"])


def _stub_turns(texts, chats):
    return [f"turn {len(chat) + 1} after {chat[-1]['query'] if chat else 'nothing'}: {t}" for t, chat in zip(texts, chats)]


@register("G4_batch_predict_history", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn, 'turns' AS model, 'turn ' || CAST(row_number() OVER w AS VARCHAR) || ' after ' ||
       coalesce(lag(query) OVER w, 'nothing') || ': ' || query AS text
FROM pairs WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def g4_history(spark, sf):
    """The model is given the conversation so far."""
    rows = expand_history(X.pairs(spark, sf)).select("conv_id", "turn", "query", "history")
    return EV.batch_predict(rows, ["conv_id", "turn"], "query", {"turns": _stub_turns}, history="history")


# -- J3 / W5 ------------------------------------------------------------------
def _aligned(spark, sf):
    p = X.pairs(spark, sf)
    pr = X.predictions(spark, sf)
    q = p.select("conv_id", "turn", F.col("query").alias("question"))
    r = p.select("conv_id", "turn", F.col("response").alias("reference"))
    g = pr.where(F.col("model") == "m1").select("conv_id", "turn", F.col("text").alias("gpt_answer"))
    m = pr.where(F.col("model") == "m2").select("conv_id", "turn", F.col("text").alias("model_answer"))
    return EV.align_answers(q, r, g, m, ["conv_id", "turn"])


ALIGNED_SQL = f"""{X.PREDICTIONS_SQL},
aligned AS (
  SELECT p.conv_id, p.turn, p.query AS question, p.response AS reference, g.text AS gpt_answer, m.text AS model_answer
  FROM pairs p JOIN predictions g ON g.conv_id = p.conv_id AND g.turn = p.turn AND g.model = 'm1'
  JOIN predictions m ON m.conv_id = p.conv_id AND m.turn = p.turn AND m.model = 'm2')"""


@register("J3_align_answers", sql=f"WITH {ALIGNED_SQL} SELECT * FROM aligned")
def j3(spark, sf):
    return _aligned(spark, sf).select("conv_id", "turn", "question", "reference", "gpt_answer", "model_answer")


@register("W5_rating_prompts", sql=f"""
WITH {ALIGNED_SQL}
SELECT conv_id, {lit(EV.PAIR_RATING_PROMPT)} || string_agg('Question: ' || question || ' Reference answer: ' || reference ||
  ' GPT answer: ' || gpt_answer || ' Model answer: ' || model_answer || {lit(NL)}, '' ORDER BY turn) AS rating_prompt
FROM aligned GROUP BY conv_id
""")
def w5(spark, sf):
    return EV.pair_rating_prompts(_aligned(spark, sf), "conv_id", "turn")


# -- W4 / C15 / A11 -------------------------------------------------------------
def _members(spark, sf):
    a = ordered_index(_aligned(spark, sf), ["conv_id", "turn"], out="idx")
    return EV.judge_batches(a, "idx", "question", "reference", ["gpt_answer", "model_answer"])


MEMBERS_SQL = f"""{ALIGNED_SQL},
members AS (SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 8 AS batch,
                   CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) % 8 + 1 AS INTEGER) AS member FROM aligned)"""


@register("W4_judge_batches", sql=f"""
WITH {MEMBERS_SQL}
SELECT batch, {lit(EV.BATCH_RATING_PROMPT)} || string_agg('Question: ' || question || ' Reference answer: ' || reference ||
  ' model1 answer: ' || gpt_answer || ' model2 answer: ' || model_answer || ' ' || {lit(NL)}, '' ORDER BY member) AS judge_prompt
FROM members GROUP BY batch
""")
def w4(spark, sf):
    _, prompts = _members(spark, sf)
    return prompts


def _judge_text(members):
    """Synthetic judge replies derived from the members: one malformed line
    (single space after the comma), one missing question, header lines and,
    in every fourth batch, a repeated question 1 that overrides the first."""
    a = (F.length("question") % 101).cast("string")
    b = (F.length("model_answer") % 101).cast("string")
    m = F.col("member").cast("string")
    line = (F.when(F.col("member") % 7 == 6, F.lit(None))
             .when(F.col("member") % 5 == 4, F.concat(F.lit("Question "), m, F.lit(": model1 score: "), a, F.lit(", model2 score: "), b))
             .otherwise(F.concat(F.lit("Question "), m, F.lit(": model1 score: "), a, F.lit(",  model2 score: "), b)))
    g = members.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("member", line.alias("l")))).alias("_ls"))
    body = F.array_join(F.transform("_ls", lambda x: x["l"]), "\n")
    extra = F.when(F.col("batch") % 4 == 3, F.lit("\nQuestion 1: model1 score: 0,  model2 score: 0")).otherwise(F.lit(""))
    return g.select("batch", F.concat(F.lit("Scores:\n"), body, extra, F.lit("\nAverage: n/a")).alias("judge_text"))


JUDGE_SQL = f"""{MEMBERS_SQL},
lines AS (SELECT batch, member,
    CASE WHEN member % 7 = 6 THEN NULL
         WHEN member % 5 = 4 THEN 'Question ' || member || ': model1 score: ' || (length(question) % 101) || ', model2 score: ' || (length(model_answer) % 101)
         ELSE 'Question ' || member || ': model1 score: ' || (length(question) % 101) || ',  model2 score: ' || (length(model_answer) % 101) END AS l
  FROM members),
judge AS (SELECT batch, {lit('Scores:' + NL)} || coalesce(string_agg(l, {lit(NL)} ORDER BY member), '') ||
    CASE WHEN batch % 4 = 3 THEN {lit(NL + 'Question 1: model1 score: 0,  model2 score: 0')} ELSE '' END ||
    {lit(NL + 'Average: n/a')} AS judge_text FROM lines GROUP BY batch),
jl AS (SELECT batch, unnest(string_split(judge_text, {lit(NL)})) AS l, generate_subscripts(string_split(judge_text, {lit(NL)}), 1) AS ln FROM judge),
parsed AS (SELECT batch, CAST(regexp_extract(l, {lit(TX.judge_line_pattern(2))}, 1) AS INTEGER) AS member,
                  arg_max(CAST(regexp_extract(l, {lit(TX.judge_line_pattern(2))}, 2) AS INTEGER), ln) AS score_1,
                  arg_max(CAST(regexp_extract(l, {lit(TX.judge_line_pattern(2))}, 3) AS INTEGER), ln) AS score_2
           FROM jl WHERE regexp_matches(l, {lit(TX.judge_line_pattern(2))}) GROUP BY ALL)"""


@register("C15_parse_judge", sql=f"WITH {JUDGE_SQL} SELECT batch, member, score_1, score_2 FROM parsed")
def c15(spark, sf):
    members, _ = _members(spark, sf)
    return EV.parse_judge(_judge_text(members), "batch")


@register("A11_judge_scores", sql=f"""
WITH {JUDGE_SQL}
SELECT m.conv_id, m.turn, m.batch, m.member, coalesce(p.score_1, -1) AS score_1, coalesce(p.score_2, -1) AS score_2
FROM members m LEFT JOIN parsed p ON p.batch = m.batch AND p.member = m.member
""")
def a11(spark, sf):
    members, _ = _members(spark, sf)
    parsed = EV.parse_judge(_judge_text(members), "batch")
    out = EV.judge_scores(members, parsed)
    return out.select("conv_id", "turn", "batch", "member", "score_1", "score_2")


# -- J5 -----------------------------------------------------------------------
PLACEHOLDER = TX.TRANSLATION_PLACEHOLDERS[1]


def _turn_maps(spark, sf):
    p = X.pairs(spark, sf)
    m = F.when(F.col("conv_id") % 10 == 0, F.create_map(F.lit("dany_input"), F.col("conv_id").cast("string"),
                                                        F.lit("output"), F.col("response"))) \
        .otherwise(F.create_map(F.lit("input"), F.when(F.col("turn") % 4 == 1, F.col("turn").cast("string")).otherwise(F.col("query")),
                                F.lit("output"), F.col("response")))
    return p.select("conv_id", "turn", m.alias("turn_map"))


TURN_MAPS_SQL = f"""{X.PAIRS_SQL},
m AS (SELECT conv_id, turn,
        CASE WHEN conv_id % 10 = 0 THEN MAP {{'dany_input': CAST(conv_id AS VARCHAR), 'output': response}}
             ELSE MAP {{'input': CASE WHEN turn % 4 = 1 THEN CAST(turn AS VARCHAR) ELSE query END, 'output': response}} END AS m
      FROM pairs)"""


@register("J5_apply_translations", sql=f"""
WITH {TURN_MAPS_SQL},
ok AS (SELECT * FROM m
       WHERE len(list_filter(map_values(m), lambda v: len({s_tokens('v')}) <= 1)) = 0
          OR len(list_filter(map_keys(m), lambda k: contains(k, 'dany') OR contains(k, '霍金'))) > 0),
kv AS (SELECT conv_id, turn, m, unnest(map_keys(m)) AS k, unnest(map_values(m)) AS v FROM ok),
tr AS (SELECT DISTINCT v AS source,
         CASE WHEN length(v) % 6 = 1 THEN {lit(PLACEHOLDER)} ELSE 'T:' || v || ' ' END AS target
       FROM kv WHERE length(v) % 6 <> 0),
j AS (SELECT kv.*, {s_strip('tr.target')} AS t,
             tr.target IS NOT NULL AND {s_strip('tr.target')} NOT IN ('', {lit(PLACEHOLDER)}, {lit(TX.TRANSLATION_PLACEHOLDERS[2])}) AS good
      FROM kv LEFT JOIN tr ON tr.source = kv.v),
g AS (SELECT conv_id, turn, any_value(m) AS m, count(*) FILTER (WHERE good) AS ngood, count(*) FILTER (WHERE NOT good) AS nfail,
             coalesce(list(k ORDER BY k) FILTER (WHERE good), []) AS gk, coalesce(list(t ORDER BY k) FILTER (WHERE good), []) AS gv
      FROM j GROUP BY conv_id, turn)
SELECT conv_id, turn, 'chats' AS output, 0 AS seq, gk AS entry_keys, gv AS entry_values FROM g WHERE ngood > 1
UNION ALL
SELECT conv_id, turn, 'missing', CAST(s AS INTEGER), list_sort(map_keys(m)),
       list_transform(list_sort(map_keys(m)), lambda x: m[x])
FROM g, range(0, nfail) r(s) WHERE nfail > 0
UNION ALL
SELECT conv_id, turn, 'missing', CAST(nfail AS INTEGER), gk, gv FROM g WHERE ngood <= 1
""")
def j5(spark, sf):
    turns = _turn_maps(spark, sf)
    vals = turns.select(F.explode(F.map_values("turn_map")).alias("source")).distinct()
    tr = vals.where(F.length("source") % 6 != 0).select(
        "source", F.when(F.length("source") % 6 == 1, F.lit(PLACEHOLDER))
                   .otherwise(F.concat(F.lit("T:"), F.col("source"), F.lit(" "))).alias("target"))
    out = EV.apply_translations(turns, tr, ["conv_id", "turn"], "turn_map")
    e = F.array_sort(F.map_entries("entry"))
    return out.select("conv_id", "turn", "output", F.col("seq").cast("int").alias("seq"),
                      F.transform(e, lambda x: x["key"]).alias("entry_keys"),
                      F.transform(e, lambda x: x["value"]).alias("entry_values"))


# -- G1 / G2 / G3 -------------------------------------------------------------
def _word_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": pdf["text"].fillna("").str.split().str.len().astype("int64")})


@register("G1_map_batches", sql=f"SELECT doc_id, CAST(len({s_tokens('text')}) AS BIGINT) AS n_words FROM documents")
def g1(spark, sf):
    return EV.map_batches(X.documents(spark, sf).select("doc_id", "text"), _word_counts, "doc_id bigint, n_words bigint")


def _char_encode(texts):
    return [[ord(c) % 997 + 3 for c in t] for t in texts]


@register("G2_custom_tokenizer", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn, list_transform(string_split(query, ''), lambda c: CAST(unicode(c) % 997 + 3 AS INTEGER)) AS input_ids FROM pairs
""")
def g2(spark, sf):
    tk = PandasTokenizer(_char_encode)
    return X.pairs(spark, sf).select("conv_id", "turn", tk.ids(F.col("query")).alias("input_ids"))


def _my_adapter(df):
    p, c = F.col("prompt"), F.col("chosen")
    return AD._project(df, F.concat(F.lit("Q: "), p), c, F.col("rejected"),
                       F.concat(F.lit("Q: "), p, F.lit(" A: "), c), F.concat(F.lit("Q: "), p, F.lit(" A: "), F.col("rejected")))


@register("G3_user_adapter", sql=f"""
WITH {X.PREFS_SQL}
SELECT conv_id, turn, 'Q: ' || prompt AS prompt, chosen, rejected, 'Q: ' || prompt || ' A: ' || chosen AS prompt_and_chosen,
       'Q: ' || prompt || ' A: ' || rejected AS prompt_and_rejected FROM prefs
""")
def g3(spark, sf):
    AD.register_adapter("my-org/pairs", _my_adapter)
    fn = AD.get_adapter("my-org/pairs-v2")
    return fn(X.prefs(spark, sf)).select("conv_id", "turn", *AD.OUT)
