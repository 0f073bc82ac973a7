"""Queries for multi-turn history operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions.templates import render_prompt, chat_format, sql_prompt
from weft.functions.tokens import DEFAULT_TOKENIZER as TK
from weft.operators import history as H
from weft.plans import fixtures as X
from weft.plans.catalog import lit, register

BUDGET = 1500
#: So small that rows go because of their prompt, and others because of their turn alone.
TIGHT = 300
DEFAULT = chat_format("default")
RM = H.ROLE_MARKER_STYLE
RS = H.ROUND_STYLE


def _turn_sql(q: str, a: str) -> str:
    return (f"{lit(RM['user_token'])} || coalesce({q}, '') || {lit(chr(10) + RM['assistant_token'])} || "
            f"coalesce({a}, '') || {lit(chr(10) + RM['eos_token'])}")


def _ids_or_empty(text_sql: str) -> str:
    return f"(CASE WHEN coalesce({text_sql}, '') <> '' THEN {TK.sql_ids(text_sql)} ELSE []::INTEGER[] END)"


# -- T8 ---------------------------------------------------------------------
@register("T8_history_expansion", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn,
  coalesce(list(query) OVER w, []::VARCHAR[]) AS history_queries,
  coalesce(list(response) OVER w, []::VARCHAR[]) AS history_answers
FROM pairs
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def t8(spark, sf):
    df = H.expand_history(X.pairs(spark, sf))
    return df.select("conv_id", "turn",
                     F.transform("history", lambda h: h["query"]).alias("history_queries"),
                     F.transform("history", lambda h: h["answer"]).alias("history_answers"))


@register("T8_nested_history", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, query, response, row_number() OVER w - 1 AS turn,
  coalesce(list(query) OVER b, []::VARCHAR[]) AS history_queries, coalesce(list(response) OVER b, []::VARCHAR[]) AS history_answers
FROM pairs
WINDOW w AS (PARTITION BY conv_id ORDER BY turn), b AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def t8_nested(spark, sf):
    """Rows that hold their whole chat as a nested list."""
    turn = F.struct("turn", F.col("query").alias("input"), F.col("response").alias("output"))
    out = H.expand_nested(X.pairs(spark, sf).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("chat")))
    return out.select("conv_id", "query", "response", F.col("turn").cast("bigint").alias("turn"),
                      F.transform("history", lambda h: h["query"]).alias("history_queries"),
                      F.transform("history", lambda h: h["answer"]).alias("history_answers"))


# -- T9 (flagship) + F2 ---------------------------------------------------------
def _t9_sql(budget):
    return f"""
WITH {X.PAIRS_SQL},
t AS (SELECT *, {TK.sql_count(_turn_sql('query', 'response'))} AS tl,
             CASE WHEN coalesce(prompt, '') <> '' THEN {TK.sql_count('prompt')} ELSE 0 END AS pl FROM pairs),
cur AS (SELECT * FROM t WHERE tl + pl <= {budget}),
h AS (
  SELECT c.conv_id, c.turn, p.turn AS hturn, p.query AS hq, p.response AS ha,
         c.tl + sum(p.tl) OVER (PARTITION BY c.conv_id, c.turn ORDER BY p.turn DESC
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM cur c JOIN t p ON p.conv_id = c.conv_id AND p.turn < c.turn),
kept AS (
  SELECT conv_id, turn, count(*) AS n,
         list({{'query': hq, 'answer': ha}} ORDER BY hturn) AS hist,
         flatten(list({TK.sql_ids(_turn_sql('hq', 'ha'))} ORDER BY hturn)) AS hids
  FROM h WHERE run <= {budget} GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, CAST(coalesce(k.n, 0) AS BIGINT) AS n_history,
  list_concat(list_concat({_ids_or_empty('c.prompt')}, coalesce(k.hids, []::INTEGER[])),
              {TK.sql_ids(_turn_sql('c.query', 'c.response'))}) AS input_ids,
  {sql_prompt(DEFAULT, 'c.query', 'k.hist', None)} AS prompt_text
FROM cur c LEFT JOIN kept k ON k.conv_id = c.conv_id AND k.turn = c.turn
"""


def _t9(spark, sf, budget):
    look_back = H.max_fitting_turns(budget)          # exact: no kept history can be longer
    pairs = X.pairs(spark, sf).withColumn("_n_tokens", H.turn_token_count())   # counted once per pair
    hist = H.expand_history(pairs, max_history=look_back, carry={"n_tokens": "_n_tokens"})
    df = H.fit_history(hist, budget, length_field="n_tokens", current_length="_n_tokens")
    return df.select("conv_id", "turn", F.col("n_history").cast("bigint").alias("n_history"), "input_ids",
                     render_prompt(DEFAULT, F.col("query"), F.col("kept_history")).alias("prompt_text"))


def flagship(spark, sf):
    """conversations -> pairs -> T8 history -> T9 budget fit (F2 drop) -> P4 default template."""
    return _t9(spark, sf, BUDGET)


register("T9_history_fit", sql=_t9_sql(BUDGET))(flagship)


@register("T9_history_fit_tight", sql=_t9_sql(TIGHT))
def t9_tight(spark, sf):
    return _t9(spark, sf, TIGHT)


@register("F2_budget_filter", sql=f"""
WITH {X.PAIRS_SQL},
t AS (SELECT *, {TK.sql_count(_turn_sql('query', 'response'))} AS tl,
             CASE WHEN coalesce(prompt, '') <> '' THEN {TK.sql_count('prompt')} ELSE 0 END AS pl FROM pairs)
SELECT conv_id, turn, CAST(tl + pl AS BIGINT) AS n_tokens FROM t WHERE tl + pl <= {min(2048, TIGHT)}
""")
def f2(spark, sf):
    budget = H.clamp_budget(2048, TIGHT)
    df = H.fit_history(X.pairs(spark, sf).withColumn("history", F.lit(None)), budget)
    return df.select("conv_id", "turn", F.size("input_ids").cast("bigint").alias("n_tokens"))


# -- T10 ----------------------------------------------------------------------
def _round_sql(i_sql: str) -> str:
    return f"'[Round ' || CAST({i_sql} AS VARCHAR) || ']' || {lit(chr(10) * 2)}"


def _q10(q):
    return f"{lit(RS['user_token'])} || coalesce({q}, '') || {lit(chr(10) * 2 + RS['assistant_token'])}"


def _h10(q, a):
    return f"{_q10(q)} || coalesce({a}, '') || {lit(chr(10) * 2)}"


T10_BUDGET = 1200
T10_SQL = f"""
WITH {X.PAIRS_SQL},
t AS (SELECT *,
        {_ids_or_empty('prompt')} AS head,
        {TK.sql_ids(_q10('query'))} AS q_ids,
        list_concat({TK.sql_ids("coalesce(response, '')")}, [{TK.eos_id}]) AS a_ids,
        {TK.sql_count(_h10('query', 'response'))} AS hl
      FROM pairs),
cur AS (SELECT *, len(head) + {TK.sql_count(_round_sql('1'))} + len(q_ids) + len(a_ids) AS st FROM t),
cur2 AS (SELECT * FROM cur WHERE st <= {T10_BUDGET}),
h AS (
  SELECT c.conv_id, c.turn, p.turn AS hturn, p.query AS hq, p.response AS ha,
         row_number() OVER (PARTITION BY c.conv_id, c.turn ORDER BY p.turn DESC) - 1 AS k,
         p.hl AS hl
  FROM cur2 c JOIN t p ON p.conv_id = c.conv_id AND p.turn < c.turn),
h2 AS (SELECT *, sum(hl + {TK.sql_count(_round_sql('k + 2'))}) OVER (PARTITION BY conv_id, turn ORDER BY k
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM h),
kept0 AS (SELECT h2.* FROM h2 JOIN cur2 c USING (conv_id, turn) WHERE c.st + h2.run <= {T10_BUDGET}),
kept AS (
  SELECT conv_id, turn, count(*) AS n FROM kept0 GROUP BY conv_id, turn),
body AS (
  SELECT k0.conv_id, k0.turn,
         flatten(list(list_concat({TK.sql_ids(_round_sql('(kk.n - k0.k)'))}, {TK.sql_ids(_h10('k0.hq', 'k0.ha'))})
                      ORDER BY k0.hturn)) AS b
  FROM kept0 k0 JOIN kept kk USING (conv_id, turn) GROUP BY k0.conv_id, k0.turn),
ctx AS (
  SELECT c.conv_id, c.turn, coalesce(kk.n, 0) AS n, c.a_ids,
         list_concat(list_concat(list_concat(c.head, coalesce(b.b, []::INTEGER[])),
                     {TK.sql_ids(_round_sql('coalesce(kk.n, 0) + 1'))}), c.q_ids) AS ctx
  FROM cur2 c LEFT JOIN kept kk USING (conv_id, turn) LEFT JOIN body b USING (conv_id, turn))
SELECT conv_id, turn, CAST(n AS BIGINT) AS n_history, list_concat(ctx, a_ids) AS input_ids,
       list_concat(list_transform(ctx, lambda x: -100), a_ids) AS labels
FROM ctx
"""


@register("T10_history_fit_rounds", sql=T10_SQL)
def t10(spark, sf):
    look_back = H.max_fitting_turns(T10_BUDGET, style=RS)   # markers alone bound the turns a fit can keep
    pairs = X.pairs(spark, sf).withColumn("_n_tokens", H.round_turn_token_count())
    hist = H.expand_history(pairs, max_history=look_back, carry={"n_tokens": "_n_tokens"})
    df = H.fit_history_rounds(hist, T10_BUDGET, length_field="n_tokens")
    return df.select("conv_id", "turn", F.col("n_history").cast("bigint").alias("n_history"), "input_ids", "labels")


@register("G2_encode_style", sql=T10_SQL)
def g2_style(spark, sf):
    """The same encode, picked by its style's name."""
    look_back = H.max_fitting_turns(T10_BUDGET, style=RS)
    out = H.encode_chat(H.expand_history(X.pairs(spark, sf), max_history=look_back), "rounds", T10_BUDGET)
    return out.select("conv_id", "turn", F.col("n_history").cast("bigint").alias("n_history"), "input_ids", "labels")


# -- T11 ----------------------------------------------------------------------
def _t11(x):
    return f"{lit(RM['user_token'])} || coalesce({x}, '') || {lit(RM['eos_token'])}"


T11_BUDGET = 300


@register("T11_classification_encode", sql=f"""
WITH {X.PAIRS_SQL},
c AS (SELECT conv_id, turn, query AS input, CAST(length(response) % 2 AS INTEGER) AS label,
             {TK.sql_ids(_t11('query'))} AS ids FROM pairs)
SELECT conv_id, turn, label, ids AS input_ids FROM c WHERE len(ids) <= {T11_BUDGET}
""")
def t11(spark, sf):
    df = X.pairs(spark, sf).select("conv_id", "turn", F.col("query").alias("input"),
                                   (F.length("response") % 2).cast("int").alias("label"))
    out = H.encode_classification(df, T11_BUDGET)
    return out.select("conv_id", "turn", "label", "input_ids")


# -- T12 ----------------------------------------------------------------------
T12_BUDGET = 1000


def _q12(q):
    return f"{lit(RM['user_token'])} || coalesce({q}, '') || {lit(chr(10) + RM['assistant_token'])}"


@register("T12_inference_context", sql=f"""
WITH {X.PAIRS_SQL},
t AS (SELECT *, {TK.sql_count(_turn_sql('query', 'response'))} AS tl,
             {_ids_or_empty('prompt')} AS p_ids, {TK.sql_ids(_q12('query'))} AS q_ids FROM pairs),
lk AS (  -- the conversation's first pair is locked for every later turn
  SELECT conv_id, min(turn) AS lturn FROM t GROUP BY conv_id),
c AS (
  SELECT t.*, CASE WHEN t.turn > lk.lturn THEN f.tl ELSE 0 END AS lock_len,
         CASE WHEN t.turn > lk.lturn THEN {TK.sql_ids(_turn_sql('f.query', 'f.response'))} ELSE []::INTEGER[] END AS lock_ids,
         lk.lturn
  FROM t JOIN lk USING (conv_id) JOIN t f ON f.conv_id = t.conv_id AND f.turn = lk.lturn),
c2 AS (SELECT *, len(q_ids) + len(p_ids) AS len1, len(q_ids) + len(p_ids) + lock_len AS len2 FROM c),
h AS (
  SELECT c.conv_id, c.turn, p.turn AS hturn, p.query AS hq, p.response AS ha,
         c.len2 + sum(p.tl) OVER (PARTITION BY c.conv_id, c.turn ORDER BY p.turn DESC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM c2 c JOIN t p ON p.conv_id = c.conv_id AND p.turn < c.turn AND p.turn > c.lturn
  WHERE c.len2 <= {T12_BUDGET}),
kept AS (
  SELECT conv_id, turn, count(*) AS n, flatten(list({TK.sql_ids(_turn_sql('hq', 'ha'))} ORDER BY hturn)) AS hids
  FROM h WHERE run <= {T12_BUDGET} GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn,
  CASE WHEN c.len1 > {T12_BUDGET} THEN 'query_too_long' WHEN c.len2 > {T12_BUDGET} THEN 'locked_too_long' ELSE 'ok' END AS status,
  CAST(CASE WHEN c.len2 <= {T12_BUDGET} THEN coalesce(k.n, 0) ELSE 0 END AS BIGINT) AS n_history,
  CASE WHEN c.len2 <= {T12_BUDGET} THEN
    list_concat(list_concat(list_concat(c.p_ids, c.lock_ids), coalesce(k.hids, []::INTEGER[])), c.q_ids) END AS input_ids
FROM c2 c LEFT JOIN kept k ON k.conv_id = c.conv_id AND k.turn = c.turn
""")
def t12(spark, sf):
    """Locked turn = the conversation's first pair; history = the pairs
    between it and the current one, through the bounded, chunked history
    window, with token counts carried; one index of positions serves both."""
    pairs = X.pairs(spark, sf).withColumn("_n_tokens", H.turn_token_count())
    later = H.expand_history(pairs, max_history=H.max_fitting_turns(T12_BUDGET), carry={"n_tokens": "_n_tokens"}, locked=1)
    out = H.inference_context(later, T12_BUDGET, locked="locked", length_field="n_tokens")
    return out.select("conv_id", "turn", "status", F.col("n_history").cast("bigint").alias("n_history"), "input_ids")


# -- F6 -----------------------------------------------------------------------
@register("F6_drop_missing_chat", sql=f"""
WITH {X.PAIRS_SQL},
chats AS (SELECT conv_id, list(query ORDER BY turn) AS qs FROM pairs GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(len(ch.qs) AS BIGINT) AS n_turns
FROM c JOIN chats ch USING (conv_id)
""")
def f6(spark, sf):
    """Conversations nested as a turn list (null when no complete pair), then F6."""
    p = X.pairs(spark, sf)
    nested = p.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "query"))).alias("chat"))
    convs = X.conversations(spark, sf).select("conv_id").distinct()
    df = convs.join(nested, "conv_id", "left")
    return H.drop_missing_chat(df).select("conv_id", F.size("chat").cast("bigint").alias("n_turns"))


# -- W1 -----------------------------------------------------------------------
@register("W1_cumulative_questions", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn,
  coalesce(string_agg('input: ' || query || 'output: ' || response, '') OVER (
     PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || 'input: ' || query AS question
FROM pairs
""")
def w1(spark, sf):
    return H.cumulative_questions(X.pairs(spark, sf)).select("conv_id", "turn", "question")


# -- W6 -----------------------------------------------------------------------
W6_STUDENT = "Ask the teacher your next question.\n"
W6_TEACHER = "Answer the student's last question.\n"
W6_PROFILER = "Dialog so far:\n{dialog}\nPrevious profile: {user_profile}\nUpdate the profile."


def _w6_sql():
    before = ("coalesce(string_agg('<student>: ' || query || {nl} || '</student>' || {nl} || "
              "'<teacher>: ' || response || {nl} || '</teacher>' || {nl}, '') OVER wb, '')").format(nl=lit(chr(10)))
    sline = "'<student>: ' || query || {nl} || '</student>' || {nl}".format(nl=lit(chr(10)))
    tline = "'<teacher>: ' || response || {nl} || '</teacher>' || {nl}".format(nl=lit(chr(10)))
    pre, rest = W6_PROFILER.split("{dialog}")
    mid, post = rest.split("{user_profile}")
    return f"""
WITH {X.PAIRS_SQL},
b AS (SELECT *, {before} AS bf, {sline} AS sl, {tline} AS tl,
             'turn_' || CAST(row_number() OVER w AS VARCHAR) AS key FROM pairs
      WINDOW wb AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, key, {lit(W6_STUDENT)} || bf AS student_prompt, {lit(W6_TEACHER)} || bf || sl AS teacher_prompt,
       bf || sl || tl AS transcript,
       {lit(pre)} || bf || sl || {lit(mid)} || coalesce(prompt, '') || {lit(post)} AS profiler_prompt
FROM b
"""


@register("W6_role_play_transcript", sql=_w6_sql())
def w6(spark, sf):
    df = H.role_play_transcript(X.pairs(spark, sf), W6_STUDENT, W6_TEACHER, W6_PROFILER, profile="prompt")
    return df.select("conv_id", "turn", "key", "student_prompt", "teacher_prompt", "transcript", "profiler_prompt")
