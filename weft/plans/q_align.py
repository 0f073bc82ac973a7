"""Queries for alignment, templates and preference adapters
(P1-P18, F1, F3, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions.templates import render_dialog, render_prompt, chat_format, sql_dialog, sql_prompt, format_names
from weft.operators import adapters as AD
from weft.operators import align as AL
from weft.operators.history import expand_history
from weft.plans import fixtures as X
from weft.plans.catalog import lit, register

NL = chr(10)

# -- P1 / P2 / F1 -------------------------------------------------------------
@register("P1_align_columns", sql=f"""
WITH {X.INSTRUCTIONS_SQL}
SELECT conv_id, turn, instruction AS prompt, input AS query, output AS response,
       CAST(NULL AS VARCHAR) AS history_text, 'src: ' AS prefix
FROM instructions
""")
def p1(spark, sf):
    df = AL.align(X.instructions(spark, sf), "instruction", "input", "output", None, prefix="src: ")
    return df.select("conv_id", "turn", "prompt", "query", "response",
                     F.col("history")[0]["query"].alias("history_text"), "prefix")


@register("P2_dialog_query", sql=f"""
WITH {X.INSTRUCTIONS_SQL}
SELECT conv_id, turn,
  CASE WHEN length(input) > 0 THEN instruction || {lit(NL)} || input ELSE instruction END AS dialog_query,
  CASE WHEN conv_id % 3 = 0 THEN 'p' ELSE '' END AS prefix
FROM instructions
""")
def p2(spark, sf):
    df = AL.align(X.instructions(spark, sf), "instruction", "input", "output")
    df = df.withColumn("prefix", F.when(F.col("conv_id") % 3 == 0, "p"))
    return df.select("conv_id", "turn", AL.dialog_query().alias("dialog_query"), AL.clean_prefix().alias("prefix"))


F1_INPUT_SQL = f"""{X.INSTRUCTIONS_SQL},
f1 AS (SELECT conv_id, turn,
         CASE WHEN conv_id % 7 = 0 THEN '' ELSE instruction END AS prompt,
         CASE WHEN conv_id % 5 = 0 THEN NULL ELSE output END AS response FROM instructions)"""


@register("F1_nonempty_filter", sql=f"""
WITH {F1_INPUT_SQL}
SELECT conv_id, turn, prompt, response FROM f1 WHERE length(prompt) > 0 AND length(response) > 0
""")
def f1(spark, sf):
    df = X.instructions(spark, sf).select(
        "conv_id", "turn",
        F.when(F.col("conv_id") % 7 == 0, "").otherwise(F.col("instruction")).alias("prompt"),
        F.when(F.col("conv_id") % 5 == 0, F.lit(None)).otherwise(F.col("output")).alias("response"))
    return AL.keep_nonempty(df)


# -- P3 (one query per template) / P4 / P5 -------------------------------------
HIST_SQL = f"""{X.PAIRS_SQL},
ph AS (SELECT *, list({{'query': query, 'answer': response}}) OVER (PARTITION BY conv_id ORDER BY turn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history,
          CASE WHEN conv_id % 4 = 0 THEN 'Context ' || CAST(conv_id AS VARCHAR) ELSE NULL END AS prefix
       FROM pairs)"""


def _hist(spark, sf):
    return expand_history(X.pairs(spark, sf)).withColumn(
        "prefix", F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("Context "), F.col("conv_id").cast("string"))))


def _p3(name):
    t = chat_format(name)

    def build(spark, sf):
        df = _hist(spark, sf)
        return df.select("conv_id", "turn", render_dialog(t, F.col("query"), F.col("response"), F.col("history"),
                                                      AL.clean_prefix()).alias("dialog"))

    register(f"P3_dialog_{name}", sql=f"""
WITH {HIST_SQL}
SELECT conv_id, turn, {sql_dialog(t, 'query', 'response', 'history', 'prefix')} AS dialog FROM ph
""")(build)


for _name in format_names():
    _p3(_name)


@register("P4_prompt_default", sql=f"""
WITH {HIST_SQL}
SELECT conv_id, turn, {sql_prompt(chat_format('default'), 'query', 'history', 'prefix')} AS prompt_text FROM ph
""")
def p4(spark, sf):
    df = _hist(spark, sf)
    return df.select("conv_id", "turn", render_prompt(chat_format("default"), F.col("query"), F.col("history"),
                                                   AL.clean_prefix()).alias("prompt_text"))


@register("P5_template_registry", sql="WITH " + HIST_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT conv_id, turn, {lit(n)} AS template, {sql_prompt(chat_format(n), 'query', 'history', 'prefix')} AS prompt_text FROM ph"
    for n in format_names()))
def p5(spark, sf):
    df = _hist(spark, sf)
    # every registered template rendered in one projection and exploded: the
    # input is read and windowed once (a union would recompute it per template)
    rendered = F.array(*[F.struct(F.lit(n).alias("template"),
                                  render_prompt(chat_format(n), F.col("query"), F.col("history"),
                                             AL.clean_prefix()).alias("prompt_text"))
                         for n in format_names()])
    return df.select("conv_id", "turn", F.explode(rendered).alias("_t")).select("conv_id", "turn", "_t.template", "_t.prompt_text")


# -- P6..P17 adapters ---------------------------------------------------------
def _adapter_sql(src_sql: str, prompt: str, chosen: str, rejected: str, pc: str, pr: str) -> str:
    return f"""
WITH {X.PREFS_SQL},
src AS ({src_sql})
SELECT conv_id, turn, {prompt} AS prompt, {chosen} AS chosen, {rejected} AS rejected,
       {pc} AS prompt_and_chosen, {pr} AS prompt_and_rejected
FROM src
"""


def _out(df):
    return df.select("conv_id", "turn", *AD.OUT)


H, A, AS = lit(AD.HUMAN), lit(AD.ASSISTANT), lit(AD.ASSISTANT_SP)


@register("P6_adapter_identity", sql=_adapter_sql(
    "SELECT * FROM prefs", "prompt", "chosen", "rejected", "prompt || chosen", "prompt || rejected"))
def p6(spark, sf):
    return _out(AD.identity_pairs(X.prefs(spark, sf)))


P7_SQL = _adapter_sql("SELECT * FROM prefs", f"{H} || prompt || {A}", "' ' || chosen", "' ' || rejected",
                      f"{H} || prompt || {AS} || chosen", f"{H} || prompt || {AS} || rejected")


@register("P7_adapter_wrapped", sql=P7_SQL)
def p7(spark, sf):
    return _out(AD.wrapped_pairs(X.prefs(spark, sf)))


def _p8_src(c):
    return F.when(F.col("conv_id") % 3 == 0, F.col(c)).otherwise(
        F.concat(F.lit("Human: "), F.col("prompt"), F.lit(" Assistant: "), F.col(c)))


@register("P8_adapter_last_assistant", sql=_adapter_sql(
    """SELECT conv_id, turn, prompt,
         CASE WHEN conv_id % 3 = 0 THEN chosen ELSE 'Human: ' || prompt || ' Assistant: ' || chosen END AS chosen,
         CASE WHEN conv_id % 3 = 0 THEN rejected ELSE 'Human: ' || prompt || ' Assistant: ' || rejected END AS rejected
       FROM prefs""",
    "prompt || 'Assistant:'", "string_split(chosen, 'Assistant:')[-1]", "string_split(rejected, 'Assistant:')[-1]",
    "prompt || chosen", "prompt || rejected"))
def p8(spark, sf):
    df = X.prefs(spark, sf).withColumn("chosen", _p8_src("chosen")).withColumn("rejected", _p8_src("rejected"))
    return _out(AD.last_assistant_pairs(df))


def _strip_sql(x):
    return (f"regexp_replace(regexp_replace({x}, {lit(AD.CITE_WITH_SPACE)}, '', 'g'), {lit(AD.CITE)}, '', 'g')")


@register("P9_adapter_scored", sql=_adapter_sql(
    """SELECT conv_id, turn, prompt AS full_text,
         chosen || ' [' || CAST(turn AS VARCHAR) || '] (see ' || CAST(conv_id AS VARCHAR) || ')' AS answer_0,
         coalesce(rejected, '') || ' [2]' AS answer_1,
         length(chosen) / 100.0 AS score_0,
         CASE WHEN conv_id % 5 = 0 THEN length(chosen) / 100.0 ELSE length(coalesce(rejected, '')) / 100.0 END AS score_1
       FROM prefs""",
    f"{H} || full_text || {A}",
    f"' ' || {_strip_sql('CASE WHEN score_0 >= score_1 THEN answer_0 ELSE answer_1 END')}",
    f"' ' || {_strip_sql('CASE WHEN score_0 < score_1 THEN answer_0 ELSE answer_1 END')}",
    f"{H} || full_text || {AS} || {_strip_sql('CASE WHEN score_0 >= score_1 THEN answer_0 ELSE answer_1 END')}",
    f"{H} || full_text || {AS} || {_strip_sql('CASE WHEN score_0 < score_1 THEN answer_0 ELSE answer_1 END')}"))
def p9(spark, sf):
    p = X.prefs(spark, sf)
    rej = F.coalesce(F.col("rejected"), F.lit(""))
    df = p.select(
        "conv_id", "turn", F.struct(F.col("prompt").alias("full_text")).alias("question"),
        F.concat(F.col("chosen"), F.lit(" ["), F.col("turn").cast("string"), F.lit("] (see "),
                 F.col("conv_id").cast("string"), F.lit(")")).alias("answer_0"),
        F.concat(rej, F.lit(" [2]")).alias("answer_1"),
        (F.length("chosen") / 100.0).alias("score_0"),
        F.when(F.col("conv_id") % 5 == 0, F.length("chosen") / 100.0).otherwise(F.length(rej) / 100.0).alias("score_1"))
    return _out(AD.scored_pairs(df))


@register("P10_adapter_labelled", sql=_adapter_sql(
    """SELECT conv_id, turn, prompt AS history, chosen AS a, coalesce(rejected, '') AS b, conv_id % 2 AS labels FROM prefs""",
    f"{H} || history || {A}",
    "' ' || CASE WHEN labels = 1 THEN a ELSE b END", "' ' || CASE WHEN labels = 1 THEN b ELSE a END",
    f"{H} || history || {AS} || CASE WHEN labels = 1 THEN a ELSE b END",
    f"{H} || history || {AS} || CASE WHEN labels = 1 THEN b ELSE a END"))
def p10(spark, sf):
    df = X.prefs(spark, sf).select("conv_id", "turn", F.col("prompt").alias("history"),
                                   F.col("chosen").alias("human_ref_A"),
                                   F.coalesce("rejected", F.lit("")).alias("human_ref_B"),
                                   (F.col("conv_id") % 2).alias("labels"))
    return _out(AD.labelled_pairs(df))


@register("P11_adapter_renamed_roles", sql=_adapter_sql(
    """SELECT conv_id, turn,
         CASE WHEN conv_id % 4 = 0 THEN '' ELSE 'USER: ' || prompt || ' ASSISTANT:' END AS p,
         CASE WHEN conv_id % 6 = 0 THEN NULL ELSE chosen END AS label FROM prefs""",
    "CASE WHEN length(p) > 0 THEN replace(replace(p, 'USER', 'Human'), 'ASSISTANT', 'Assistant') END",
    "CASE WHEN length(label) > 0 THEN ' ' || label END", "CAST(NULL AS VARCHAR)",
    "CASE WHEN length(p) > 0 AND length(label) > 0 THEN replace(replace(p, 'USER', 'Human'), 'ASSISTANT', 'Assistant') || ' ' || label END",
    "CAST(NULL AS VARCHAR)"))
def p11(spark, sf):
    df = X.prefs(spark, sf).select(
        "conv_id", "turn",
        F.when(F.col("conv_id") % 4 == 0, "").otherwise(F.concat(F.lit("USER: "), F.col("prompt"), F.lit(" ASSISTANT:"))).alias("prompt"),
        F.when(F.col("conv_id") % 6 == 0, F.lit(None)).otherwise(F.col("chosen")).alias("label"))
    return _out(AD.renamed_roles(df))


@register("P12_adapter_local_json", sql=_adapter_sql(
    "SELECT * FROM prefs", "' ' || prompt", "' ' || chosen", "' ' || rejected",
    "' ' || prompt || ' ' || chosen", "' ' || prompt || ' ' || rejected"))
def p12(spark, sf):
    return _out(AD.local_json_pairs(X.prefs(spark, sf)))


@register("P13_adapter_instruction_response", sql=_adapter_sql(
    "SELECT * FROM prefs", f"{H} || prompt || {A}", "' ' || chosen", "CAST(NULL AS VARCHAR)",
    f"{H} || prompt || {AS} || chosen", "CAST(NULL AS VARCHAR)"))
def p13(spark, sf):
    df = X.prefs(spark, sf).select("conv_id", "turn", F.col("prompt").alias("INSTRUCTION"), F.col("chosen").alias("RESPONSE"))
    return _out(AD.instruction_response(df))


@register("P14_adapter_passages", sql=_adapter_sql(
    """SELECT conv_id, turn, prompt AS query, [{'text': chosen}] AS pos,
         CASE WHEN rejected IS NULL THEN [] ELSE [{'text': rejected}] END AS neg FROM prefs""",
    f"{H} || query || {A}", "' ' || pos[1].text", "' ' || neg[1].text",
    f"{H} || query || {AS} || pos[1].text", f"{H} || query || {AS} || neg[1].text"))
def p14(spark, sf):
    st = "array<struct<text:string>>"
    df = X.prefs(spark, sf).select(
        "conv_id", "turn", F.col("prompt").alias("query"),
        F.array(F.struct(F.col("chosen").alias("text"))).alias("positive_passages"),
        F.when(F.col("rejected").isNull(), F.array().cast(st))
         .otherwise(F.array(F.struct(F.col("rejected").alias("text")))).alias("negative_passages"))
    return _out(AD.passages(df))


@register("P15_adapter_first_answer", sql=_adapter_sql(
    "SELECT conv_id, turn, prompt AS question, [chosen, rejected] AS answers FROM prefs",
    f"{H} || question || {A}", "' ' || answers[1]", "CAST(NULL AS VARCHAR)",
    f"{H} || question || {AS} || answers[1]", "CAST(NULL AS VARCHAR)"))
def p15(spark, sf):
    df = X.prefs(spark, sf).select("conv_id", "turn", F.col("prompt").alias("question"),
                                   F.array("chosen", "rejected").alias("human_answers"))
    return _out(AD.first_answer(df))


@register("P16_adapter_multilingual", sql=_adapter_sql(
    "SELECT conv_id, turn, {'zh_cn': prompt} AS queries, {'zh_cn': [{'text': chosen}]} AS answers FROM prefs",
    f"{H} || queries.zh_cn || {A}", "' ' || answers.zh_cn[1].text", "CAST(NULL AS VARCHAR)",
    f"{H} || queries.zh_cn || {AS} || answers.zh_cn[1].text", "CAST(NULL AS VARCHAR)"))
def p16(spark, sf):
    df = X.prefs(spark, sf).select(
        "conv_id", "turn", F.struct(F.col("prompt").alias("zh_cn")).alias("queries"),
        F.struct(F.array(F.struct(F.col("chosen").alias("text"))).alias("zh_cn")).alias("answers"))
    return _out(AD.multilingual("zh_cn")(df))


@register("P17_adapter_dispatch", sql=P7_SQL)
def p17(spark, sf):
    fn = AD.get_adapter("Dahoas/synthetic-instruct-gptj-pairwise")
    return _out(fn(X.prefs(spark, sf)))


@register("F3_drop_null_sides", sql=f"""
WITH {X.PREFS_SQL}
SELECT conv_id, turn, prompt || chosen AS prompt_and_chosen, prompt || rejected AS prompt_and_rejected
FROM prefs WHERE rejected IS NOT NULL
""")
def f3(spark, sf):
    df = AD.drop_null_sides(AD.identity_pairs(X.prefs(spark, sf)), phase=2)
    return df.select("conv_id", "turn", "prompt_and_chosen", "prompt_and_rejected")


# -- P18 ----------------------------------------------------------------------
@register("P18_chat_messages", sql=f"""
WITH {HIST_SQL},
m AS (SELECT conv_id, turn,
  list_concat(list_concat(
    CASE WHEN length(prompt) > 0 THEN [{{'role': 'system', 'content': prompt}}] ELSE [] END,
    coalesce(flatten(list_transform(history, lambda h: [{{'role': 'user', 'content': h.query}},
                                                        {{'role': 'assistant', 'content': h.answer}}])), [])),
    [{{'role': 'user', 'content': query}}]) AS msgs FROM ph)
SELECT conv_id, turn, list_transform(msgs, lambda x: x.role) AS roles,
       list_transform(msgs, lambda x: x.content) AS contents FROM m
""")
def p18(spark, sf):
    df = _hist(spark, sf)
    msgs = AL.chat_messages(F.col("prompt"), None, F.col("history"), F.col("query"))
    return df.select("conv_id", "turn", F.transform(msgs, lambda m: m["role"]).alias("roles"),
                     F.transform(msgs, lambda m: m["content"]).alias("contents"))


# -- U1 -----------------------------------------------------------------------
@register("U1_concat_aligned", sql=f"""
WITH {X.INSTRUCTIONS_SQL}
SELECT conv_id, turn, CAST(NULL AS BIGINT) AS doc_id, instruction AS prompt, input AS query, output AS response, 'chat' AS prefix
FROM instructions
UNION ALL
SELECT NULL, NULL, doc_id, text, NULL, NULL, 'doc' FROM documents
""")
def u1(spark, sf):
    a = AL.align(X.instructions(spark, sf), "instruction", "input", "output", prefix="chat").drop("history")
    b = AL.align(X.documents(spark, sf).select("doc_id", "text"), "text", None, None, prefix="doc").drop("history")
    return AL.concat_aligned([a, b]).select("conv_id", "turn", "doc_id", "prompt", "query", "response", "prefix")
