"""Queries for text cleaning and extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import text as TX
from weft.plans import fixtures as X
from weft.plans.catalog import lit, register
from weft.session import read_table

NL = chr(10)
WS = TX.WS


def _tweets(spark, sf):
    """Documents with injected retweet prefixes, &amp;, mentions, links
    (page urls) and hash tags, so every cleaning step has work to do."""
    d = X.documents(spark, sf).select("doc_id", "text")
    p = read_table(spark, sf, "pages").select(F.col("page_id"), "url")
    d = d.join(p, F.col("page_id") == F.col("doc_id"), "left")
    text = F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit("RT ")).otherwise(F.lit("")),
                    F.col("text"), F.lit(" &amp; @user"), F.col("doc_id").cast("string"), F.lit(" "),
                    F.coalesce(F.col("url"), F.lit("")),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("\n#tag done")).otherwise(F.lit("")))
    return d.select("doc_id", text.alias("text"))


TWEETS_SQL = f"""tw AS (
  SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN 'RT ' ELSE '' END || d.text || ' &amp; @user' ||
         CAST(d.doc_id AS VARCHAR) || ' ' || coalesce(p.url, '') ||
         CASE WHEN d.doc_id % 2 = 0 THEN {lit(NL + '#tag done')} ELSE '' END AS text
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""


def _re(x, pat, rep="' '"):
    return f"regexp_replace({x}, {lit(pat)}, {rep}, 'g')"


def s_amp(x):
    return f"replace({x}, '&amp;', ' ')"


def s_links(x):
    return _re(x, TX.LINK)


def s_hash(x):
    return f"replace({x}, '#', ' ')"


def s_rt(x):
    return f"regexp_replace({x}, {lit(TX.RETWEET)}, ' ')"


def s_mention(x):
    return _re(x, TX.MENTION)


def s_spaces(x):
    return _re(x, WS + "+")


def s_punct(x):
    return _re(x, TX.PUNCT_CLASS, "''")


def s_strip(x):
    return _re(x, f"^{WS}+|{WS}+\\z", "''")


STOP_SQL = "[" + ", ".join(lit(w) for w in TX.STOP_WORDS) + "]"


def s_tokens(x):
    return f"list_filter(regexp_split_to_array({x}, {lit(WS + '+')}), lambda t: t <> '')"


def s_clean(x, lower=False, numbers=False):
    y = s_spaces(s_mention(s_rt(s_hash(s_links(s_amp(x))))))
    if lower:
        y = f"lower({y})"
    y = s_punct(y)
    if numbers:
        y = _re(y, TX.DIGITS)
    return s_strip(f"array_to_string(list_filter({s_tokens(y)}, lambda t: NOT list_contains({STOP_SQL}, t)), ' ')")


def _step(name, col_fn, sql_fn, doc):
    def build(spark, sf):
        return _tweets(spark, sf).select("doc_id", col_fn(F.col("text")).alias("text"))

    build.__doc__ = doc
    register(name, sql=f"WITH {TWEETS_SQL} SELECT doc_id, {sql_fn('text')} AS text FROM tw")(build)


_step("C1_clean_tweet", TX.clean_tweet, s_clean, "C1 chain")
_step("C2_remove_amp", TX.remove_amp, s_amp, "C2")
_step("C3_remove_links", TX.remove_links, s_links, "C3")
_step("C4_remove_hashes", TX.remove_hashes, s_hash, "C4")
_step("C5_remove_retweets", TX.remove_retweets, s_rt, "C5")
_step("C6_remove_mentions", TX.remove_mentions, s_mention, "C6")
_step("C7_collapse_spaces", TX.collapse_spaces, s_spaces, "C7")
_step("C8_remove_punctuation", TX.remove_punctuation, s_punct, "C8")
_step("C9_stop_words", lambda c: F.array_join(TX.drop_stop_words(TX.word_tokens(c)), " "),
      lambda x: f"array_to_string(list_filter({s_tokens(x)}, lambda t: NOT list_contains({STOP_SQL}, t)), ' ')", "C9")
_step("C10_clean_lower_numbers", lambda c: TX.clean_tweet(c, lower=True, numbers=True),
      lambda x: s_clean(x, lower=True, numbers=True), "C10 options on")


@register("C11_split_links", sql=f"""
WITH {TWEETS_SQL},
s AS (SELECT doc_id, string_split(text, 'http') AS parts FROM tw)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, CASE WHEN i > 1 THEN 'http' || parts[i] ELSE parts[i] END AS piece
FROM s, range(1, len(parts) + 1) r(i)
""")
def c11(spark, sf):
    t = _tweets(spark, sf)
    return t.select("doc_id", F.posexplode(TX.split_links(F.col("text"))).alias("pos", "piece"))


# -- C12 - C14 ------------------------------------------------------------------
def _dialog_text():
    q = F.col("query")
    a = F.col("response")
    return F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("student: "), q)).otherwise(
        F.concat(F.lit("<dialog><student> "), q, F.lit(" </student>\n<teacher>"), a, F.lit("</teacher></dialog>")))


DIALOG_TEXT_SQL = (f"CASE WHEN conv_id % 3 = 0 THEN 'student: ' || query ELSE "
                   f"'<dialog><student> ' || query || {lit(' </student>' + NL + '<teacher>')} || "
                   f"response || '</teacher></dialog>' END")


def _tag_sql(kind):
    pat = f"<{kind}>([^\\n]*)</{kind}>"
    fb = "x"
    for tag in (f"<{kind}>", f"</{kind}>", "</dialog>", "<dialog>", ":"):
        fb = f"replace({fb}, {lit(tag)}, '')"
    return (f"CASE WHEN regexp_matches(x, {lit(pat)}) THEN {s_strip(f'regexp_extract(x, {lit(pat)}, 1)')} "
            f"ELSE {fb} END")


@register("C12_extract_tagged", sql=f"""
WITH {X.PAIRS_SQL},
d AS (SELECT conv_id, turn, {DIALOG_TEXT_SQL} AS x FROM pairs)
SELECT conv_id, turn, {_tag_sql('student')} AS student, {_tag_sql('teacher')} AS teacher FROM d
""")
def c12(spark, sf):
    d = X.pairs(spark, sf).select("conv_id", "turn", _dialog_text().alias("x"))
    return d.select("conv_id", "turn", TX.extract_tagged(F.col("x"), "student").alias("student"),
                    TX.extract_tagged(F.col("x"), "teacher").alias("teacher"))


@register("C13_cut_response", sql=f"""
WITH {X.PAIRS_SQL},
g AS (SELECT conv_id, turn, conv_id % 3 AS n,
        replace(response || '<|endoftext|></s>' || ' Human: ' || query || ' Human: again', '<|endoftext|></s>', '') AS o
      FROM pairs)
SELECT conv_id, turn, array_to_string(list_slice(string_split(o, 'Human: '), 1, n + 1), 'Human: ') AS output FROM g
""")
def c13(spark, sf):
    p = X.pairs(spark, sf)
    gen = F.concat(F.col("response"), F.lit("<|endoftext|></s>"), F.lit(" Human: "), F.col("query"), F.lit(" Human: again"))
    return p.select("conv_id", "turn", TX.cut_response(gen, F.col("conv_id") % 3).alias("output"))


@register("C14_after_last_marker", sql=f"""
WITH {X.PAIRS_SQL},
g AS (SELECT conv_id, turn, query || '<reserved_103>' || response AS a,
             query || '<|assistant|>: ' || response AS b FROM pairs)
SELECT conv_id, turn, string_split(a, '<reserved_103>')[-1] AS answer,
       CASE WHEN length(string_split(b, '<|assistant|>: ')[-1]) > 8
            THEN substr(string_split(b, '<|assistant|>: ')[-1], 1, length(string_split(b, '<|assistant|>: ')[-1]) - 8)
            ELSE '' END AS api_answer
FROM g
""")
def c14(spark, sf):
    p = X.pairs(spark, sf)
    a = F.concat(F.col("query"), F.lit("<reserved_103>"), F.col("response"))
    b = F.concat(F.col("query"), F.lit("<|assistant|>: "), F.col("response"))
    return p.select("conv_id", "turn", TX.after_last(a, "<reserved_103>").alias("answer"),
                    TX.after_last_api(b).alias("api_answer"))


# -- F4 -----------------------------------------------------------------------
@register("F4_turn_quality", sql=f"""
WITH {X.PAIRS_SQL},
m AS (SELECT conv_id, turn,
        CASE WHEN conv_id % 10 = 0 THEN MAP {{'dany_input': CAST(conv_id AS VARCHAR), 'output': response}}
             ELSE MAP {{'input': CASE WHEN turn % 4 = 1 THEN CAST(turn AS VARCHAR) ELSE query END, 'output': response}} END AS m
      FROM pairs)
SELECT conv_id, turn FROM m
WHERE len(list_filter(map_values(m), lambda v: len({s_tokens('v')}) <= 1)) = 0
   OR len(list_filter(map_keys(m), lambda k: contains(k, 'dany') OR contains(k, '霍金'))) > 0
""")
def f4(spark, sf):
    p = X.pairs(spark, sf)
    m = F.when(F.col("conv_id") % 10 == 0, F.create_map(F.lit("dany_input"), F.col("conv_id").cast("string"),
                                                        F.lit("output"), F.col("response"))) \
        .otherwise(F.create_map(F.lit("input"), F.when(F.col("turn") % 4 == 1, F.col("turn").cast("string")).otherwise(F.col("query")),
                                F.lit("output"), F.col("response")))
    return p.where(TX.turn_passes(m)).select("conv_id", "turn")
