"""Queries for metrics and running statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER as TK, IGNORE_INDEX, TOKEN_PATTERN
from weft.operators import metrics as M
from weft.operators.split import ordered_index
from weft.plans import fixtures as X
from weft.plans.catalog import lit, register
from weft.session import read_table

R6 = 6


def _scores(spark, sf):
    p = X.prefs(spark, sf).where(F.col("rejected").isNotNull())
    return p.select("conv_id", "turn", (F.length("chosen") / 100.0).alias("accept"),
                    (F.length("rejected") / 100.0).alias("reject"))


SCORES_SQL = X.PREFS_SQL + """,
scores AS (SELECT conv_id, turn, length(chosen) / 100.0 AS accept, length(rejected) / 100.0 AS reject
           FROM prefs WHERE rejected IS NOT NULL)"""


# -- A1 -----------------------------------------------------------------------
@register("A1_dialogue_length_buckets", sql=f"""
WITH {X.PAIRS_SQL},
l AS (SELECT conv_id, sum(length(query) + length(response)) AS n FROM pairs GROUP BY conv_id)
SELECT count(*) FILTER (WHERE n < 1024) AS lt_1024, count(*) FILTER (WHERE n > 1024) AS gt_1024,
       count(*) FILTER (WHERE n > 2048) AS gt_2048, count(*) FILTER (WHERE n > 4096) AS gt_4096 FROM l
""")
def a1(spark, sf):
    return M.dialogue_length_buckets(X.pairs(spark, sf))


# -- A3 / A4 / A5 -------------------------------------------------------------
@register("A3_preference_accuracy", sql=f"""
WITH {SCORES_SQL}
SELECT round(avg(CASE WHEN accept > reject THEN 1.0 ELSE 0.0 END), {R6}) AS accuracy FROM scores
""")
def a3(spark, sf):
    return M.preference_accuracy(_scores(spark, sf)).select(F.round("accuracy", R6).alias("accuracy"))


@register("A4_reward_evaluation", sql=f"""
WITH {SCORES_SQL}
SELECT round(avg(CASE WHEN accept > reject THEN 1.0 ELSE 0.0 END), {R6}) AS accuracy, round(avg(accept), {R6}) AS chosen_mean,
       round(avg(reject), {R6}) AS rejected_mean FROM scores
""")
def a4(spark, sf):
    out = M.reward_evaluation(_scores(spark, sf))
    return out.select(*[F.round(c, R6).alias(c) for c in out.columns])


@register("A4_batch_means", sql=f"""
WITH {SCORES_SQL},
b AS (SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 4 AS batch_id FROM scores),
per AS (SELECT batch_id, count(*) FILTER (WHERE accept > reject) AS c, count(*) AS n,
               avg(accept) AS a, avg(reject) AS r FROM b GROUP BY batch_id)
SELECT round(sum(c) / sum(n), {R6}) AS accuracy, round(avg(a), {R6}) AS chosen_mean,
       round(avg(r), {R6}) AS rejected_mean FROM per
""")
def a4_batches(spark, sf):
    s = ordered_index(_scores(spark, sf), ["conv_id", "turn"])
    out = M.reward_evaluation(s.withColumn("batch_id", F.floor(F.col("row_idx") / 4)), "batch_id", batch_means=True)
    return out.select(*[F.round(c, R6).alias(c) for c in out.columns])


@register("A5_pairwise_loss", sql=f"""
WITH {SCORES_SQL}
SELECT round(avg(ln(1 + exp(reject - accept))), {R6}) AS loss FROM scores
""")
def a5(spark, sf):
    return M.pairwise_loss(_scores(spark, sf)).select(F.round("loss", R6).alias("loss"))


# -- A6 -----------------------------------------------------------------------
@register("A6_token_accuracy", sql=f"""
WITH {X.PREDICTIONS_SQL},
j AS (SELECT pr.conv_id, pr.turn, {TK.sql_ids('pr.text')} AS p0, {TK.sql_ids('pa.response')} AS l0
      FROM predictions pr JOIN pairs pa USING (conv_id, turn) WHERE pr.model = 'm1'),
w AS (SELECT *, greatest(len(p0), len(l0)) AS w FROM j),
pad AS (SELECT w, list_concat(p0, list_transform(range(w - len(p0)), lambda x: 0)) AS p,
               list_concat(l0, list_transform(range(w - len(l0)), lambda x: {IGNORE_INDEX})) AS l FROM w),
h AS (SELECT len(list_filter(range(1, w), lambda i: p[i] = l[i + 1])) AS hit, greatest(w - 1, 0) AS n FROM pad)
SELECT round(sum(hit) / sum(n), {R6}) AS accuracy, CAST(sum(n) AS BIGINT) AS n FROM h
""")
def a6(spark, sf):
    pr = X.predictions(spark, sf).where(F.col("model") == "m1")
    j = pr.join(X.pairs(spark, sf), ["conv_id", "turn"])
    j = j.select(TK.ids(F.col("text")).alias("p0"), TK.ids(F.col("response")).alias("l0"))
    j = j.withColumn("w", F.greatest(F.size("p0"), F.size("l0")))
    j = j.select(F.concat("p0", F.array_repeat(F.lit(0), F.col("w") - F.size("p0"))).alias("preds"),
                 F.concat("l0", F.array_repeat(F.lit(IGNORE_INDEX), F.col("w") - F.size("l0"))).alias("labels"))
    out = M.token_accuracy(j)
    return out.select(F.round("accuracy", R6).alias("accuracy"), "n")


# -- A7 / W3 ------------------------------------------------------------------
@register("A7_weighted_average", sql=f"""
SELECT event_type, round(sum(value * (user_id % 5 + 1)) / sum(user_id % 5 + 1), {R6}) AS avg,
       CAST(sum(user_id % 5 + 1) AS BIGINT) AS count
FROM events GROUP BY event_type
""")
def a7(spark, sf):
    e = read_table(spark, sf, "events").withColumn("n", F.col("user_id") % 5 + 1)
    out = M.weighted_average(e, ["event_type"], "value", "n")
    return out.select("event_type", F.round("avg", R6).alias("avg"), "count")


@register("W3_cumulative_mean", sql=f"""
WITH v AS (SELECT event_id, event_type, CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) AS cents FROM events),
s AS (SELECT event_id, event_type, sum(cents) OVER w * 10000 AS num, count(*) OVER w AS n FROM v
      WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
-- exact decimal mean rounded half away from zero to 6 places
SELECT event_id, event_type, CAST(sign(num) * ((abs(num) * 2 + n) // (2 * n)) AS DOUBLE) / 1000000.0 AS mean FROM s
""")
def w3(spark, sf):
    """Values are cents (DECIMAL(18,2)) so running sums are exact on both engines."""
    e = read_table(spark, sf, "events").select("event_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    out = M.cumulative_mean(e, "event_type", "event_id", "value", chunk=512)
    return out.select("event_id", "event_type", F.round("mean", R6).cast("double").alias("mean"))


# -- W2 -----------------------------------------------------------------------
W2_METRIC = "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END"


@register("W2_smooth", sql=f"""
WITH s AS (SELECT event_type, event_id, {W2_METRIC} AS v FROM events),
k AS (SELECT event_type, event_id, v, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS pos,
             count(*) OVER (PARTITION BY event_type) AS len FROM s WHERE v IS NOT NULL),
w AS (SELECT *, 1.8 * (1.0 / (1.0 + exp(-0.05 * len)) - 0.5) AS w FROM k)
SELECT t.event_type, t.event_id, t.v AS value,
  round(sum(CASE WHEN x.pos = 0 THEN pow(t.w, t.pos) * x.v ELSE (1 - t.w) * pow(t.w, t.pos - x.pos) * x.v END), {R6}) AS smoothed
FROM w t JOIN w x ON x.event_type = t.event_type AND x.pos <= t.pos
GROUP BY t.event_type, t.event_id, t.v
""")
def w2(spark, sf):
    e = read_table(spark, sf, "events")
    e = e.select("event_type", "event_id", F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"))
    out = M.smooth(e, "event_type", "event_id", "value")
    return out.select("event_type", "event_id", "value", F.round("smoothed", R6).alias("smoothed"))


# -- A8 / A9 / A10 ------------------------------------------------------------
def _seg(x):
    return f"regexp_extract_all({x}, {lit(TOKEN_PATTERN)})"


def _ng(t, n):
    return (f"(CASE WHEN len({t}) >= {n} THEN list_distinct(list_transform(range(1, len({t}) - {n} + 2), "
            f"lambda i: array_to_string(list_slice({t}, i, i + {n - 1}), chr(1)))) ELSE [] END)")


EVAL_SQL = f"""{X.PREDICTIONS_SQL},
e AS (SELECT pr.conv_id, pr.turn, pr.model, pa.response AS expect, pr.text AS predict,
             {_seg('pa.response')} AS rt, {_seg('pr.text')} AS ht
      FROM predictions pr JOIN pairs pa USING (conv_id, turn))"""


def _rouge_sql(n):
    h, r = _ng("ht", n), _ng("rt", n)
    ov = f"CAST(len(list_intersect({h}, {r})) AS DOUBLE)"
    p = f"(CASE WHEN len({h}) > 0 THEN {ov} / len({h}) ELSE 0.0 END)"
    rc = f"(CASE WHEN len({r}) > 0 THEN {ov} / len({r}) ELSE 0.0 END)"
    return p, rc


def _rouge_cols(n):
    p, rc = _rouge_sql(n)
    return (f"round({rc}, {R6}) AS rouge_{n}_r, round({p}, {R6}) AS rouge_{n}_p, "
            f"round(2 * {p} * {rc} / ({p} + {rc} + 1e-8), {R6}) AS rouge_{n}_f")


@register("A8_rouge_n", sql=f"""
WITH {EVAL_SQL}
SELECT conv_id, turn, model, {_rouge_cols(1)}, {_rouge_cols(2)} FROM e
""")
def a8(spark, sf):
    e = X.predictions(spark, sf).join(X.pairs(spark, sf).select("conv_id", "turn", "response"), ["conv_id", "turn"])
    e = e.withColumn("_pt", M.segment(F.col("text"))).withColumn("_et", M.segment(F.col("response")))
    e = M.with_rouge_n(e, "_pt", "_et")
    return e.select("conv_id", "turn", "model", *[F.round(f"rouge_{n}_{m}", R6).alias(f"rouge_{n}_{m}")
                                                  for n in (1, 2) for m in ("r", "p", "f")])


def _seg_str(x):
    return f"array_to_string({_seg(x)}, ' ')"


BLEU_CTES = f"""s AS (SELECT conv_id, turn, model, {_seg_str('expect')} AS r, {_seg_str('predict')} AS h FROM e),
ns AS (SELECT unnest([1, 2, 3, 4]) AS n),
hg AS (SELECT conv_id, turn, model, n, g, count(*) AS c FROM (
         SELECT conv_id, turn, model, n, substr(h, unnest(generate_series(1, length(h) - n + 1)), n) AS g FROM s, ns)
       GROUP BY ALL),
rg AS (SELECT conv_id, turn, model, n, g, count(*) AS c FROM (
         SELECT conv_id, turn, model, n, substr(r, unnest(generate_series(1, length(r) - n + 1)), n) AS g FROM s, ns)
       GROUP BY ALL),
m AS (SELECT hg.conv_id, hg.turn, hg.model, hg.n, sum(least(hg.c, coalesce(rg.c, 0))) AS num, sum(hg.c) AS tot
      FROM hg LEFT JOIN rg ON rg.conv_id = hg.conv_id AND rg.turn = hg.turn AND rg.model = hg.model
                          AND rg.n = hg.n AND rg.g = hg.g
      GROUP BY ALL),
f AS (SELECT s.conv_id, s.turn, s.model, ns.n, coalesce(m.num, 0) AS num, greatest(1, coalesce(m.tot, 0)) AS den,
             length(s.h) AS hl, length(s.r) AS rl
      FROM s CROSS JOIN ns LEFT JOIN m ON m.conv_id = s.conv_id AND m.turn = s.turn AND m.model = s.model AND m.n = ns.n),
z AS (SELECT *, sum(CASE WHEN num = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn, model ORDER BY n
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM f),
l AS (SELECT *, CASE WHEN num = 0 THEN ln(1.0 / (pow(2, k) * den)) ELSE ln(CAST(num AS DOUBLE) / den) END AS lp FROM z),
a AS (SELECT conv_id, turn, model, max(hl) AS hl, max(rl) AS rl, sum(0.25 * lp) AS s,
             max(CASE WHEN n = 1 THEN num END) AS p1 FROM l GROUP BY ALL),
bleu AS (SELECT conv_id, turn, model,
  CASE WHEN p1 = 0 THEN 0.0 ELSE
    (CASE WHEN hl > rl THEN 1.0 WHEN hl = 0 THEN 0.0 ELSE exp(1 - CAST(rl AS DOUBLE) / hl) END) * exp(s) END AS bleu
  FROM a)"""

# ROUGE-L: LCS by an anti-diagonal dynamic programme in a recursive CTE
# (one row per (conv_id, turn, model), replaced each step via USING KEY).
LCS_CTES = """base AS (SELECT conv_id, turn, model, ht AS a, rt AS b, len(ht) AS m, len(rt) AS n FROM e),
dp(conv_id, turn, model, d, p2, p1) USING KEY (conv_id, turn, model) AS (
  SELECT conv_id, turn, model, 1, list_transform(range(0, m + 1), lambda x: 0), list_transform(range(0, m + 1), lambda x: 0)
  FROM base
  UNION
  SELECT dp.conv_id, dp.turn, dp.model, dp.d + 1, dp.p1,
    list_transform(range(0, base.m + 1), lambda i:
       CASE WHEN i = 0 OR dp.d + 1 - i <= 0 OR dp.d + 1 - i > base.n THEN 0
            WHEN base.a[i] = base.b[dp.d + 1 - i] THEN dp.p2[i] + 1
            ELSE greatest(dp.p1[i], dp.p1[i + 1]) END)
  FROM dp JOIN base ON base.conv_id = dp.conv_id AND base.turn = dp.turn AND base.model = dp.model
  WHERE dp.d < base.m + base.n),
lcs AS (SELECT dp.conv_id, dp.turn, dp.model, base.m, base.n, CAST(dp.p1[base.m + 1] AS DOUBLE) AS lcs
        FROM dp JOIN base ON base.conv_id = dp.conv_id AND base.turn = dp.turn AND base.model = dp.model),
rl AS (SELECT conv_id, turn, model,
         CASE WHEN m = 0 OR n = 0 THEN 0.0 ELSE lcs / n END AS r,
         CASE WHEN m = 0 OR n = 0 THEN 0.0 ELSE lcs / m END AS p FROM lcs),
rl2 AS (SELECT conv_id, turn, model, r, p,
          (1 + pow(p / (r + 1e-12), 2)) * r * p / (r + pow(p / (r + 1e-12), 2) * p + 1e-12) AS f FROM rl)"""


@register("A9_bleu", sql=f"""
WITH {EVAL_SQL},
{BLEU_CTES}
SELECT conv_id, turn, model, round(bleu, {R6}) AS bleu FROM bleu
""")
def a9(spark, sf):
    e = X.predictions(spark, sf).join(X.pairs(spark, sf).select("conv_id", "turn", "response"), ["conv_id", "turn"])
    from weft.functions.metrics_udf import bleu_udf
    b = bleu_udf(F.array_join(M.segment(F.col("response")), " "), F.array_join(M.segment(F.col("text")), " "))
    return e.select("conv_id", "turn", "model", F.round(b, R6).alias("bleu"))


@register("A8_rouge_l", sql=f"""
WITH RECURSIVE {EVAL_SQL},
{LCS_CTES}
SELECT conv_id, turn, model, round(r, {R6}) AS rouge_l_r, round(p, {R6}) AS rouge_l_p, round(f, {R6}) AS rouge_l_f FROM rl2
""")
def a8l(spark, sf):
    """ROUGE-L via the LCS UDF; the oracle runs the LCS dynamic programme in SQL."""
    e = X.predictions(spark, sf).join(X.pairs(spark, sf).select("conv_id", "turn", "response"), ["conv_id", "turn"])
    from weft.functions.metrics_udf import rouge_l_udf
    s = rouge_l_udf(M.segment(F.col("text")), M.segment(F.col("response")))
    return e.select("conv_id", "turn", "model", *[F.round(s[m], R6).alias(f"rouge_l_{m}") for m in ("r", "p", "f")])


@register("A10_evaluate_sentences")
def evaluation_sentences(spark, sf):
    """The ten metrics with texts cut at full stops (summary-level ROUGE-L); the walk through its table has no SQL."""
    e = X.predictions(spark, sf).join(X.pairs(spark, sf).select("conv_id", "turn", F.col("response").alias("expect")), ["conv_id", "turn"])
    return M.nlp_metrics(e.withColumnRenamed("text", "predict"), sentences=True).select("conv_id", "turn", "model", *M.METRICS)


def _rouge_cols3(n):
    p, rc = _rouge_sql(n)
    return (f"round_even({rc}, 3) AS rouge_{n}_r, round_even({p}, 3) AS rouge_{n}_p, "
            f"round_even(2 * {p} * {rc} / ({p} + {rc} + 1e-8), 3) AS rouge_{n}_f")


EVALUATION_SQL = f"""
WITH RECURSIVE {EVAL_SQL},
{BLEU_CTES},
{LCS_CTES}
SELECT e.conv_id, e.turn, e.model, e.expect, e.predict, round_even(bleu.bleu, 3) AS bleu,
       {_rouge_cols3(1)}, {_rouge_cols3(2)},
       round_even(rl2.r, 3) AS rouge_l_r, round_even(rl2.p, 3) AS rouge_l_p, round_even(rl2.f, 3) AS rouge_l_f
FROM e JOIN bleu USING (conv_id, turn, model) JOIN rl2 USING (conv_id, turn, model)
"""


@register("A10_evaluate_predictions", sql=EVALUATION_SQL)
def evaluation(spark, sf):
    """Every (row, model): the 10 metrics rounded half-even to 3 places."""
    from weft.operators.evaluate import attach_predictions
    rows = X.pairs(spark, sf).select("conv_id", "turn", F.col("response").alias("expect"))
    rows = attach_predictions(rows, X.predictions(spark, sf), ["conv_id", "turn"])
    return M.evaluate_predictions(rows.where(F.col("predict").isNotNull()), ["conv_id", "turn"])
