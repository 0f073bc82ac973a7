"""Metrics and aggregations.

Aggregates are plain ``groupBy``/``agg`` (partial aggregation before the
shuffle).  Running statistics over a series use a chunked two-level
prefix computation so that one long series never sits in a single task.
ROUGE-1/2 are array expressions; ROUGE-L and BLEU use the Arrow UDFs in
:mod:`weft.functions.metrics_udf`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.metrics_udf import bleu_udf, rouge_l_sentences_udf, rouge_l_udf
from weft.functions.tokens import TOKEN_PATTERN
from weft.operators.pack import running_sums

METRICS = ("bleu", "rouge_1_r", "rouge_1_p", "rouge_1_f", "rouge_2_r", "rouge_2_p", "rouge_2_f",
           "rouge_l_r", "rouge_l_p", "rouge_l_f")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- A1 -------------------------------------------------------------------------
def dialogue_length_buckets(pairs: DataFrame, conv: str = "conv_id", human: str = "query",
                            assistant: str = "response") -> DataFrame:
    """A1: per dialogue the total characters of all turns; counts of
    ``<1024``, ``>1024``, ``>2048``, ``>4096`` (strict, 1024 in none)."""
    lens = pairs.groupBy(conv).agg(F.sum(F.length(human) + F.length(assistant)).alias("n"))
    return lens.agg(F.count_if(F.col("n") < 1024).alias("lt_1024"), F.count_if(F.col("n") > 1024).alias("gt_1024"),
                    F.count_if(F.col("n") > 2048).alias("gt_2048"), F.count_if(F.col("n") > 4096).alias("gt_4096"))


# -- A3-A5 ----------------------------------------------------------------------
def preference_accuracy(df: DataFrame, accept: str = "accept", reject: str = "reject") -> DataFrame:
    """A3: share of rows with accept > reject."""
    return df.agg(F.avg((F.col(accept) > F.col(reject)).cast("double")).alias("accuracy"))


def reward_evaluation(df: DataFrame, batch: str = "batch_id", accept: str = "accept", reject: str = "reject",
                      batch_means: bool = False, max_batches: int | None = None) -> DataFrame:
    """A4: accuracy, mean chosen and mean rejected score over all rows.
    ``batch_means`` averages per-batch means instead; ``max_batches`` stops
    at that batch (0-based dense batch ids), for a quick look."""
    d = df if max_batches is None else df.where(F.col(batch) < max_batches)
    acc = F.avg((F.col(accept) > F.col(reject)).cast("double"))
    if not batch_means:
        return d.agg(acc.alias("accuracy"), F.avg(accept).alias("chosen_mean"), F.avg(reject).alias("rejected_mean"))
    per = d.groupBy(batch).agg(F.count_if(F.col(accept) > F.col(reject)).alias("c"), F.count(F.lit(1)).alias("n"),
                               F.avg(accept).alias("a"), F.avg(reject).alias("r"))
    return per.agg((F.sum("c") / F.sum("n")).alias("accuracy"), F.avg("a").alias("chosen_mean"),
                   F.avg("r").alias("rejected_mean"))


def pairwise_loss(df: DataFrame, accept: str = "accept", reject: str = "reject") -> DataFrame:
    """A5: mean of -log(sigmoid(accept - reject)) = log1p(exp(reject - accept))."""
    return df.agg(F.avg(F.log1p(F.exp(F.col(reject) - F.col(accept)))).alias("loss"))


# -- A6 / A7 ----------------------------------------------------------------------
def token_accuracy(df: DataFrame, preds: str = "preds", labels: str = "labels", mask_ignored: bool = False,
                   ignore: int = -100) -> DataFrame:
    """Predictions shifted against labels by one (pred[:-1] vs label[1:]),
    pooled over all rows.  ``-100`` positions count unless ``mask_ignored``."""
    p, lab = F.col(preds), F.col(labels)
    n = F.greatest(F.size(lab) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(p, F.lit(1), n).alias("p"), F.slice(lab, F.lit(2), n).alias("l"))
    if mask_ignored:
        pairs = F.filter(pairs, lambda x: x["l"] != ignore)
    hit = F.size(F.filter(pairs, lambda x: x["p"] == x["l"]))
    return df.agg((F.sum(hit) / F.sum(F.size(pairs))).alias("accuracy"), F.sum(F.size(pairs)).cast("bigint").alias("n"))


def weighted_average(df: DataFrame, keys: list[str], val: str, n: str) -> DataFrame:
    """sum(val * n) / sum(n)."""
    return df.groupBy(*keys).agg((F.sum(F.col(val) * F.col(n)) / F.sum(n)).alias("avg"),
                                 F.sum(n).cast("bigint").alias("count"))


# -- W3 ---------------------------------------------------------------------------
def cumulative_mean(df: DataFrame, key: str, order: str, val: str, chunk: int = 4096) -> DataFrame:
    """Running mean of ``val`` in ``order`` within ``key``; two-level prefix
    sums so a long series spreads over tasks."""
    d = df.withColumn("_one", F.lit(1))
    d = running_sums(d, key, order, {val: "_s", "_one": "_n"}, chunk)
    return d.withColumn("mean", (F.col("_s") + F.col(val)) / (F.col("_n") + 1)).drop("_one", "_s", "_n")


# -- W2 ---------------------------------------------------------------------------
def _after(later: Column, earlier: Column) -> Column:
    """The step ``s -> a * s + b`` that does ``earlier``, then ``later``."""
    return F.struct((later["a"] * earlier["a"]).alias("a"), (later["a"] * earlier["b"] + later["b"]).alias("b"))


def _composed(steps: Column) -> Column:
    """All steps of an array as one."""
    return F.aggregate(steps, F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")), lambda acc, x: _after(x, acc))


def _prefixes(steps: Column, size: int) -> Column:
    """Each step of the array (of at most ``size``) composed with all before it.

    The array is cut into sqrt(size) parts.  Steps are composed in order inside
    a part, then each part with what the parts before it make together, so the
    lists that grow by an element at a time have sqrt(size) elements."""
    width = max(1, round(size ** 0.5))
    pair, none = "struct<a:double,b:double>", F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))

    def grown(acc: Column, now: Column, kept: Column) -> Column:
        return F.struct(now.alias("now"), F.concat(acc["all"], F.array(kept)).alias("all"))

    start = F.struct(none.alias("now"), F.array().cast(f"array<{pair}>").alias("all"))

    def inside(part: Column) -> Column:
        return F.aggregate(part, start, lambda acc, x: F.transform(F.array(_after(x, acc["now"])), lambda y: grown(acc, y, y))[0])["all"]

    def joined(parts: Column) -> Column:
        before = F.aggregate(parts, start, lambda acc, p: grown(acc, _after(F.element_at(p, -1), acc["now"]), acc["now"]))["all"]
        return F.flatten(F.zip_with(parts, before, lambda p, e: F.transform(p, lambda x: _after(x, e))))

    # an array of one binds a value, so that it is computed once
    cut = F.transform(F.array(steps), lambda xs: F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width)),
                                                             lambda k: inside(F.slice(xs, (k * width + 1).cast("int"), F.lit(width)))))
    return F.transform(cut, joined)[0]


def _entering(prefixes: Column, state: Column) -> Column:
    """The state before each step, from the prefixes and the state before all."""
    after = F.transform(prefixes, lambda p: p["a"] * state + p["b"])
    return F.concat(F.array(state), F.slice(after, F.lit(1), F.greatest(F.size(after) - 1, F.lit(0))))


def _scan(d: DataFrame, step: Callable[[Column, Column], Column], chunk: int, per_key: DataFrame) -> DataFrame:
    """``(_row, s)``: the linear recurrence s = a * s + b from 0 over each ``_key``'s rows in the order of ``_pos`` (dense from 0).

    ``step(x, w)`` gives ``struct(a, b)`` of an element ``x`` (``_pos``,
    ``_row``) with ``w`` from ``per_key`` (``_key``, ``w``).  Three levels, of
    fixed depth, planned without a job: rows in chunks, chunks in chunks, and
    the summaries of those, of which a key has one in ``chunk * chunk`` rows.
    The key's values join chunks, not rows."""
    xs = F.array_sort(F.collect_list(F.struct("_pos", "_row")))
    rows = d.groupBy("_key", F.floor(F.col("_pos") / chunk).alias("_c")).agg(xs.alias("_xs")).join(per_key, "_key")
    rows = rows.withColumn("_steps", F.transform("_xs", lambda x: step(x, F.col("w"))))

    def summary(df: DataFrame, at: str) -> DataFrame:
        return df.select("_key", at, _composed(F.col("_steps")).alias("_step"))

    mid = (summary(rows, "_c").groupBy("_key", F.floor(F.col("_c") / chunk).alias("_m"))
           .agg(F.array_sort(F.collect_list(F.struct("_c", "_step"))).alias("_cs"))
           .withColumn("_steps", F.transform("_cs", lambda x: x["_step"])))
    top = summary(mid, "_m").groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_m", "_step"))).alias("_ms"))
    states = F.aggregate("_ms", F.struct(F.lit(0.0).alias("s"), F.array().cast("array<struct<m:bigint,s:double>>").alias("all")),
                         lambda acc, x: F.struct((x["_step"]["a"] * acc["s"] + x["_step"]["b"]).alias("s"),
                                                 F.concat(acc["all"], F.array(F.struct(x["_m"].alias("m"), acc["s"].alias("s")))).alias("all")))["all"]
    into_mid = top.select("_key", F.explode(states).alias("_x")).select("_key", F.col("_x.m").alias("_m"), F.col("_x.s").alias("_in"))
    mid = mid.join(into_mid, ["_key", "_m"]).withColumn("_steps", _prefixes(F.col("_steps"), chunk))
    into_rows = (mid.select("_key", F.explode(F.arrays_zip(F.col("_cs"), _entering(F.col("_steps"), F.col("_in")).alias("_s"))).alias("_x"))
                 .select("_key", F.col("_x._cs._c").alias("_c"), F.col("_x._s").alias("_in")))
    rows = rows.join(into_rows, ["_key", "_c"]).withColumn("_steps", _prefixes(F.col("_steps"), chunk))
    out = rows.select("_in", F.explode(F.arrays_zip("_xs", "_steps")).alias("_x"))
    return out.select("_x._xs._row", (F.col("_x._steps.a") * F.col("_in") + F.col("_x._steps.b")).alias("s"))


def smooth(df: DataFrame, key: str, order: str, val: str, chunk: int = 256) -> DataFrame:
    """TensorBoard-style EMA per series; rows without the metric are
    skipped; weight = 1.8 * (sigmoid(0.05 * series length) - 0.5).  A null
    series is one too; a series of any length is spread (:func:`_scan`)."""
    from weft.operators.split import ordered_index
    d = df.where(F.col(val).isNotNull()).select(F.struct(F.col(key)).alias("_key"), F.col(order).alias("_order"), F.struct(key, order, val).alias("_row"))
    d = ordered_index(d, ["_order"], out="_pos", partition_cols=["_key"])
    w = F.lit(1.8) * (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-0.05) * F.count(F.lit(1)))) - 0.5)

    def step(x: Column, weight: Column) -> Column:
        value, first = x["_row"][val].cast("double"), x["_pos"] == 0
        return F.struct(F.when(first, 0.0).otherwise(weight).alias("a"), F.when(first, value).otherwise((1 - weight) * value).alias("b"))

    out = _scan(d.select("_key", "_pos", "_row"), step, chunk, d.groupBy("_key").agg(w.alias("w")))
    return out.select("_row.*", F.col("s").alias("smoothed"))


# -- A8-A10 -----------------------------------------------------------------------
def segment(text) -> Column:
    """Default segmenter: word runs of [A-Za-z0-9_] and every other
    non-space character as its own token (CJK characters one by one)."""
    return F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), 0)


def ngram_set(tokens: Column, n: int) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1),
                        lambda i: F.array_join(F.slice(tokens, i, n), "\u0001"))
    return F.when(F.size(tokens) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def rouge_n(hyp_tokens: Column, ref_tokens: Column, n: int) -> Column:
    """ROUGE-N over n-gram sets: struct(r, p, f).  Pass column references:
    use :func:`with_rouge_n` on a DataFrame to compute each n-gram set once."""
    h, r = ngram_set(hyp_tokens, n), ngram_set(ref_tokens, n)
    return _rouge_from_sets(h, r)


def _rouge_from_sets(h: Column, r: Column) -> Column:
    ov = F.size(F.array_intersect(h, r)).cast("double")
    p = F.when(F.size(h) > 0, ov / F.size(h)).otherwise(F.lit(0.0))
    rc = F.when(F.size(r) > 0, ov / F.size(r)).otherwise(F.lit(0.0))
    f = 2 * p * rc / (p + rc + F.lit(1e-8))
    return F.struct(rc.alias("r"), p.alias("p"), f.alias("f"))


def with_rouge_n(df: DataFrame, hyp_tokens: str, ref_tokens: str, ns=(1, 2)) -> DataFrame:
    """Adds rouge_{n}_{r,p,f}; n-gram sets are separate projections so each
    is built once per row (lambdas are not common-subexpression eliminated)."""
    for n in ns:
        df = (df.withColumn(f"_h{n}", ngram_set(F.col(hyp_tokens), n))
                .withColumn(f"_g{n}", ngram_set(F.col(ref_tokens), n)))
        df = df.withColumn(f"_s{n}", _rouge_from_sets(F.col(f"_h{n}"), F.col(f"_g{n}")))
        for m in ("r", "p", "f"):
            df = df.withColumn(f"rouge_{n}_{m}", F.col(f"_s{n}")[m])
        df = df.drop(f"_h{n}", f"_g{n}", f"_s{n}")
    return df


def sentences_of(tokens: Column) -> Column:
    """ARRAY<ARRAY<STRING>>: the segmented text cut at full stops, as the reference's ROUGE library reads it."""
    parts = F.filter(F.split(F.array_join(tokens, " "), "\\."), lambda s: F.length(s) > 0)
    return F.transform(parts, lambda s: F.filter(F.split(F.trim(s), " +"), lambda w: F.length(w) > 0))


def nlp_metrics(df: DataFrame, expect: str = "expect", predict: str = "predict", digits: int | None = 3,
                segmenter: Callable[[Column], Column] = segment, sentences: bool = False) -> DataFrame:
    """A8 + A9 on segmented text: ROUGE-1/2 (sets), ROUGE-L (LCS), BLEU-4
    over characters of the segmented string; rounded half-even to ``digits``.

    ``segmenter`` turns a text into ARRAY<STRING>.  ``sentences`` cuts texts
    at full stops first, for summary-level ROUGE-L (see
    :func:`rouge_l_sentences`) and n-grams without the stops."""
    d = df.withColumn("_et", segmenter(F.col(expect))).withColumn("_pt", segmenter(F.col(predict)))
    d = d.withColumn("bleu", bleu_udf(F.array_join("_et", " "), F.array_join("_pt", " ")))
    if sentences:
        d = d.withColumn("_es", sentences_of(F.col("_et"))).withColumn("_ps", sentences_of(F.col("_pt")))
        d = d.withColumn("_rl", rouge_l_sentences_udf(F.col("_ps"), F.col("_es")))
        d = d.withColumn("_et", F.flatten("_es")).withColumn("_pt", F.flatten("_ps")).drop("_es", "_ps")
    else:
        d = d.withColumn("_rl", rouge_l_udf(F.col("_pt"), F.col("_et")))
    d = with_rouge_n(d, "_pt", "_et")
    for m in ("r", "p", "f"):
        d = d.withColumn(f"rouge_l_{m}", F.col("_rl")[m])
    d = d.drop("_et", "_pt", "_rl")
    if digits is not None:
        for m in METRICS:
            d = d.withColumn(m, F.bround(F.col(m), digits))
    return d


def evaluate_predictions(df: DataFrame, id_cols: list[str], expect: str = "expect", predict: str = "predict",
                         digits: int | None = 3, segmenter: Callable[[Column], Column] = segment,
                         sentences: bool = False) -> DataFrame:
    """A10: one row per (row, model) from a ``predict`` MAP<model, text>.
    ``expect`` is a text column, or an array of chat turns whose last
    ``output`` is the expectation."""
    kind = df.schema[expect].dataType.typeName() if expect in df.columns else "string"
    wanted = F.element_at(expect, -1)["output"] if kind == "array" else F.col(expect)
    long = df.select(*id_cols, wanted.alias("expect"), F.explode(F.col(predict)).alias("model", "predict"))
    return nlp_metrics(long, "expect", "predict", digits, segmenter, sentences)
