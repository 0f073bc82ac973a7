import math
import random

import pytest
from pyspark.sql import functions as F

from weft.functions.metrics_udf import lcs_length, lcs_words, rouge_l, rouge_l_sentences, sentence_bleu_chars
from weft.operators import metrics as M


def _lcs_dp(a, b):
    dp = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            dp[i][j] = dp[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(dp[i - 1][j], dp[i][j - 1])
    return dp[-1][-1]


def test_bit_parallel_lcs_equals_dp():
    rnd = random.Random(0)
    for _ in range(200):
        a = [rnd.choice("abcde") for _ in range(rnd.randint(0, 30))]
        b = [rnd.choice("abcde") for _ in range(rnd.randint(0, 30))]
        assert lcs_length(a, b) == _lcs_dp(a, b)


def test_bleu_hand_computed():
    assert sentence_bleu_chars("abcd", "abcd") == pytest.approx(1.0)
    # p = 3/4, 2/3, 1/2, and 0/1 smoothed to 1/2: (0.125) ** 0.25
    assert sentence_bleu_chars("abcd", "abce") == pytest.approx(0.125 ** 0.25)
    assert sentence_bleu_chars("abcd", "xyz") == 0.0
    # short hypothesis: brevity penalty exp(1 - 6/3); p4 has no n-grams -> 1/(2*1)
    assert sentence_bleu_chars("abcdef", "abc") == pytest.approx(math.exp(-1) * 0.5 ** 0.25)


def test_rouge_l_formula():
    r, p, f = rouge_l(list("abc"), list("abcd"))
    assert (r, p) == (pytest.approx(0.75), pytest.approx(1.0))
    beta = p / r
    assert f == pytest.approx((1 + beta ** 2) * r * p / (r + beta ** 2 * p), rel=1e-9)


def test_nlp_metrics_rounding_and_sets(spark):
    df = spark.createDataFrame([("the cat sat", "the cat the cat")], "expect string, predict string")
    r = M.nlp_metrics(df, digits=3).first()
    # unigram sets: hyp {the, cat}, ref {the, cat, sat} -> r = 2/3, p = 1
    assert r["rouge_1_r"] == 0.667 and r["rouge_1_p"] == 1.0
    assert r["rouge_2_p"] == 0.5          # hyp bigram set {the cat, cat the}; only "the cat" is in ref
    assert r["rouge_l_r"] == 0.667


def test_reward_and_loss(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (0, 0.0, 1.0), (1, 2.0, 1.0)], "batch_id long, accept double, reject double")
    r = M.reward_evaluation(df).first()
    assert r["accuracy"] == pytest.approx(2 / 3)
    assert r["chosen_mean"] == pytest.approx(1.0)                   # all rows alike
    b = M.reward_evaluation(df, batch_means=True).first()
    assert b["chosen_mean"] == pytest.approx((0.5 + 2.0) / 2)       # mean of batch means
    e = M.reward_evaluation(df, batch_means=False).first()
    assert e["chosen_mean"] == pytest.approx(1.0)
    loss = M.pairwise_loss(df).first()["loss"]
    assert loss == pytest.approx((math.log1p(math.exp(-1)) + math.log1p(math.exp(1)) + math.log1p(math.exp(-1))) / 3)


def test_token_accuracy_shift(spark):
    df = spark.createDataFrame([([5, 6, 7, 0], [9, 5, 6, -100])], "preds array<int>, labels array<int>")
    r = M.token_accuracy(df).first()
    assert r["n"] == 3 and r["accuracy"] == pytest.approx(2 / 3)
    assert M.token_accuracy(df, mask_ignored=True).first()["accuracy"] == pytest.approx(1.0)


def _ema(xs):
    w = 1.8 * (1 / (1 + math.exp(-0.05 * len(xs))) - 0.5)
    last, out = xs[0], []
    for x in xs:
        last = last * w + (1 - w) * x
        out.append(last)
    return out


@pytest.mark.parametrize("chunk", [3, 4, 256])
def test_smooth_matches_sequential_ema(spark, chunk):
    rnd = random.Random(1)
    rows = [(k, s, rnd.random() if s % 11 else None) for k in ("a", "b") for s in range(0, 70 if k == "a" else 5)]
    df = spark.createDataFrame(rows, "run string, step long, v double")
    got = {(r["run"], r["step"]): r["smoothed"] for r in M.smooth(df, "run", "step", "v", chunk=chunk).collect()}
    for k in ("a", "b"):
        pts = [(s, v) for kk, s, v in rows if kk == k and v is not None]
        for (s, _), e in zip(pts, _ema([v for _, v in pts])):
            assert got[(k, s)] == pytest.approx(e, rel=1e-9, abs=1e-12)


def test_cumulative_mean_and_weighted(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(10)], "k string, step long, v double")
    got = {r["step"]: r["mean"] for r in M.cumulative_mean(df, "k", "step", "v", chunk=3).collect()}
    assert got == {i: pytest.approx(i / 2) for i in range(10)}
    w = M.weighted_average(df.withColumn("n", F.lit(2)), ["k"], "v", "n").first()
    assert w["avg"] == pytest.approx(4.5) and w["count"] == 20


def test_summary_level_rouge_l_by_hand(spark):
    # the textbook example: one reference sentence, two candidates; union of common words {w1, w2, w3, w5}
    r, p, _ = rouge_l_sentences([["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]], [["w1", "w2", "w3", "w4", "w5"]])
    assert (r, p) == (pytest.approx(4 / 5), pytest.approx(4 / 8))
    assert lcs_words(list("abcd"), list("xbyd")) == {"b", "d"} and lcs_words([], ["a"]) == set()
    assert rouge_l_sentences([], [["a"]]) == (0.0, 0.0, 0.0)
    df = spark.createDataFrame([("the cat sat. a dog ran.", "a dog ran. the cat sat."), (None, "x")], "expect string, predict string")
    whole, cut = (M.nlp_metrics(df, sentences=x).collect()[0] for x in (False, True))
    assert cut["rouge_l_f"] == 1.0 and whole["rouge_l_r"] < 0.7
    assert cut["rouge_1_f"] == 1.0 and cut["rouge_2_r"] == 0.8     # of 5 pairs, "sat a" and "ran the" differ


def test_any_segmenter_and_chat_expectations(spark):
    df = spark.createDataFrame([(1, [("q", "first"), ("q", "ab-cd")], {"m": "cd-ab"})],
                               "k long, chat array<struct<input:string,output:string>>, predict map<string,string>")
    out = M.evaluate_predictions(df, ["k"], "chat", segmenter=lambda c: F.split(c, "-")).first()
    assert (out["expect"], out["rouge_1_f"], out["rouge_2_f"], out["rouge_l_r"]) == ("ab-cd", 1.0, 0.0, 0.5)


def test_smoothing_is_linear_in_a_series(spark):
    """300,000 points in one series: every value against the recurrence, a null series beside it, broadcasts off."""
    import math
    n = 300_000
    df = spark.range(n).select(F.lit("long").alias("run"), "id", ((F.col("id") * 37) % 101 / 10.0).alias("v")).repartition(4)
    df = df.unionByName(spark.range(3).select(F.lit(None).cast("string").alias("run"), "id", F.col("id").cast("double").alias("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {(r["run"], r["id"]): r["smoothed"] for r in M.smooth(df, "run", "id", "v", chunk=64).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == n + 3
    for run, size, value in (("long", n, lambda i: i * 37 % 101 / 10.0), (None, 3, float)):
        w = 1.8 * (1 / (1 + math.exp(-0.05 * size)) - 0.5)
        s = value(0)
        for i in range(size):
            s = s * w + (1 - w) * value(i) if i else s
            assert abs(got[run, i] - s) < 1e-9


def test_common_words_by_bits_match_the_table():
    import random

    from weft.functions.metrics_udf import lcs_words

    def table(ref, hyp):
        rows = [[0] * (len(hyp) + 1)]
        for x in ref:
            row = [0]
            for j, y in enumerate(hyp):
                row.append(rows[-1][j] + 1 if x == y else max(rows[-1][j + 1], row[j]))
            rows.append(row)
        words, i, j = set(), len(ref), len(hyp)
        while i and j:
            if ref[i - 1] == hyp[j - 1]:
                i, j = i - 1, j - 1
                words.add(ref[i])
            elif rows[i - 1][j] > rows[i][j - 1]:
                i -= 1
            else:
                j -= 1
        return words

    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.choice("abcdefgh") + str(rnd.randrange(3)) for _ in range(rnd.randint(0, 25))] for _ in range(2))
        assert lcs_words(a, b) == table(a, b)


def test_sentence_metrics_of_a_query(spark):
    """Every row of the registered query against the plain helpers."""
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from weft.plans import fixtures as X
    texts = {(r["conv_id"], r["turn"], r["model"]): r["text"] for r in X.predictions(spark, SF_SMALL).collect()}
    wanted = {(r["conv_id"], r["turn"]): r["response"] for r in X.pairs(spark, SF_SMALL).collect()}
    got = E.queries()["A10_evaluate_sentences"](spark, SF_SMALL).collect()
    assert len(got) == len(texts) > 10

    def sentences(text):
        import re
        tokens = re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r]", text)
        return [s.split() for s in " ".join(tokens).split(".") if s]

    for r in got:
        key = r["conv_id"], r["turn"], r["model"]
        want = rouge_l_sentences(sentences(texts[key]), sentences(wanted[key[:2]]))
        assert all(abs(a - b) <= 0.00051 for a, b in zip((r["rouge_l_r"], r["rouge_l_p"], r["rouge_l_f"]), want)), key


def test_scores_are_taken_a_slice_at_a_time(spark):
    """More rows than a slice, some of them null, against the plain function; no more rows at once are Python objects."""
    import pyarrow as pa

    from weft.functions import metrics_udf as MU
    rows = [None if i % 7 == 0 else [["a", "b"], [str(i % 5)]] for i in range(3 * MU.SLICE + 5)]
    got = MU.rouge_l_sentences_udf.func(pa.array(rows), pa.array(rows[::-1])).to_pylist()
    assert [(g["r"], g["p"], g["f"]) for g in got] == [rouge_l_sentences(h or [], r or []) for h, r in zip(rows, rows[::-1])]
    sizes = []

    class Column:
        def __len__(self):
            return len(rows)

        def slice(self, at, n):
            sizes.append(min(n, len(rows) - at))
            return pa.array(rows[at:at + n])

    assert len(MU._scores(lambda s: 0.5, pa.float64(), Column())) == len(rows)
    assert max(sizes) <= MU.SLICE and sum(sizes) == len(rows)
