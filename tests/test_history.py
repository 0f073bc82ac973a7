"""T8-T12 on hand-built conversations; token counts are by hand:
a role-marker turn costs 10 tokens plus the words of its query and answer."""

import pytest
from pyspark.sql import functions as F

from weft.functions.tokens import HashTokenizer
from weft.operators import history as H

HIST = "array<struct<query:string,answer:string>>"


def _row(spark, history, q="p", a="q", prompt="sys"):
    return spark.createDataFrame([(1, 5, q, a, prompt, history)],
                                 f"conv_id long, turn long, query string, response string, prompt string, history {HIST}")


HISTORY = [("a", "b"), ("c d e f g h i j k l", "m"), ("n", "o")]   # costs 12, 21, 12; current 12


def test_fit_stops_at_first_turn_that_does_not_fit(spark):
    r = H.fit_history(_row(spark, HISTORY), 40).first()
    # 12 (current) + 12 (newest) = 24; the middle turn (21) breaks the loop even though the oldest (12) would fit
    assert r["n_history"] == 1
    assert [h["query"] for h in r["kept_history"]] == ["n"]
    assert len(r["input_ids"]) == 1 + 12 + 12          # prompt + kept + current
    assert r["labels"] == r["input_ids"]


def test_fit_exact_budget_and_drop(spark):
    assert H.fit_history(_row(spark, HISTORY), 45).first()["n_history"] == 2
    assert H.fit_history(_row(spark, HISTORY), 13).first()["n_history"] == 0      # prompt (1) and current (12) exactly at budget
    assert H.fit_history(_row(spark, HISTORY), 12).count() == 0                   # the prompt is one token too many
    assert H.fit_history(_row(spark, HISTORY), 11).count() == 0                   # current alone too long (F2)


def test_fit_null_and_empty_history(spark):
    assert H.fit_history(_row(spark, None), 100).first()["n_history"] == 0
    assert H.fit_history(_row(spark, []), 100).first()["n_history"] == 0


def test_expand_history_and_nested(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "S"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
         (1, 4, "assistant", "a2"), (1, 5, "user", "dangling"), (2, 0, "user", "x"), (2, 1, "assistant", "y")],
        "conv_id long, turn long, role string, text string")
    pairs = H.chat_pairs(turns)
    rows = {(r["conv_id"], r["turn"]): r for r in H.expand_history(pairs).collect()}
    assert set(rows) == {(1, 1), (1, 3), (2, 0)}
    assert rows[(1, 3)]["prompt"] == "S" and rows[(2, 0)]["prompt"] is None
    assert [(h["query"], h["answer"]) for h in rows[(1, 3)]["history"]] == [("u1", "a1")]
    nested = spark.createDataFrame([([("i1", "o1"), ("i2", "o2")],)], "chat array<struct<input:string,output:string>>")
    out = H.expand_nested(nested).orderBy("turn").collect()
    assert [len(r["history"]) for r in out] == [0, 1] and out[1]["query"] == "i2"


def test_inference_context_status(spark):
    df = _row(spark, HISTORY).withColumn("locked", F.array(F.struct(F.lit("l").alias("query"), F.lit("m").alias("answer"))))
    ok = H.inference_context(df, 60, locked="locked").first()
    assert ok["status"] == "ok"
    # query text = user + 'p' + assistant = 7 tokens, prompt 1, locked 12 -> 20; + newest 12 = 32, + middle 21 = 53, + oldest 12 = 65 > 60
    assert ok["n_history"] == 2
    assert H.inference_context(df, 10, locked="locked").first()["status"] == "locked_too_long"
    assert H.inference_context(df, 5, locked="locked").first()["status"] == "query_too_long"


def test_rounds_style_masks_all_but_answer(spark):
    r = H.fit_history_rounds(_row(spark, [("a", "b")], prompt=None), 200).first()
    n_ans = 2   # 'q' + eos
    assert r["labels"][-n_ans:] == r["input_ids"][-n_ans:]
    assert set(r["labels"][:-n_ans]) == {-100}


def test_cumulative_questions(spark):
    pairs = spark.createDataFrame([(1, 0, "q1", "a1"), (1, 2, "q2", "a2")], "conv_id long, turn long, query string, response string")
    out = {r["turn"]: r["question"] for r in H.cumulative_questions(pairs).collect()}
    assert out == {0: "input: q1", 2: "input: q1output: a1input: q2"}


def test_bounded_look_back_is_exact(spark):
    rows = [(1, t, f"q{t} " + "w " * (t % 5), f"a{t}") for t in range(0, 60, 2)]
    pairs = spark.createDataFrame(rows, "conv_id long, turn long, query string, response string").withColumn("prompt", F.lit(None).cast("string"))
    budget = 60
    k = H.max_fitting_turns(budget)
    assert H.min_turn_cost() == 10 and k == 6
    full = {r["turn"]: (r["n_history"], r["input_ids"]) for r in H.fit_history(H.expand_history(pairs), budget).collect()}
    bounded = {r["turn"]: (r["n_history"], r["input_ids"])
               for r in H.fit_history(H.expand_history(pairs, max_history=k), budget).collect()}
    assert full == bounded


def test_encode_style_registry(spark):
    import pytest
    from weft.functions.tokens import PandasTokenizer
    df = _row(spark, HISTORY)
    a = H.encode_chat(df, "role_marker", 40).first()
    assert a["n_history"] == 1
    tk = PandasTokenizer(lambda texts: [[len(w) + 3 for w in t.split()] for t in texts])
    H.register_encode_style("words", lambda d, b, t: H.fit_history(d, b, t))
    w = H.encode_chat(df, "words", 1000, tk).first()
    assert w["n_history"] == 3
    with pytest.raises(KeyError):
        H.encode_chat(df, "nope", 10)


def test_role_play_transcript_format(spark):
    pairs = spark.createDataFrame([(1, 0, "q1", "a1", "P"), (1, 2, "q2", "a2", "P")],
                                  "conv_id long, turn long, query string, response string, prompt string")
    out = {r["key"]: r for r in H.role_play_transcript(pairs, "S:", "T:", "{dialog}|{user_profile}", profile="prompt").collect()}
    one = "<student>: q1\n</student>\n<teacher>: a1\n</teacher>\n"
    assert out["turn_1"]["student_prompt"] == "S:"
    assert out["turn_2"]["student_prompt"] == "S:" + one
    assert out["turn_2"]["teacher_prompt"] == "T:" + one + "<student>: q2\n</student>\n"
    assert out["turn_2"]["profiler_prompt"] == one + "<student>: q2\n</student>\n|P"


def test_halo_chunks_equal_single_window(spark):
    rows = [(c, t, f"q{c}_{t}", f"a{t}") for c in (1, 2) for t in range(0, 2 * (40 if c == 1 else 3), 2)]
    pairs = spark.createDataFrame(rows, "conv_id long, turn long, query string, response string")
    ref = {(r["conv_id"], r["turn"]): [h["query"] for h in r["history"]]
           for r in H.expand_history(pairs).collect()}
    for k, chunk in ((6, 7), (6, 6), (3, 10), (1, 1)):
        got = {(r["conv_id"], r["turn"]): [h["query"] for h in r["history"]]
               for r in H.expand_history(pairs, max_history=k, chunk=chunk).collect()}
        assert got == {key: v[-k:] for key, v in ref.items()}, (k, chunk)


def test_carried_lengths_match_recount(spark):
    rows = [(1, t, f"q{t} " + "w " * (t % 7), f"a{t} x") for t in range(0, 80, 2)]
    pairs = spark.createDataFrame(rows, "conv_id long, turn long, query string, response string") \
        .withColumn("prompt", F.lit("sys")).withColumn("_n", H.turn_token_count())
    k = H.max_fitting_turns(70)
    a = {r["turn"]: (r["n_history"], r["input_ids"]) for r in H.fit_history(H.expand_history(pairs, max_history=k), 70).collect()}
    b = {r["turn"]: (r["n_history"], r["input_ids"]) for r in H.fit_history(
        H.expand_history(pairs, max_history=k, chunk=5, carry={"n_tokens": "_n"}), 70, length_field="n_tokens").collect()}
    assert a == b


def test_a_prompt_counts_when_rows_are_dropped(spark):
    """Prompt and turn together over the budget: dropped; the history loop leaves the prompt out."""
    df = spark.createDataFrame([("q", "a", "p " * 20, None), ("q", "a", "p", None), ("q", "a", "p " * 3, [("x", "y")])],
                               "query string, response string, prompt string, history array<struct<query:string,answer:string>>")
    turn = spark.createDataFrame([("q", "a")], "query string, response string").select(H.turn_token_count()).first()[0]
    out = H.fit_history(df, turn + 4).collect()
    assert sorted(len(r["input_ids"]) for r in out) == [turn + 1, turn + 3]
    wide = H.fit_history(df, 2 * turn).collect()
    assert max(r["n_history"] for r in wide) == 1            # 3 prompt tokens over the budget, and still kept
    assert max(r["n_history"] for r in H.fit_history(df, 2 * turn, count_prompt=True).collect()) == 0


def test_pairs_and_front_of_a_hot_conversation(spark):
    turns = [(1, 0, "system", "sys")] + [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(1, 121)]
    turns += [(2, 1, "user", "lonely"), (3, 2, "assistant", "no question"), (4, 1, "user", None), (4, 2, "assistant", None), (None, 1, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = H.chat_pairs(df)
        got = {(r["conv_id"], r["turn"]): (r["query"], r["response"], r["prompt"]) for r in pairs.collect()}
        front = {r["turn"]: [h["query"] for h in r["history"]] for r in H.expand_front(pairs, 5).where("conv_id = 1").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(1, t): (f"t{t}", f"t{t + 1}", "sys") for t in range(1, 120, 2)} | {(4, 1): (None, None, None)}
    assert front == {t: [f"t{u}" for u in range(1, min(t, 11), 2)] for t in range(1, 120, 2)}


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_scan_of_earlier_turns(spark, chunk):
    """Chunks against plain Python: one long conversation, short ones, a null one, null texts, clashing columns."""
    rows = [(c, t, None if t % 7 == 3 else f"q{c}.{t}", t) for c, n in ((1, 150), (2, 2), (3, 1), (None, 70)) for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, query string, _pos long").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        arrays = H.with_earlier(df, "conv_id", "turn", F.struct("query"), "before", chunk=chunk)
        texts = H.with_earlier(df, "conv_id", "turn", F.concat(F.lit("<"), "query"), "before", as_text=True, chunk=chunk, position="at")
        assert arrays.columns == [*df.columns, "before"]
        got_arrays = {(r["conv_id"], r["turn"]): [x["query"] for x in r["before"]] for r in arrays.collect()}
        got_texts = {(r["conv_id"], r["turn"]): (r["before"], r["at"]) for r in texts.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    said = {}
    for c, t, q, _ in rows:
        said.setdefault(c, []).append(q)
    assert got_arrays == {(c, t): said[c][:t] for c, t, _, _ in rows}
    assert got_texts == {(c, t): ("".join("<" + q for q in said[c][:t] if q is not None), t) for c, t, _, _ in rows}


def test_a_hot_conversation_is_spread(spark):
    """No task of the scan takes more than a few chunks of the only conversation's output rows."""
    df = spark.range(0, 3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("q").alias("query"), F.lit("a").alias("response"))
    rows = H.cumulative_questions(df).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 3000 and max(r["count"] for r in rows) <= 1500


def test_look_back_bound_of_any_markers(spark):
    """Markers are counted by the tokenizer's own expression, whatever the alphabet."""
    assert H.min_turn_cost(style=H.ROUND_STYLE) == 8 and H.max_fitting_turns(1500, style=H.ROUND_STYLE) == 187
    assert H.min_turn_cost(style={"user_token": "Вопрос", "assistant_token": "ответ:", "eos_token": ""}) == 12
    assert H.min_turn_cost(HashTokenizer(pattern=r"\p{L}+"), H.ROUND_STYLE) is None
    assert H.min_turn_cost(HashTokenizer(pattern=r"\p{L}+", monotone=True), {"user_token": "Вопрос", "assistant_token": "ответ:", "eos_token": ""}) == 2


def test_rounds_fit_of_a_hot_conversation(spark):
    """The bounded look-back keeps what the unbounded one keeps, broadcasts off."""
    rows = [(1, t, f"q{t} " + "w " * (t % 9), f"a{t}") for t in range(0, 400, 2)]
    pairs = spark.createDataFrame(rows, "conv_id long, turn long, query string, response string").withColumn("prompt", F.lit("p"))
    pairs = pairs.withColumn("_n", H.round_turn_token_count())
    k = H.max_fitting_turns(90, style=H.ROUND_STYLE)
    assert k == 11
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full, bounded = ({r["turn"]: (r["n_history"], r["input_ids"], r["labels"]) for r in H.fit_history_rounds(
            H.expand_history(pairs, max_history=look, chunk=16, carry={"n": "_n"}), 90, length_field="n").collect()} for look in (None, k))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert full == bounded and max(v[0] for v in full.values()) >= 5


@pytest.mark.parametrize("look", [None, 2, 5])
def test_locked_turns(spark, look):
    """The first two turns apart, the history after them, bounded or not, over small chunks."""
    rows = [(c, t, f"q{c}.{t}", f"a{t}") for c, n in ((1, 30), (2, 1), (3, 3), (None, 4)) for t in range(n)]
    pairs = spark.createDataFrame(rows, "conv_id long, turn long, query string, response string")
    out = H.expand_history(pairs, max_history=look, chunk=7, locked=2).collect()
    assert len(out) == len(rows)
    for r in out:
        names = [f"q{r['conv_id']}.{t}" for t in range(r["turn"])]
        assert [h["query"] for h in r["locked"]] == names[:2]
        later = [f"q{r['conv_id']}.{t}" for t in range(2, r["turn"])]
        assert [h["query"] for h in r["history"]] == (later if look is None else later[-look:])
