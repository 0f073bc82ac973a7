from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER as TK
from weft.operators import encode as EN


def test_supervised_stops_not_skips(spark):
    # turn sources: 'a' (bos + 1), 'b c d e f g' (6), 'h' (1); targets 1 token each
    df = spark.createDataFrame([(["a", "x", "b c d e f g", "y", "h", "z"],)], "dialog array<string>")
    r = EN.encode_supervised(df, max_source=8, max_target=2).first()
    # lengths per turn: 2+1+1=4, 6+1+1=8 -> 12 > 10 stop; the short third turn is not used
    assert len(r["input_ids"]) == 4
    assert r["labels"][:2] == [-100, -100] and r["labels"][-1] == TK.eos_id


def test_strip_padding_and_left_pad(spark):
    df = spark.createDataFrame([([0, 0, 5, 6], [7, 8, 0, 0]), ([0, 0], [0])], "q array<int>, r array<int>")
    q, r = EN.strip_padding(F.col("q"), F.col("r"), 0)
    got = [tuple(x) for x in df.select(q, r).collect()]
    assert got == [([5, 6], [7, 8]), ([], [])]
    assert df.select(EN.pad_to_target(F.col("r"), F.col("q"), 9)).first()[0] == [9, 9, 7, 8, 0, 0][-4:]


def test_prompt_left_pad_keeps_tail(spark):
    df = spark.createDataFrame([("a b c d e f",)], "t string")
    r = EN.prompt_left_pad(df, "t", max_seq=4, max_token_len=6).first()
    ids = TK.ids(F.lit("a b c d e f"), True)
    full = spark.range(1).select(ids).first()[0]
    assert r["prompt"] == [0, 0, 0] + full[-3:]
    assert r["prompt_att_mask"] == [0, 0, 0, 1, 1, 1]


def test_batch_pad_and_has_answer(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [4]), (0, [1], [5, 6]), (1, [7], [8])], "b long, input_ids array<int>, labels array<int>")
    rows = {tuple(r["input_ids"]): r["labels"] for r in EN.batch_pad(df, "b").collect()}
    assert rows == {(1, 2, 3): [4, -100], (1, 0, 0): [5, 6], (7,): [8]}
    longer = spark.createDataFrame([(0, [1], [4, 5, 6]), (0, [1, 2], [7])], "b long, input_ids array<int>, labels array<int>")
    rows = sorted((r["input_ids"], r["labels"]) for r in EN.batch_pad(longer, "b").collect())
    assert rows == [([1, 0], [4, 5, 6]), ([1, 2], [7, -100, -100])]      # each to its own width
    seq = spark.createDataFrame([([1, 2, 5, 0],), ([1, 2, 5, 6],)], "s array<int>")
    assert [r[0] for r in seq.select(EN.has_answer(F.col("s"), 2, 0)).collect()] == [False, True]


def test_pairwise_requires_two_answers(spark):
    import pytest
    df = spark.createDataFrame([("p", "a")], "prompt string, response string")
    with pytest.raises(TypeError):
        EN.split_pair_response(df)


def test_python_tokenizer_works_in_array_encoders(spark):
    from weft.functions.tokens import PandasTokenizer
    from weft.operators import history as H
    tk = PandasTokenizer(lambda texts: [[len(w) + 3 for w in t.split()] for t in texts])
    df = spark.createDataFrame([(["a bb", "ccc", "dddd e", "ff"],)], "dialog array<string>")
    r = EN.encode_supervised(df, max_source=8, max_target=8, tokenizer=tk).first()
    assert r["input_ids"] == [tk.bos_id, 4, 5, 6, tk.eos_id, 7, 4, 5, tk.eos_id]
    hist = spark.createDataFrame([("q", "a", None, [("x y", "z")])],
                                 "query string, response string, prompt string, history array<struct<query:string,answer:string>>")
    out = H.fit_history_rounds(hist, 100, tokenizer=tk).first()
    assert out["n_history"] == 1 and out["labels"][-2:] == out["input_ids"][-2:]


def test_stack_pairs_numbers_ties_apart(spark):
    df = spark.createDataFrame([(0, 5, [1], [2]), (0, 5, [3], [4]), (0, 5, [3], [4]), (0, 1, [5], [6])], "b int, pos int, c array<int>, r array<int>")
    out = EN.stack_pairs(df, "b", "pos", "c", "r").collect()
    assert sorted(x["row"] for x in out) == list(range(8))
    assert {x["row"]: x["input_ids"] for x in out}[0] == [5] and {x["row"]: x["input_ids"] for x in out}[4] == [6]


def test_phase_one_labels_may_ignore_pads(spark):
    df = spark.createDataFrame([([7, 8, 0], [1, 1, 0])], "input_ids array<int>, attention_mask array<int>")
    assert EN.phase_record(df, 1).first()["labels"] == [7, 8, 0]
    assert EN.phase_record(df, 1, mask_pads=True).first()["labels"] == [7, 8, -100]
