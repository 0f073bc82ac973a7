from pyspark.sql import functions as F

from weft.functions import text as TX
from weft.operators import evaluate as EV


def _apply(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


def test_mentions_retweets_links(spark):
    assert _apply(spark, TX.remove_mentions, ["hi @bob", "hi @bob there"]) == ["hi @bob", "hi  there"]
    assert _apply(spark, TX.remove_retweets, ["say RT hello", "RT  hello"]) == ["say RT hello", " hello"]
    assert _apply(spark, TX.remove_links, ["see http://x.y/z\nnext"]) == ["see  \nnext"]
    assert _apply(spark, TX.collapse_spaces, ["a   b\r\n c"]) == ["a b c"]
    assert _apply(spark, TX.remove_punctuation, ['a"b,c!d']) == ["abcd"]


def test_clean_tweet_chain(spark):
    got = _apply(spark, TX.clean_tweet, ["RT @amy: the cat &amp; the hat #fun https://t.co/x is here"])
    assert got == ["cat hat fun"]


def test_split_links(spark):
    assert _apply(spark, TX.split_links, ["intro http://a then http://b"]) == [["intro ", "http://a then ", "http://b"]]


def test_extract_tagged_and_cuts(spark):
    assert _apply(spark, lambda c: TX.extract_tagged(c, "student"),
                  ["<dialog><student> hello </student></dialog>", "student: hi"]) == ["hello", "student hi"]
    df = spark.createDataFrame([("a<|endoftext|></s> Human: b Human: c",)], "t string")
    assert df.select(TX.cut_response(F.col("t"), 1)).first()[0] == "a Human: b "
    assert df.select(TX.cut_response(F.col("t"), 5)).first()[0] == "a Human: b Human: c"
    assert _apply(spark, lambda c: TX.after_last(c, "<|assistant|>: "), ["x<|assistant|>: y<|assistant|>: z"]) == ["z"]
    assert _apply(spark, lambda c: TX.after_last_api(c), ["q<|assistant|>: answer12345678", "short"]) == ["answer", ""]


def test_parse_judge_edge_lines(spark):
    text = ("Here are the scores:\nQuestion 1: model1 score: 40,  model2 score: 90\n"
            "Question 2: model1 score: 10, model2 score: 20\n"      # one space: not parsed
            "Question 4: model1 score: 7,  model2 score: 8\nQuestion 1: model1 score: 1,  model2 score: 2\n")
    df = spark.createDataFrame([(0, text)], "batch long, judge_text string")
    parsed = {r["member"]: (r["score_1"], r["score_2"]) for r in EV.parse_judge(df, "batch").collect()}
    assert parsed == {1: (1, 2), 4: (7, 8)}                  # later line for question 1 wins
    members = spark.createDataFrame([(0, m) for m in range(1, 5)], "batch long, member int")
    scores = {r["member"]: r["score_1"] for r in EV.judge_scores(members, EV.parse_judge(df, "batch")).collect()}
    assert scores == {1: 1, 2: -1, 3: -1, 4: 7}


def test_turn_quality(spark):
    df = spark.createDataFrame([({"input": "two words", "output": "and more"},), ({"input": "one", "output": "x y"},),
                                ({"dany_q": "one", "output": "z"},)], "m map<string,string>")
    assert [r[0] for r in df.select(TX.turn_passes(F.col("m"))).collect()] == [True, False, True]
