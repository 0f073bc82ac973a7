"""Boundary rows from FIXTURES.md §4 and the stage flows."""

from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER as TK
from weft.operators import align as AL
from weft.operators import encode as EN
from weft.operators import evaluate as EV
from weft.operators import metrics as M
from weft.operators import pack as PK
from weft.plans.prepare import StageConfig, prepare


def test_dialogue_length_1024_in_no_bucket(spark):
    rows = [(1, "a" * 500, "b" * 524), (2, "a" * 1000, "b" * 25), (3, "x" * 3000, "y" * 2000)]
    df = spark.createDataFrame(rows, "conv_id long, query string, response string")
    r = M.dialogue_length_buckets(df).first()
    assert (r["lt_1024"], r["gt_1024"], r["gt_2048"], r["gt_4096"]) == (0, 2, 1, 1)


def test_truncate_line_limit_and_limit_plus_one(spark):
    df = spark.createDataFrame([(list(range(5)),), (list(range(6)),)], "ids array<int>")
    got = [r[0] for r in df.select(EN.truncate_line(F.col("ids"), 5)).collect()]
    assert got == [[0, 1, 2, 3, 4], [0, 1, 2, 3]]


def test_pack_exact_block_and_short_group(spark):
    df = spark.createDataFrame([(0, 0, "a b c"), (1, 1, "d e")], "doc_id long, pack_group long, text string")
    out = {r["pack_group"]: r["input_ids"] for r in PK.pack_pretrain(df, 4).collect()}
    assert list(out) == [0] and len(out[0]) == 4 and out[0][0] == TK.bos_id


def test_align_and_nonempty_filter(spark):
    df = spark.createDataFrame([("i", "in", "o"), ("", "x", "o"), ("i", None, None)], "instruction string, input string, output string")
    a = AL.align(df, "instruction", "input", "output", None, prefix="pre")
    assert a.columns[-5:] == ["prompt", "query", "response", "history", "prefix"]
    kept = AL.keep_nonempty(a).collect()
    assert len(kept) == 1
    q = a.select(AL.dialog_query().alias("d")).collect()
    assert q[0]["d"] == "i\nin" and q[2]["d"] == "i"


def test_translation_rules(spark):
    turns = spark.createDataFrame([(1, {"a": "one two", "b": "three four"}), (2, {"a": "five six", "b": "seven eight"}),
                                   (3, {"a": "nine ten", "b": "x"})], "k long, turn map<string,string>")
    tr = spark.createDataFrame([("one two", " T1 "), ("three four", "T2"), ("five six", "翻译数据正在路上..."),
                                ("seven eight", "T4")], "source string, target string")
    out = EV.apply_translations(turns, tr, ["k"]).collect()
    chats = {r["k"]: dict(r["entry"]) for r in out if r["output"] == "chats"}
    missing = sorted((r["k"], r["seq"], tuple(sorted(r["entry"].items()))) for r in out if r["output"] == "missing")
    assert chats == {1: {"a": "T1", "b": "T2"}}
    # turn 2: one failure -> original recorded, then the partial translation (one value)
    assert missing == [(2, 0, (("a", "five six"), ("b", "seven eight"))), (2, 1, (("b", "T4"),))]
    # turn 3 fails the word-count rule and appears in neither output


def test_prepare_dispatch(spark):
    df = spark.createDataFrame([("hello there", None, "general kenobi", None, "")],
                               "prompt string, query string, response string, history array<struct<query:string,answer:string>>, prefix string")
    sft = prepare(df, "sft", StageConfig(max_source_length=64, max_target_length=64)).first()
    assert sft["labels"][-1] == TK.eos_id and -100 in sft["labels"]
    gen = prepare(df, "sft", StageConfig(predict_with_generate=True)).first()
    assert gen["input_ids"][0] == TK.bos_id and gen["labels"][0] == TK.bos_id
    rm_df = df.withColumn("response", F.array(F.lit("yes"), F.lit("no")))
    rm = prepare(rm_df, "rm", StageConfig(max_source_length=64, max_target_length=64)).first()
    assert rm["accept_ids"][-1] == TK.eos_id and rm["accept_ids"][:-2] == rm["reject_ids"][:-2]
