"""Packing against a per-token brute force, including one hot group
spread over many chunks."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from weft.functions.tokens import TOKEN_PATTERN
from weft.operators import pack as PK

TEXTS = ["alpha beta gamma", "", "d e f g h i j", "one, two; three!", "x", "longer text with several words in it ok"]


def _ids(t):
    return [3 + int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 31997 for w in re.findall(TOKEN_PATTERN, t)]


def _brute(groups, block, bos, keep_short, special):
    out = {}
    for g, docs in groups.items():
        stream = []
        for t in docs:
            ids = _ids(t)
            if special:
                ids = ([1] + ids) if True else ids
            stream += ids
        n = len(stream)
        full = (n // block) * block
        if keep_short and n < block:
            blocks = [stream] if stream else []
        else:
            blocks = [stream[i:i + block] for i in range(0, full, block)]
        for b, ids in enumerate(blocks):
            out[(g, b)] = ([1] + ids) if bos else ids
    return out


@pytest.mark.parametrize("chunk", [1, 2, 4096])
def test_pack_pretrain_matches_brute_force(spark, chunk):
    rows = [(i, 0 if i < 4 else 1, TEXTS[i]) for i in range(len(TEXTS))]
    df = spark.createDataFrame(rows, "doc_id long, pack_group long, text string")
    got = {(r["pack_group"], r["block"]): r["input_ids"]
           for r in PK.pack_pretrain(df, 4, chunk=chunk).collect()}
    groups = {0: TEXTS[:4], 1: TEXTS[4:]}
    assert got == _brute(groups, 3, True, False, False)


def test_group_texts_keeps_lone_short_block(spark):
    rows = [(0, 0, "a b"), (1, 1, "c d e f g h i j k")]
    df = spark.createDataFrame(rows, "doc_id long, pack_group long, text string")
    got = {(r["pack_group"], r["block"]): r["input_ids"] for r in PK.group_texts(df, 5).collect()}
    assert got == _brute({0: ["a b"], 1: ["c d e f g h i j k"]}, 5, False, True, True)


def test_one_hot_group_conserves_tokens(spark):
    df = spark.range(0, 300).select(F.col("id").alias("doc_id"), F.lit(7).alias("pack_group"),
                                    F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" x y")).alias("text"))
    out = PK.pack_pretrain(df, 9, chunk=16)
    total = 300 * 3
    assert out.count() == total // 8
    assert out.select(F.sum(F.size("input_ids"))).first()[0] == (total // 8) * 9


def test_sparse_float_and_null_keys_lose_no_token(spark):
    rows = [(1e12 * i if i % 2 else i / 1000.0, None if i % 3 == 0 else 1, f"w{i} x y") for i in range(60)] + [(None, 1, "a b c")]
    df = spark.createDataFrame(rows, "doc_id double, pack_group long, text string")
    for chunk in (4, 4096):
        out = PK.group_texts(df, 1000, chunk=chunk).collect()
        assert {r["pack_group"]: len(r["input_ids"]) for r in out} == {None: 20 * 4, 1: 41 * 4}


def test_one_tokenising_pass(spark):
    df = spark.createDataFrame([(0, 0, "a b c")], "doc_id long, pack_group long, text string")
    plan = PK.pack_pretrain(df, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan       # it ran once, before the ids were written


def test_each_text_is_tokenised_once(spark, tmp_dir):
    """A counting tokenizer, called in Python workers, writes a line a text."""
    import os

    from weft.functions.tokens import PandasTokenizer
    log = f"{tmp_dir}/calls"
    os.makedirs(log)

    def encode(texts):
        import uuid
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write("x\n" * len(texts))
        return [[len(w) for w in t.split()] for t in texts]

    df = spark.range(0, 500).select(F.col("id").alias("doc_id"), F.lit(1).alias("pack_group"), F.concat(F.lit("aa bbb "), F.col("id").cast("string")).alias("text"))
    for pack in (lambda t: PK.pack_pretrain(df, 9, tokenizer=t), lambda t: PK.group_texts(df, 8, tokenizer=t)):
        for name in os.listdir(log):
            open(f"{log}/{name}", "w").close()
        blocks = pack(PandasTokenizer(encode)).collect()
        assert blocks
        assert sum(open(f"{log}/{n}").read().count("x") for n in os.listdir(log)) == 500


@pytest.mark.parametrize("chunk", [3, 64, 4096])
def test_running_sums_of_hot_and_tiny_groups(spark, chunk):
    """Groups that begin, end and go on over chunks and partitions, null groups and orders, broadcasts off."""
    import random
    rnd = random.Random(chunk)
    rows = [(rnd.choice([None, 1, 1, 1, 1, 2, 3 + i // 3]), float(i) if rnd.random() < 0.95 else i + 0.5, rnd.randint(0, 9)) for i in range(700)]
    df = spark.createDataFrame(rows, "g long, o double, v int").repartition(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {(r["g"], r["o"]): (r["s"], r["n"]) for r in PK.running_sums(df.withColumn("one", F.lit(1)), "g", "o", {"v": "s", "one": "n"}, chunk).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want, state = {}, {}
    for g, o, v in sorted(rows, key=lambda r: r[1]):
        s, n = state.get(g, (0, 0))
        want[g, o] = (s, n)
        state[g] = (s + v, n + 1)
    assert got == want
