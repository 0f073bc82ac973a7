"""Vocabulary ids against plain Python, and back to text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weft.functions.tokens import TOKEN_PATTERN, VocabTokenizer
from weft.operators import encode as EN
from weft.operators import pack as PK
from weft.sources import sinks as SK

VOCAB = {"the": 4, "th": 5, "t": 6, "a": 7, "ab": 8, "abc": 9, "b": 10, "c": 11, "é": 12, "!": 13, "x_1": 14, "long" * 8: 15}
TEXTS = ["the abc ab a", "tthe abcab! cab", "zzz the é ü!", "", None, "x_1 x_1x t" + "long" * 9, "a" * 300, " \t\n ", "thethe" * 30]


def _cut(word):
    if word in VOCAB:
        return [VOCAB[word]]
    if len(word) > 200:
        return [3]
    out, i = [], 0
    while i < len(word):
        n = next((n for n in range(min(32, len(word) - i), 0, -1) if word[i:i + n] in VOCAB), None)
        out.append(VOCAB[word[i:i + n]] if n else 3)
        i += n or 1
    return out


def _words(text):
    return re.findall(TOKEN_PATTERN, text, re.ASCII)


@pytest.fixture(scope="module")
def table(spark):
    rows = [*VOCAB.items(), ("the", 99), (None, 50), ("null id", None)]      # the smallest id of a token counts
    return spark.createDataFrame(rows, "token string, id int")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(TEXTS)], "doc_id long, text string, pack_group long")


@pytest.mark.parametrize("greedy", [False, True])
def test_ids_counts_and_arrays(spark, table, texts, greedy):
    tk = VocabTokenizer(table, unk_id=3, greedy=greedy)
    for r in texts.select("text", tk.ids("text").alias("ids"), tk.ids("text", True).alias("special"), tk.count("text").alias("n"),
                          tk.ids_many(F.array("text", F.lit("the zz"))).alias("many"), tk.count_many(F.array("text", F.lit("the zz"))).alias("counts")).collect():
        if r["text"] is None:
            assert r["ids"] is None
            continue
        want = [i for w in _words(r["text"]) for i in (_cut(w) if greedy else [VOCAB.get(w, 3)])]
        other = [4, 3, 3] if greedy else [4, 3]
        assert (r["ids"], r["special"], r["n"], r["many"], r["counts"]) == (want, [1, *want], len(want), [want, other], [len(want), len(other)])


def test_many_tokens_and_round_trip(spark):
    """A large vocabulary; ids decode to the tokens (K5)."""
    rnd = random.Random(1)
    vocab = spark.range(0, 30_000).select(F.concat(F.lit("w"), F.col("id")).alias("token"), (F.col("id") + 4).cast("int").alias("id"))
    tk = VocabTokenizer(vocab, unk_id=3)
    words = [[f"w{rnd.randrange(30_000)}" for _ in range(40)] for _ in range(50)]
    docs = spark.createDataFrame([(" ".join(w),) for w in words], "text string").select("text", tk.ids("text").alias("preds"), tk.ids("text").alias("labels"))
    back = SK.generated_predictions(docs, SK.vocabulary(vocab, 30_004), {0, 1, 2}, 0)
    assert sorted(r["predict"] for r in back.collect()) == sorted(" ".join(w) for w in words)


def test_plugs_into_encoders(spark, table, texts):
    tk = VocabTokenizer(table, unk_id=3, greedy=True)
    ids = {r["doc_id"]: [i for w in _words(r["text"]) for i in _cut(w)] for r in texts.where("text is not null").collect()}
    blocks = PK.pack_pretrain(texts, 6, tokenizer=tk).collect()
    stream = {g: [i for d in sorted(ids) if d % 2 == g for i in ids[d]] for g in (0, 1)}
    assert {(r["pack_group"], r["block"]): r["input_ids"] for r in blocks} == {
        (g, b): [1, *s[5 * b:5 * b + 5]] for g, s in stream.items() for b in range(len(s) // 5)}
    one = EN.fixed_length(texts.where("doc_id = 0"), "text", 20, tokenizer=tk).first()
    assert one["input_ids"][:5] == [1, 4, 9, 8, 7]


def test_a_vocabulary_is_bounded(spark, table):
    with pytest.raises(ValueError):
        VocabTokenizer(table, unk_id=3, max_size=5)


def test_a_word_is_cut_once_a_batch():
    """Greedy cutting does the work of a batch's different words, not of all."""
    import pyarrow as pa

    from weft.functions.tokens import _longest_pieces
    looked = []

    class Counted(dict):
        def get(self, key):
            looked.append(key)
            return super().get(key)

    one, many = (u.func for u in _longest_pieces(Counted(VOCAB), 3, 32, 200))
    words = [["thethe", "zz"] * 500, None, [], ["abcab"]]
    assert one(pa.array(words)).to_pylist() == [[4, 4, 3, 3] * 500, None, [], [9, 8]]
    assert len(looked) < 40
    assert many(pa.array([[["thethe"], None], None, [[], ["t"]]])).to_pylist() == [[[4, 4], None], None, [[], [6]]]
