"""Language ID, nearest neighbours, BPE, n-gram scores and mixing against brute force or the library."""

import collections
import hashlib
import json
import math
import mmap
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import CLASHES, documents
from weft.llm import bpe, cross_polytope, entropy_mix, langid, ngram_trie
from weft.llm.blocks import pack, steps, unpack

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def held(i, modulus):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == 2


# ---- op4 --------------------------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = langid.with_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == held(r.doc_id, 4) and 0 <= r.score <= 1
    tested = [r for r in rows if r.held_out and r.lang is not None]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.97 * len(tested) and len(tested) > 200


def test_only_training_rows_teach(spark):
    """Held-out labels, sources and ids change nothing."""
    docs = documents(spark, "/root/testdata/sf0.001")
    spoiled = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    spoiled = spoiled.withColumn("source", F.lit("z"))
    a, b = (sorted(map(tuple, langid.with_language(d).collect())) for d in (docs, spoiled))
    assert a == b


def test_language_odd_rows(spark, odd_docs, no_docs):
    got = langid.with_language(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r.doc_id in (3, 4, 7, 8):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert langid.with_language(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.with_language(unlabelled).collect()} == {"und"}
    assert langid.keep_identified(odd_docs).columns == odd_docs.columns


def test_a_clean_text_of_any_length_is_kept(spark):
    docs = documents(spark, "/root/testdata/sf0.1").select("doc_id", "text", "lang")
    text = " ".join(r.text for r in docs.where("lang = 'en' and text is not null").orderBy("doc_id").collect())
    text *= -(-10_500_000 // len(text))
    assert len(text) > 10_000_000 and len(langid.words_of(text)) > 1_000_000
    classify = langid.Classifier(langid.fit_dictionaries(documents(spark, "/root/testdata/sf0.01")), 6)
    scores = {n: classify(text[:n]) for n in (100_000, 1_000_000, len(text))}
    print(scores)
    assert all(lang == "en" and score > 0.02 for lang, score in scores.values()), scores


def test_predictions_are_the_smallest_sizes(spark, sf):
    """Every prediction and score against the library called directly, piece by piece."""
    import regex
    import zstandard

    docs = documents(spark, sf)
    dictionaries = langid.fit_dictionaries(docs.where(~(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)))
    assert set(dictionaries) == {r["lang"] for r in docs.select("lang").where("lang is not null").distinct().collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def size(lang, words):
        held = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=6, dict_data=held, write_content_size=False)
        return sum(len(packer.compress(words[i:i + 8192])) for i in range(0, len(words), 8192))

    for r in langid.with_language(docs).collect():
        words = " ".join(dict.fromkeys(regex.findall(r"\p{L}+", (texts[r["doc_id"]] or "").lower()))).encode()
        if not words:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        sizes = sorted((size(lang, words), i, lang) for i, lang in enumerate(dictionaries))
        assert r["lang_pred"] == sizes[0][2] and r["score"] == pytest.approx(1 - sizes[0][0] / sizes[1][0])


def test_number_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "½ ½ 12"), (2, "②"), (3, "Ⅳ ⅷ"), (4, "x²"), (5, "٣ ५")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    model = langid.fit_dictionaries(documents(spark, "/root/testdata/sf0.001"))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert {i: got[i] for i in (1, 2, 3, 5)} == dict.fromkeys((1, 2, 3, 5), "und") and got[4] != "und"
    assert langid.words_of("x²y ½ été²") == "x y été".encode()


def test_samples_spread_over_texts_and_languages_are_bounded(spark):
    """The middle and the end of a long text teach; of many labels the most frequent do."""
    rows = [(i, "start " * 200 + "middle " * 200 + "finish " * 200, "a") for i in range(30)] + [(100 + i, "other words here", f"rare{i:03}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.fit_dictionaries(docs, languages=9)
    assert list(found) == ["a", *[f"rare{i:03}" for i in range(8)]]
    assert {b"start", b"middle", b"finish"} <= set(found["a"].split())


# ---- op5 --------------------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, query, k):
    """Rows (id, vector) -> the k nearest of one row's others by (score, id)."""
    scores = [(-float(np.dot(np.float64(np.float32(query[1])), np.float64(np.float32(v)))), i) for j, (i, v) in enumerate(rows) if rows[j] is not query]
    return sorted(scores)[:k]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    found = collections.defaultdict(dict)
    for block in (8192, 100):  # cells whole, and cut into blocks
        got = cross_polytope.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, cross_polytope.Plan(block=block)).collect()
        for r in got:
            found[block, r.query_id][r.rank] = (r.vec_id, r.score)
    hits = []
    for q in range(0, 3000, 20):
        assert found[8192, q] == found[100, q] and sorted(found[100, q]) == list(range(1, 21))
        want = brute(rows, rows[q], 20)
        hits.append(len({i for _, i in want} & {i for i, _ in found[100, q].values()}))
        for i, s in found[100, q].values():
            assert s == pytest.approx(float(np.dot(np.float64(x[q].astype(np.float32)), np.float64(x[i].astype(np.float32)))), abs=1e-12)
    assert np.mean(hits) >= 0.9 * 20


@pytest.mark.parametrize("kind", ["log-normal", "few long", "one long"])
def test_recall_on_unequal_norms(spark, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(8000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "log-normal":
        x *= rng.lognormal(0, 0.5, (8000, 1))
    else:
        x[7:8000:100 if kind == "few long" else 8000] *= 10
    x = x.astype(np.float32)
    table = vectors(spark, [(i, v) for i, v in enumerate(x.tolist())])
    found = collections.defaultdict(set)
    for r in cross_polytope.nearest(table, F.col("vec_id") % 100 == 0, cross_polytope.Plan()).collect():
        found[r.query_id].add(r.vec_id)
    score = x[::100].astype(np.float64) @ x.T.astype(np.float64)
    score[np.arange(80), np.arange(0, 8000, 100)] = -np.inf
    hits = [len(found[100 * i] & set(row.tolist())) / 20 for i, row in enumerate(np.argsort(-score, axis=1)[:, :20])]
    assert np.mean(hits) >= 0.95 and min(hits) >= 0.7, (np.mean(hits), min(hits))


def test_products_beyond_doubles_take_part(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1.0]), (2, [1e120, 0.0]), (3, [-1e200, 0.0]), (4, [1.0, 1e200])]
    got = cross_polytope.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [1, 2, 4, 3]


def test_ties_copies_and_small_tables(spark):
    copies = [(i, [1.0, 0.0, 0.5]) for i in range(40)] + [(100, [0.0, 1.0, 0.0])]
    got = cross_polytope.nearest(vectors(spark, copies), F.col("vec_id") % 20 == 0, cross_polytope.Plan(k=5)).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r.query_id].append(r.vec_id)
    assert by[0] == [1, 2, 3, 4, 5] and by[20] == [0, 1, 2, 3, 4] and by[100] == [0, 1, 2, 3, 4]
    few = cross_polytope.nearest(vectors(spark, copies[:3] + copies[-1:]), F.col("vec_id") == 0, cross_polytope.Plan(k=20)).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 100]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.6, 0.8]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (1, [0.6, 0.8]), (8, [])]
    table = vectors(spark, rows).select("*", *[F.lit(0).alias(c) for c in CLASHES])
    got = cross_polytope.nearest(table, F.col("vec_id") >= 0, cross_polytope.Plan(k=20)).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 1), (1, 1, 1), (1, 1, 1), (1, 2, 0), (1, 2, 0)]
    assert cross_polytope.nearest(table.limit(0), F.col("vec_id") >= 0).collect() == []


# ---- op6 --------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(back)


def test_tokens_match_the_library(spark, sf, library, odd_docs, no_docs):
    for table in (documents(spark, sf), odd_docs):
        got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(table, VOCABULARY).collect())
        assert got == sorted((str(r.doc_id), *digest(library, r.text)) for r in table.select("doc_id", "text").collect())
    assert bpe.digests(no_docs, VOCABULARY).collect() == []


def test_odd_strings_match_the_library(library):
    with open(VOCABULARY, encoding="utf-8") as f:
        mine = bpe.ByteBPE(f.read(), cache=50)          # so small that pieces leave and come back
    letters = "aAbe'sltrvmd    \t\n\r\x0b\x0c\x1c\x00\x85\xa0  　éßñ漢字1²½Ⅷ٣-_*#$\U0001f600\U00010400́‍"
    rng = random.Random(1)
    for i in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        if i % 40 == 0:
            text = f"{text}<|endoftext|>{text}<|endoftext"
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids and mine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for _ in range(300):
        ids = rng.choices(range(50257), k=6)
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert mine.encode("a" * 20_000) == library.encode("a" * 20_000, add_special_tokens=False).ids


def test_runs_of_mixed_white_space_match_the_library(library):
    """White space runs without two adjacent ASCII spaces are one piece too."""
    with open(VOCABULARY, encoding="utf-8") as f:
        mine = bpe.ByteBPE(f.read())
    rng = random.Random(2)
    texts = ["a" + " \xa0" * n + tail for n in range(1, 20) for tail in ("", " ", " b", "b", "\n b")]
    texts += ["".join(rng.choice([" \xa0", "\xa0", "\t ", " \n", " a", "b", "'s", "1", "\u2003 ", " \u3000"]) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    for text in texts:
        assert mine.encode(text) == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_rare_words_are_merged_together(library):
    """Pieces that the cache lacks, a lot at a time; the heap is for long ones."""
    with open(VOCABULARY, encoding="utf-8") as f:
        mine = bpe.ByteBPE(f.read(), cache=300)
    heaps = []
    one = mine.encode_piece
    mine.encode_piece = lambda piece: heaps.append(piece) or one(piece)
    rng = random.Random(3)
    parts = ["the", "tion", "ing", "ß", "漢", "e", "on", "1", "22", "'s", ".", "\n", "\xa0", "__", "Th"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 9)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", "x" * 65, "a  b" * 9, "q<|endoftext|> w", "b"]
    assert [a.tolist() for a in mine.encode_all(texts)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert all(len(h.encode()) > bpe.WIDTHS[-1] for h in heaps) and "x" * 65 in heaps


def test_small_lots_match_the_library(library, monkeypatch):
    """Texts of many lots, and words of more pieces than a lot."""
    monkeypatch.setattr(bpe, "LOT", 7)
    monkeypatch.setattr(bpe, "CELLS", 150)
    with open(VOCABULARY, encoding="utf-8") as f:
        mine = bpe.ByteBPE(f.read(), cache=9)
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab.1é \n", (5, 5, 3, 3, 2, 4, 1), k=rng.choice([0, 3, 40, 400]))) for _ in range(120)] + ["a.b1" * 50, "c " * 30 + "d"]
    assert [a.tolist() for a in mine.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_merges_in_any_order_of_ranks():
    """A later rule may make what an earlier one merges; arrays, heap and plain search agree."""
    rng = random.Random(5)
    for _ in range(20):
        strings, merges = set("abc"), []
        for _ in range(40):
            left, right = rng.choice(sorted(strings)), rng.choice(sorted(strings))
            if len(left + right) <= 6 and [left, right] not in merges:
                strings.add(left + right)
                merges.append([left, right])
        rng.shuffle(merges)
        vocab = {c: i for i, c in enumerate(bpe.byte_letters())}
        vocab |= {s: 256 + i for i, s in enumerate(sorted(strings - set("abc")))}
        mine = bpe.ByteBPE(json.dumps({"model": {"vocab": vocab, "merges": merges}}))
        rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
        pieces = sorted({"".join(rng.choices("aabc", k=rng.randint(1, 70))) for _ in range(150)})
        for piece, ids in zip(pieces, mine.encode_pieces(pieces)):
            want = [vocab[c] for c in piece]
            while found := [(rank[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in rank]:
                i = min(found)[1]
                want[i:i + 2] = [rank[want[i], want[i + 1]][1]]
            assert np.frombuffer(ids, np.int32).tolist() == want == np.frombuffer(mine.encode_piece(piece), np.int32).tolist()


def test_round_trip_through_tables(spark, odd_docs):
    ids = bpe.encode(odd_docs, VOCABULARY)
    back = sorted((str(r.doc_id), r.text) for r in bpe.decode(ids, VOCABULARY).collect())
    assert back == sorted((str(r.doc_id), r.text or "") for r in odd_docs.select("doc_id", "text").collect())


# ---- op7 --------------------------------------------------------------------------------------------

def plain_scores(rows, mu=100.0):
    docs = [(r.doc_id, held(r.doc_id, 7), WORD.findall((r.text or "").translate(LOWER)) + ["\n"]) for r in rows]
    one, two = collections.Counter(), collections.Counter()
    for _, out, w in docs:
        if not out:
            one.update(w)
            two.update(zip(["\n", *w], w))
    n, v = sum(one.values()), len(one)
    alone = lambda w: (one[w] + 1) / (n + v + 1)
    for i, out, w in docs:
        score = 0.0
        for a, b in zip(["\n", *w], w):
            p = math.log10((two[a, b] + mu * alone(b)) / (one[a] + mu))
            score += -round(-p / ngram_trie.STEP) * ngram_trie.STEP if two[a, b] else p
        yield str(i), out, len(w), sum(one[x] > 0 for x in w), n, sum(math.log10(alone(x)) for x in w), score


@pytest.mark.parametrize("block,shard", [(8 << 20, 16 << 20), (30_000, 40_000)])
def test_scores_match_brute_force(spark, sf, odd_docs, block, shard):
    for table in (documents(spark, sf), odd_docs):
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                     for r in ngram_trie.score(table, block_bytes=block, shard_bytes=shard).collect())
        want = sorted(plain_scores(table.select("doc_id", "text").collect()))
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-6)
        if table is not odd_docs:
            assert sum(g[6] for g in got if g[1]) > sum(g[5] for g in got if g[1])    # better than words alone on held-out texts


def test_scores_without_rows_or_training(spark, no_docs):
    assert ngram_trie.score(no_docs).collect() == []
    out = next(i for i in range(100) if held(i, 7))
    r = ngram_trie.score(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_elias_fano_and_trie():
    rng = np.random.default_rng(2)
    for n, top in ((1, 5), (1000, 10), (1000, 10**6), (500, 2**50), (3, 0), (64, 63), (20_000, 30_000), (20_000, 2**40)):
        values = np.sort(rng.integers(0, top + 1, n).astype(np.uint64))
        values[n // 2:n // 2 + n // 4] = values[n // 2]    # a long run in one place
        values.sort()
        seq = ngram_trie.Monotone(np.frombuffer(ngram_trie.encode_monotone(values), np.uint8))
        assert (seq[np.arange(n)] == values).all()
        asked = np.concatenate([values, rng.integers(0, top + 2, 200).astype(np.uint64), np.array([2 * top + 9, 2**62], np.uint64)])
        assert sum(part.nbytes for part in (seq.lows, seq.words, seq.ones, seq.zeros)) <= 128 + n * (seq.low / 8 + 1.2)
        assert (seq.successor(asked) == np.searchsorted(values, asked)).all()
        assert (unpack(pack(steps(values), values))[0].cumsum(dtype=np.uint64) == values).all()
    pairs = np.unique(rng.integers(0, 40, (600, 2)), axis=0).astype(np.uint64)
    body = ngram_trie.Trie.build(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)))
    mapped = mmap.mmap(-1, len(body))
    mapped.write(body)
    trie = ngram_trie.Trie(mapped)
    known = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    a, b = (g.reshape(-1).astype(np.uint64) for g in np.meshgrid(np.arange(45), np.arange(45)))
    there, value = trie.find(a, b)
    for x, y, t, v in zip(a.tolist(), b.tolist(), there.tolist(), value.tolist()):
        assert t == ((x, y) in known) and (not t or v == known[x, y])


# ---- op9 --------------------------------------------------------------------------------------------

def water_filled(sizes, weights, cap):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = float(sum(sizes.values())), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        target = {s: cap * sizes[s] if s in full else left * w[s] / sum(w[x] for x in rest) for s in names}
        over = {s for s in rest if target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("weights", [[5.0, 2.0, 1.0], [100.0, 1.0, 1.0, 1.0], [1.0]])
def test_mix_meets_its_targets(spark, weights):
    docs = documents(spark, "/root/testdata/sf0.01").withColumn("source", F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 2 == 0, "src0").otherwise(F.col("source")))
    rows = docs.select("doc_id", "text", "source").collect()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in rows}
    total = collections.Counter()
    for r in rows:
        total[r.source] += size[r.doc_id]
    target = water_filled(total, weights, 3)
    got = {r.doc_id: r for r in entropy_mix.mix(docs, weights).collect()}
    again = {r.doc_id: r.taken for r in entropy_mix.mix(docs.repartition(7), weights).collect()}
    taken = collections.Counter()
    for r in rows:
        g = got[r.doc_id]
        assert (g.size, g.source_size) == (size[r.doc_id], total[r.source]) and g.target == pytest.approx(target[r.source], rel=1e-9)
        assert 0 <= g.taken <= 3 * g.size and g.taken == g.copies * g.size and again[r.doc_id] == g.taken
        taken[r.source] += g.taken
    for s in total:
        assert taken[s] == pytest.approx(target[s], rel=0.02)


def test_rates_are_exponential_tilts(spark):
    """The rates solve the dual: r = min(cap, exp(lam x size / unit)) with sum(r x size) = target."""
    cells = spark.createDataFrame([("a", s, n) for s, n in ((1, 50), (10, 20), (100, 9), (700, 2))], "source string, size long, n long")
    for target in (50.0, 1000.0, 2550.0, 4000.0, 7649.0, 7650.0):
        targets = spark.createDataFrame([("a", 2550, target)], "source string, source_size long, target double")
        t = entropy_mix.tilts(cells, targets).first()
        rate = [min(3.0, math.exp(min(t.lam * s / t.unit, 2))) for s in (1, 10, 100, 700)]
        assert sum(r * s * n for r, (s, n) in zip(rate, ((1, 50), (10, 20), (100, 9), (700, 2)))) == pytest.approx(target, rel=1e-6)


def test_mix_odd_rows(spark, odd_docs, no_docs):
    got = entropy_mix.mix(odd_docs, [5.0, 2.0, 1.0]).collect()
    assert len(got) == odd_docs.count() and all(r.taken <= 3 * r.size for r in got)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert entropy_mix.mix(no_docs, [1.0]).collect() == []
    repeated = entropy_mix.repeat_copies(odd_docs, [5.0, 2.0, 1.0])
    assert repeated.columns == odd_docs.columns and repeated.count() == sum(r.copies for r in got)
    one_size = spark.createDataFrame([(i, "a b c", "s" if i % 3 else "t") for i in range(500)], "doc_id long, text string, source string")
    rows = entropy_mix.mix(one_size, [1.0, 3.0]).collect()
    assert sum(r.taken for r in rows) == pytest.approx(1500, abs=9)
