"""SimHash and passage dedup against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import documents
from weft.llm import simhash_index, suffix_dedup
from weft.llm.components import connected_components


def vote(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(marks):
    """(id, fingerprint) rows -> smallest id reachable, by comparing all."""
    marks = list(marks)
    group = list(range(len(marks)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    fps = np.array([f for _, f in marks], np.uint64)
    for i in range(len(marks)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            group[find(int(j))] = find(i)
    ids = {}
    for i, (d, _) in enumerate(marks):
        ids.setdefault(find(i), []).append(d)
    return [min((d for d in ids[find(i)] if d is not None), default=None) for i in range(len(marks))]


def check_simhash(docs):
    rows = docs.select("doc_id", "text").collect()
    marks = [(r.doc_id, vote(r.text)) for r in rows]
    # a row with a null id carries the component of its fingerprint but is no node
    whole = components([m for m in marks if m[0] is not None])
    of = {f: c for (_, f), c in zip([m for m in marks if m[0] is not None], whole)}
    want = sorted((str(d), f"{f:016x}", str(of.get(f))) for d, f in marks)
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash_index.near_duplicates(docs).collect())
    assert got == want


def test_simhash_matches_brute_force(spark, sf):
    check_simhash(documents(spark, sf))


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    check_simhash(odd_docs)
    assert simhash_index.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("key_bytes,chunk", [(3, 4096), (4, 16), (2, 16), (1, 64)])
def test_links_connect_a_dense_group(spark, key_bytes, chunk):
    """A chain and a ball of fingerprints, with posting lists cut into chunks, long runs and short ones."""
    rng = np.random.default_rng(3)
    center = int(rng.integers(1 << 62))
    fps = [center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (150, 2))]
    chain = [int(rng.integers(1 << 62))]
    for b in range(40):
        chain.append(chain[-1] ^ (0b1011 << b))
    fps = list(dict.fromkeys([*fps, *chain, *rng.integers(0, 1 << 62, 100).tolist()]))
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long")
    links = simhash_index.links(nodes, 4, key_bytes, chunk)
    assert all(bin(fps[r.a] ^ fps[r.b]).count("1") <= 4 for r in links.collect())
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = components(list(enumerate(fps)))
    assert [got.get(i, i) for i in range(len(fps))] == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_that_share_an_id_or_have_none(spark):
    """Different texts with one id stay apart; near copies with null ids are one group."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 4000)]
    one, two, three = (" ".join(words[a:a + 1000]) for a in (0, 1000, 2000))
    near = next(t for t in (f"{three} end{i} of it" for i in range(200)) if 0 < (vote(three) ^ vote(t)).bit_count() <= 4)
    docs = spark.createDataFrame([(1, one), (1, two), (2, two), (None, three), (None, near), (3, "x y z")], "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text) for r in simhash_index.keep_one(docs).collect())
    assert [k for k in kept if k[0] != "None"] == sorted([("1", one), ("1", two), ("3", "x y z")])
    assert len([k for k in kept if k[0] == "None"]) == 1
    again = spark.createDataFrame([(1, one), (1, two), (2, one), (3, two)], "doc_id long, text string")
    assert sorted(r.text for r in simhash_index.keep_one(again).collect()) == sorted([one, two])


def test_keep_one(spark, odd_docs):
    kept = simhash_index.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    whole = simhash_index.near_duplicates(odd_docs).collect()
    groups = {(r.component_id, r.fingerprint if r.component_id is None else None) for r in whole}
    assert len(ids) == len(groups)
    assert {str(r.component_id) for r in whole if r.component_id is not None} <= set(ids)


def cut(rows, length):
    """(id, text) rows -> per row (bytes, removed, spans, digest), by comparing all strings."""
    code = [((r.text or "").encode(), float("inf") if r.doc_id is None else r.doc_id, r) for r in rows]
    first = {}
    for raw, d, _ in code:
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            first[w] = min(d, first.get(w, d))
    out = []
    for raw, d, r in code:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < d:
                gone[p:p + length] = True
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((str(r.doc_id), len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block,shard,anchor,length", [(8 << 20, 16 << 20, 22, 50), (20_000, 50_000, 22, 50), (3_000, 9_000, 9, 20)])
def test_passages_match_brute_force(spark, sf, block, shard, anchor, length):
    docs = documents(spark, sf)
    got = suffix_dedup.mark_repeats(docs, length, anchor, block_bytes=block, shard_bytes=shard)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.drop("kept").collect())
    assert got == cut(docs.select("doc_id", "text").collect(), length)


def test_passages_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    got = suffix_dedup.mark_repeats(odd_docs, 50, block_bytes=400_000).drop("kept").collect()
    want = cut(odd_docs.select("doc_id", "text").collect(), 50)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert suffix_dedup.mark_repeats(no_docs).collect() == []
    kept = suffix_dedup.cut_repeats(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert [r.text for r in kept.where("doc_id = 3").collect()] == [None]


def test_a_passage_in_most_documents(spark):
    """One passage between different words: its edges have a name in each document (markers stand for them)."""
    passage = "this is the passage that a third of all documents share, word for word, and it is long"
    rows = [(i, f"begin {i * 7919} {passage} end {i * 104729} " + ("x" * (i % 70))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.mark_repeats(docs, 50, block_bytes=4_000).drop("kept").collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == cut(docs.collect(), 50)


def test_slices_of_a_long_text(monkeypatch):
    """Units cut at a slice differ from those of the whole text, but cover the same windows."""
    rng = np.random.default_rng(0)
    text = bytes(rng.integers(97, 123, 5_000).astype(np.uint8))
    whole = suffix_dedup.Units([text, b"short", text], 50, 22)
    monkeypatch.setattr(suffix_dedup, "SLICE", 700)
    cut_up = suffix_dedup.Units([text, b"short", text], 50, 22)
    for units in (whole, cut_up):
        places = np.concatenate([np.arange(f, f + c) for f, c in zip(units.first, units.count)])
        assert sorted(places.tolist()) == [*range(4951), *range(5005, 5005 + 4951)]
        assert (np.bincount(units.doc, weights=units.count) == [4951, 0, 4951]).all()
