"""The pipeline's stages, each against brute force on its own input; nulls, repeats and clashing columns."""

import collections
import hashlib
import importlib
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_dedup import components, cut, vote
from tests.llm.test_models import WORD, water_filled
from weft.llm import langid
from weft.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf):
    """Input and output of each stage, as lists of rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, sf), name)
        out[name] = (docs, docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def rows(table):
    return collections.Counter(tuple(r) for r in table)


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(steps)
    assert all(columns == COLUMNS for *_, columns in list(steps.values())[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_keeps_what_is_not_rejected(steps):
    docs, before, after, _ = steps["language_id"]
    kept = {r.doc_id for r in langid.with_language(docs).where("not rejected").collect()}
    assert rows(after) == rows(r for r in before if r.doc_id in kept)
    assert len(after) >= 0.97 * len(before)


def test_near_duplicate_stage_keeps_the_first_of_each_group(steps):
    _, before, after, _ = steps["simhash_near_dedup"]
    marks = [(r.doc_id, vote(r.text)) for r in before]
    first = set(components(marks))
    assert rows(after) == rows(r for r in before if r.doc_id in first)


def test_passage_stage_cuts_what_starts_earlier(steps):
    _, before, after, _ = steps["suffix_array_dedup"]
    want = {d: (n - gone, digest) for d, n, gone, _, digest in cut(before, 50)}
    assert len(after) == len(before)
    for r in after:
        assert r.n_chars == len(r.text)
        left, digest = want[str(r.doc_id)]
        if len(r.text.encode()) == left:           # no cut fell inside a character
            assert hashlib.sha256(r.text.encode()).hexdigest() == digest
        else:
            assert left - 6 * 40 <= len(r.text.encode()) < left


def test_mixing_stage_meets_its_targets(steps):
    _, before, after, _ = steps["mix_sources"]
    size = lambda r: len(WORD.findall(r.text or ""))
    had, took = collections.Counter(), collections.Counter()
    for r in before:
        had[r.source] += size(r)
    for r in after:
        took[r.source] += size(r)
    for s, t in water_filled(had, corpus_pipeline.WEIGHTS, 3).items():
        assert abs(took[s] - t) <= max(60, 0.05 * t)
    assert set(rows(after)) <= set(rows(before)) and max(rows(after).values()) <= 3


def test_token_stage_matches_the_library(steps):
    _, before, after, _ = steps["bpe_tokens"]
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in before]
    assert sorted((r.doc_id, list(r.ids)) for r in after) == sorted(want)
    back = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in before}
    assert {r.decoded_sha256 for r in after} == back


def test_run_gives_the_stages_result(spark, sf, steps):
    got = corpus_pipeline.run(spark, sf).select("doc_id", "ids_sha256").collect()
    assert rows(got) == rows((r.doc_id, r.ids_sha256) for r in steps["bpe_tokens"][2])


def test_odd_and_empty_tables(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = materialise(stage(spark, docs, sf), name)
            assert at == 4 or docs.columns == columns
        docs.collect()


def test_the_entry_works_without_the_subpackage(monkeypatch):
    class Gone:
        def find_spec(self, name, *_):
            if name in ("corpus_pipeline", "weft.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [m for m in sys.modules if m in ("corpus_pipeline", "__spark_entry__") or m.startswith("weft.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" not in entry.queries() and len(entry.queries()) > 130 and "T9_history_fit" in entry.oracle_sql()
