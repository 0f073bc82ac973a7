"""Corpus pipeline: language identification, near-duplicates, repeated passages, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept, and returns the columns of ``documents``; the last returns
the tokens.  No SQL states the stages (hash votes, compression, merges), so
``tests/llm/test_pipeline.py`` holds them against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weft.llm import bpe, entropy_mix, langid, simhash_index, suffix_dedup
from weft.llm.common import materialise
from weft.llm.queries import VOCABULARY, WEIGHTS
from weft.session import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (no letter, or no language clearly ahead) go."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash_index.keep_one(docs, shingle=4, max_bits=4)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that start in a smaller id are cut out."""
    return suffix_dedup.cut_repeats(docs, length=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated so that sources meet their target weights."""
    return entropy_mix.repeat_copies(docs, WEIGHTS, cap=3)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the digest of the text that they decode to."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("mix_sources", mix_sources),
    ("bpe_tokens", encode_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
