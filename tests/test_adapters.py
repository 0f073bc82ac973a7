"""Preference adapters on hand-built rows (FIXTURES.md edge cases)."""

import pytest
from pyspark.sql import functions as F

from weft.operators import adapters as AD


def test_scored_tie_goes_to_answer_0_and_citations_stripped(spark):
    df = spark.createDataFrame([("Q", "good [1] one (see x)", "bad", 2.0, 2.0)],
                               "question_text string, answer_0 string, answer_1 string, score_0 double, score_1 double")
    df = df.select(F.struct(F.col("question_text").alias("full_text")).alias("question"), "answer_0", "answer_1", "score_0", "score_1")
    r = AD.scored_pairs(df).first()
    assert r["chosen"] == " good one"
    assert r["rejected"] == " bad"
    assert r["prompt"] == " Human: Q Assistant:"
    assert r["prompt_and_chosen"] == " Human: Q Assistant: good one"


def test_last_assistant_segment_and_missing_marker(spark):
    df = spark.createDataFrame([("P ", "Human: a Assistant: b Assistant: c", "no marker")], "prompt string, chosen string, rejected string")
    r = AD.last_assistant_pairs(df).first()
    assert (r["prompt"], r["chosen"], r["rejected"]) == ("P Assistant:", " c", "no marker")


def test_passages_with_empty_negatives(spark):
    df = spark.createDataFrame([("q", [("p1",), ("p2",)], [])],
                               "query string, positive_passages array<struct<text:string>>, negative_passages array<struct<text:string>>")
    r = AD.passages(df).first()
    assert r["chosen"] == " p1" and r["rejected"] is None and r["prompt_and_rejected"] is None


def test_renamed_roles_and_local_json_nulls(spark):
    df = spark.createDataFrame([("USER: hi ASSISTANT:", "yo"), ("", "x"), ("USER: a", None)], "prompt string, label string")
    rows = AD.renamed_roles(df).collect()
    assert rows[0]["prompt"] == "Human: hi Assistant:" and rows[0]["prompt_and_chosen"] == "Human: hi Assistant: yo"
    assert rows[1]["prompt"] is None and rows[2]["chosen"] is None and rows[2]["prompt_and_chosen"] is None
    lj = spark.createDataFrame([("p", "c", None)], "prompt string, chosen string, rejected string")
    r = AD.local_json_pairs(lj).first()
    assert r["prompt_and_chosen"] == " p c" and r["prompt_and_rejected"] is None
    assert AD.drop_null_sides(AD.local_json_pairs(lj), 2).count() == 0
    assert AD.drop_null_sides(AD.local_json_pairs(lj), 1).count() == 1


def test_labelled_and_dispatch(spark):
    df = spark.createDataFrame([("h", "A", "B", 0)], "history string, human_ref_A string, human_ref_B string, labels int")
    r = AD.labelled_pairs(df).first()
    assert (r["chosen"], r["rejected"]) == (" B", " A")
    assert AD.get_adapter("x/Dahoas/rm-static/y") is AD.identity_pairs
    with pytest.raises(ValueError):
        AD.get_adapter("unknown/set")
