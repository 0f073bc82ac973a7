from pyspark.sql import functions as F

from weft.operators import history as H
from weft.session import checkpoint_dir, drop_scratch, get_session, materialize, scratch_root


def test_get_session_reuses_active_and_keeps_settings(spark):
    s = get_session()
    assert s is spark or s.sparkContext is spark.sparkContext
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    assert checkpoint_dir(s)
    df = materialize(s.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90


def test_classification_style_with_history(spark):
    df = spark.createDataFrame([("a b", 1, None, [("c", "x"), ("d e f", "y")])],
                               "query string, label int, prompt string, history array<struct<query:string,answer:string>>")
    # user marker (3 tokens) + words + eos (4 tokens): current 9, 'd e f' 10, 'c' 8
    r = H.encode_chat(df, "classification", 19).first()
    assert r["n_history"] == 1 and r["label"] == 1 and len(r["input_ids"]) == 19
    assert H.encode_chat(df, "classification", 8).count() == 0


def test_steps_can_be_dropped(spark):
    import os
    df = materialize(spark.range(3))
    root = scratch_root(spark).removeprefix("file:")
    assert df.count() == 3 and os.listdir(root)
    drop_scratch(spark)
    assert not os.path.exists(root)
    assert materialize(spark.range(4)).count() == 4
