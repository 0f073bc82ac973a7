"""Translations of turns (J5): hot texts, missing ones, the turn carried once."""

from pyspark.sql import functions as F

from weft.operators import evaluate as EV


def test_hot_texts_are_joined_apart(spark):
    """One text in half of all rows, others rare, nulls and texts without a translation; any share gives the same rows, broadcasts off."""
    rows = spark.range(0, 4000).select("id", F.when(F.col("id") % 2 == 0, "hot text").when(F.col("id") % 97 == 1, F.lit(None))
                                       .otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("v"))
    table = spark.range(0, 30).select(F.concat(F.lit("t"), "id").alias("v"), F.col("id").alias("x")).unionByName(
        spark.createDataFrame([("hot text", 1000), (None, 7)], "v string, x long"))
    want = sorted(map(str, rows.join(table, "v", "left").select("id", "v", "x").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for share in (1, 4, 300, 1024):
            assert sorted(map(str, EV._join_by_text(rows, table, "v", ["id"], share).collect())) == want
        spread = EV._join_by_text(rows, table, "v", ["id"], 64).where("v = 'hot text'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in spread) == 2000 and max(r["count"] for r in spread) < 1000
    assert EV._join_by_text(rows.limit(0), table, "v", ["id"]).count() == 0


def test_translations_of_turns(spark):
    turns = spark.createDataFrame([(1, {"a": "one two", "b": "two three"}), (2, {"a": "one two", "b": "not there"}), (3, {"a": "one", "b": "two three"}), (4, {})],
                                  "k long, turn map<string,string>")
    table = spark.createDataFrame([("one two", " 1 2 "), ("two three", "2 3"), ("two three", "9 9")], "source string, target string")
    got = sorted((r["k"], r["output"], r["seq"], tuple(sorted(r["entry"].items()))) for r in EV.apply_translations(turns, table, ["k"]).collect())
    assert got == [(1, "chats", 0, (("a", "1 2"), ("b", "2 3"))), (2, "missing", 0, (("a", "one two"), ("b", "not there"))), (2, "missing", 1, (("a", "1 2"),))]
