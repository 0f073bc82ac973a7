import json
import os

from pyspark.sql import functions as F

from weft.functions import text as TX
from weft.functions.templates import render_prompt, chat_format
from weft.streaming.incremental import prepare_stream, read_jsonl_stream


def test_row_local_operators_on_a_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(5):
            f.write(json.dumps({"id": i, "text": f"RT @u{i} hello &amp; world #{i}"}) + "\n")
    stream = read_jsonl_stream(spark, src, "id long, text string")

    def transform(df):
        return df.select("id", TX.clean_tweet(F.col("text")).alias("clean"),
                         render_prompt(chat_format("vanilla"), F.col("text")).alias("prompt"))

    out = os.path.join(tmp_dir, "out")
    q = prepare_stream(spark, stream, transform, out, name="t_stream", checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    rows = spark.read.parquet(out).orderBy("id").collect()
    assert len(rows) == 5
    assert rows[0]["clean"] == "hello world 0"
