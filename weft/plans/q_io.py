"""Queries for sources, sinks and the registry.

Each query writes data derived from the driver tables to a fresh folder
under the session's shared checkpoint directory and reads it back through
the operator under test, so its work grows with the tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from weft.functions.tokens import DEFAULT_TOKENIZER as TK, IGNORE_INDEX
from weft.operators import split as SP
from weft.operators.evaluate import attach_predictions
from weft.operators.metrics import METRICS
from weft.plans import fixtures as X
from weft.plans import q_metrics as QM
from weft.plans.catalog import lit, register
from weft.sources import readers as RD
from weft.sources import registry as RG
from weft.sources import sinks as SK

NL = chr(10)


def _dir(spark, name):
    return SK.scratch_path(spark, "io", name, uuid.uuid4().hex)


# -- S1 / S2 ------------------------------------------------------------------
@register("S2_scan_by_extension", sql=f"WITH {X.INSTRUCTIONS_SQL} SELECT conv_id, turn, instruction, input, output FROM instructions")
def s2(spark, sf):
    out = _dir(spark, "s2")
    X.instructions(spark, sf).write.json(out)
    schema = "conv_id bigint, turn bigint, instruction string, input string, output string"
    return RD.scan(spark, out, schema).select("conv_id", "turn", "instruction", "input", "output")


@register("S1_registry_load", sql=f"""
WITH {X.INSTRUCTIONS_SQL}
SELECT conv_id, turn, instruction AS prompt, input AS query, output AS response, 'chat: ' AS prefix FROM instructions
UNION ALL
SELECT NULL, NULL, text, NULL, NULL, 'doc: ' FROM documents
""")
def s1(spark, sf):
    base = _dir(spark, "s1")
    X.instructions(spark, sf).write.json(os.path.join(base, "chat_data"))
    X.documents(spark, sf).select("doc_id", "text").write.json(os.path.join(base, "docs"))
    registry = {
        "chat": {"file_name": "chat_data"},
        "docs": {"file_name": "docs", "columns": {"prompt": "text", "query": None, "response": None}},
    }
    chat = RG.load_datasets(spark, "chat", registry, base, "chat: ")
    docs = RG.load_datasets(spark, "docs", registry, base, "doc: ")
    return (chat.select("conv_id", "turn", "prompt", "query", "response", "prefix")
            .unionByName(docs.select(F.lit(None).cast("bigint").alias("conv_id"), F.lit(None).cast("bigint").alias("turn"),
                                     "prompt", "query", "response", "prefix")))


# -- S3 / S5 ------------------------------------------------------------------
PAIRS_SCHEMA = "conv_id bigint, turn bigint, query string, response string, prompt string"


@register("S3_recursive_scan", sql=f"WITH {X.PAIRS_SQL} SELECT conv_id, turn, query, response, prompt FROM pairs")
def s3(spark, sf):
    out = _dir(spark, "s3")
    X.pairs(spark, sf).withColumn("bucket", F.col("conv_id") % 7).write.partitionBy("bucket").json(out)
    return RD.scan_recursive(spark, out, "json", PAIRS_SCHEMA)


@register("S5_jsonl_parse", sql=f"WITH {X.PAIRS_SQL} SELECT conv_id, turn, query, response, prompt FROM pairs")
def s5(spark, sf):
    out = _dir(spark, "s5")
    X.pairs(spark, sf).write.json(out)
    return RD.read_json(spark, out, PAIRS_SCHEMA, mode="FAILFAST")


@register("S5_reject_table", sql=f"""
WITH {X.PAIRS_SQL}
SELECT conv_id, turn, CASE WHEN conv_id % 5 > 2 THEN query END AS query,
       CASE conv_id % 5 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'does not fit struct<conv_id:bigint,turn:bigint,query:string>' WHEN 2 THEN 'not an object' END AS reason
FROM pairs
""")
def s5_rejects(spark, sf):
    """Lines cut short, with a text for a number, and with an array are told from records in one pass."""
    out = _dir(spark, "s5r")
    p = X.pairs(spark, sf).select("conv_id", "turn", "query")
    line, kind = F.to_json(F.struct("conv_id", "turn", "query")), F.col("conv_id") % 5
    text = (F.when(kind == 0, F.left(line, F.length(line) - 1)).when(kind == 1, F.to_json(F.struct("conv_id", F.concat(F.lit("no "), "turn").alias("turn"))))
            .when(kind == 2, F.concat(F.lit("["), "conv_id", F.lit(", "), "turn", F.lit("]"))).otherwise(line))
    p.select(text.alias("value")).write.text(out)
    records, rejects = RD.read_json_lines(spark, out, "conv_id bigint, turn bigint, query string")
    told = F.regexp_extract_all(F.decode("value", "UTF-8"), F.lit(r"\d+"), 0)
    return (records.withColumn("reason", F.lit(None).cast("string"))
            .unionByName(rejects.select(F.get(told, F.lit(0)).cast("bigint").alias("conv_id"), F.get(told, F.lit(1)).cast("bigint").alias("turn"),
                                        F.lit(None).cast("string").alias("query"), "reason")))


# -- S4 -----------------------------------------------------------------------
@register("S4_pretrain_lines", sql=f"SELECT unnest(string_split(text, {lit(NL)})) AS value FROM documents")
def s4(spark, sf):
    out = _dir(spark, "s4")
    d = X.documents(spark, sf).select("text", (F.col("doc_id") % 5).alias("bucket"))
    d.write.partitionBy("bucket").option("lineSep", "\n").text(out)
    return RD.read_pretrain_lines(spark, out, glob="part-*").select("value")


# -- S6 / A2 ------------------------------------------------------------------
def _json_arrays(spark, sf):
    """One JSON array file per 100 documents (a group bounded by construction)."""
    out = _dir(spark, "s6")
    d = X.documents(spark, sf).select("doc_id", "source", F.col("text").alias("data"),
                                      F.floor(F.col("doc_id") / 100).alias("bucket"))
    g = d.groupBy("bucket").agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("doc_id", "source", "data"))), ","),
                                         F.lit("]")).alias("value"))
    g.write.partitionBy("bucket").text(out)
    return out


ARRAY_SCHEMA = "doc_id bigint, source string, data string"


@register("S6_json_array", sql="SELECT doc_id, source, text AS data FROM documents")
def s6(spark, sf):
    return RD.read_json(spark, _json_arrays(spark, sf), ARRAY_SCHEMA, recursive=True).select("doc_id", "source", "data")


@register("S6_mixed_json_folder", sql="SELECT doc_id, source, text AS data FROM documents")
def s6_mixed(spark, sf):
    """One folder with array files (odd buckets) and line files (even ones)."""
    out = _dir(spark, "s6m")
    d = X.documents(spark, sf).select("doc_id", "source", F.col("text").alias("data"), F.floor(F.col("doc_id") / 100).alias("bucket"))
    item = F.to_json(F.struct("doc_id", "source", "data"))
    arrays = d.where(F.col("bucket") % 2 == 1).groupBy("bucket").agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("value"))
    arrays.repartition("bucket").write.partitionBy("bucket").mode("append").text(out)
    d.where(F.col("bucket") % 2 == 0).select(item.alias("value"), "bucket").write.partitionBy("bucket").mode("append").text(out)
    return RD.read_json(spark, out, ARRAY_SCHEMA, recursive=True).select("doc_id", "source", "data")


@register("A2_samples_per_file", sql="""
SELECT CAST(doc_id // 100 AS BIGINT) AS bucket, count(*) AS samples FROM documents GROUP BY ROLLUP (doc_id // 100)
""")
def a2(spark, sf):
    per = RD.samples_per_file(spark, _json_arrays(spark, sf), glob="part-*", schema=ARRAY_SCHEMA)
    return per.select(F.regexp_extract("file", "bucket=([0-9]+)", 1).try_cast("bigint").alias("bucket"), "samples")


# -- S7 / S8 ------------------------------------------------------------------
@register("S7_parquet_named_splits", sql=f"""
WITH dr AS (SELECT doc_id, text, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) - 1 AS rank FROM documents),
nn AS (SELECT count(*) AS n FROM documents),
b AS (SELECT 0 AS b0, least(greatest((CAST(round_even(0.9 * n, 0) AS BIGINT)) - ((CAST(round_even(0.9 * n, 0) AS BIGINT) + CAST(round_even(0.1 * n, 0) AS BIGINT)) - n), 0), n) AS b1 FROM nn)
SELECT doc_id, text, CASE WHEN rank < b1 THEN 'train' ELSE 'test' END AS split FROM dr, b
""")
def s7(spark, sf):
    base = _dir(spark, "s7")
    c = SP.carve_eval(X.documents(spark, sf).select("doc_id", "text"), ["doc_id"], 42)
    c.where(F.col("split") == "train").select("doc_id", "text").write.parquet(os.path.join(base, "train.parquet"))
    c.where(F.col("split") == "eval").select("doc_id", "text").write.parquet(os.path.join(base, "test.parquet"))
    return RD.read_named_splits(spark, base, {"train": "train.parquet", "test": "test.parquet", "dev": "dev.parquet"})


@register("S8_json_named_splits", sql="SELECT doc_id, text, 'train' AS split FROM documents")
def s8(spark, sf):
    base = _dir(spark, "s8")
    X.documents(spark, sf).select("doc_id", "text").write.json(os.path.join(base, "train.json"))   # no eval file: tolerated
    return RD.read_named_splits(spark, base, {"train": "train.json", "eval": "eval.json"}, fmt="json")


# -- S9 / K1 ------------------------------------------------------------------
def _csv(spark, sf):
    out = _dir(spark, "s9")
    p = X.pairs(spark, sf).select("conv_id", "turn", "query",
                                  F.when(F.col("conv_id") % 9 == 0, F.lit(None)).otherwise(F.col("response")).alias("response"))
    p.write.option("header", True).option("escape", '"').option("lineSep", "\n").csv(out)
    return out


CSV_SQL = f"""{X.PAIRS_SQL},
c AS (SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, query,
             CASE WHEN conv_id % 9 = 0 THEN '' ELSE response END AS response FROM pairs)"""


@register("S9_csv_all_strings", sql=f"WITH {CSV_SQL} SELECT * FROM c")
def s9(spark, sf):
    return RD.read_csv(spark, _csv(spark, sf))


@register("K1_csv_to_json", sql=f"WITH {CSV_SQL} SELECT * FROM c")
def k1(spark, sf):
    df = RD.read_csv(spark, _csv(spark, sf))
    out = _dir(spark, "k1")
    SK.csv_to_json(df, out)
    return spark.read.schema("conv_id string, turn string, query string, response string").json(out)


# -- K2 -----------------------------------------------------------------------
@register("K2_json_to_pretrain", sql=f"""
WITH l AS (SELECT unnest(string_split(text, {lit(NL)}) || ['']) AS value FROM documents)
SELECT value, count(*) AS n FROM l GROUP BY value
""")
def k2(spark, sf):
    """Every item's text and the blank line after it, read back line by line."""
    items = RD.read_json(spark, _json_arrays(spark, sf), ARRAY_SCHEMA, recursive=True)
    out = _dir(spark, "k2")
    SK.json_to_pretrain(items, out)
    return RD.read_text(spark, out).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# -- K3 / K4 ------------------------------------------------------------------
@register("K3_instruction_to_chat", sql=f"""
WITH {X.INSTRUCTIONS_SQL}
SELECT CASE WHEN length(input) > 0 THEN instruction || {lit(NL)} || input ELSE instruction END AS input, output FROM instructions
""")
def k3(spark, sf):
    out = _dir(spark, "k3")
    SK.instructions_to_chat(X.instructions(spark, sf), out)
    back = spark.read.schema("chat array<struct<input:string,output:string>>").json(out)
    return back.select(F.col("chat")[0]["input"].alias("input"), F.col("chat")[0]["output"].alias("output"))


@register("K4_predictions_sink", sql=f"""
WITH {X.PREDICTIONS_SQL}
SELECT p.conv_id, p.turn, list(pr.model ORDER BY pr.model) AS models, list(pr.text ORDER BY pr.model) AS texts
FROM pairs p JOIN predictions pr USING (conv_id, turn) GROUP BY p.conv_id, p.turn
""")
def k4(spark, sf):
    rows = X.pairs(spark, sf).select("conv_id", "turn", F.array(F.struct(F.col("query").alias("input"),
                                                                        F.col("response").alias("output"))).alias("chat"))
    rows = attach_predictions(rows, X.predictions(spark, sf), ["conv_id", "turn"])
    out = _dir(spark, "k4")
    SK.write_predictions(rows.where(F.col("predict").isNotNull()), out)
    back = spark.read.schema("conv_id bigint, turn bigint, chat array<struct<input:string,output:string>>, "
                             "predict map<string,string>").json(out)
    e = F.array_sort(F.map_entries("predict"))
    return back.select("conv_id", "turn", F.transform(e, lambda x: x["key"]).alias("models"),
                       F.transform(e, lambda x: x["value"]).alias("texts"))


# -- K5 -----------------------------------------------------------------------
K5_SQL = f"""
WITH {X.PREDICTIONS_SQL},
toks AS (SELECT unnest({TK.sql_tokens('query')}) AS t FROM pairs UNION ALL
         SELECT unnest({TK.sql_tokens('response')}) FROM pairs),
vocab AS (SELECT CAST({TK.reserved} + (('0x' || substr(md5(t), 1, 7))::BIGINT % {TK.vocab_size - TK.reserved}) AS INTEGER) AS id,
                 min(t) AS tok FROM toks GROUP BY 1),
vm AS (SELECT map_from_entries(list({{'key': id, 'value': tok}})) AS m FROM vocab),
e AS (SELECT {TK.sql_ids('pa.response')} AS l0, {TK.sql_ids('pr.text')} AS p0
      FROM predictions pr JOIN pairs pa USING (conv_id, turn)),
pad AS (SELECT list_concat(l0, list_transform(range(8), lambda x: {IGNORE_INDEX})) AS l,
               list_concat(p0, list_transform(range(8), lambda x: {TK.pad_id})) AS p FROM e)
SELECT array_to_string(list_transform(list_filter(l, lambda i: i NOT IN ({IGNORE_INDEX}, {TK.pad_id}, {TK.bos_id}, {TK.eos_id})),
                                      lambda i: coalesce(vm.m[i], '')), ' ') AS label,
       array_to_string(list_transform(list_filter(p, lambda i: i NOT IN ({TK.pad_id}, {TK.bos_id}, {TK.eos_id})),
                                      lambda i: coalesce(vm.m[i], '')), ' ') AS predict
FROM pad, vm
"""


@register("K5_generated_predictions", sql=K5_SQL)
def k5(spark, sf):
    p = X.pairs(spark, sf)
    toks = p.select(F.explode(TK.tokens(F.col("query"))).alias("t")).unionByName(
        p.select(F.explode(TK.tokens(F.col("response"))).alias("t")))
    vocab_df = toks.groupBy(TK.token_id(F.col("t")).alias("id")).agg(F.min("t").alias("tok"))
    vocab = SK.vocabulary(vocab_df, TK.vocab_size, "id", "tok")
    pr = X.predictions(spark, sf).join(p, ["conv_id", "turn"])
    ids = pr.select(F.concat(TK.ids(F.col("response")), F.array_repeat(F.lit(IGNORE_INDEX), 8)).alias("labels"),
                    F.concat(TK.ids(F.col("text")), F.array_repeat(F.lit(TK.pad_id), 8)).alias("preds"))
    out = _dir(spark, "k5")
    SK.generated_predictions(ids, vocab, {TK.pad_id, TK.bos_id, TK.eos_id}, TK.pad_id, out=out)
    return spark.read.schema("label string, predict string").json(out)


# -- K6 / K7 ------------------------------------------------------------------
@register("K6_model_reports", sql=QM.EVALUATION_SQL)
def k6(spark, sf):
    """Expectation, prediction and all ten metrics, a folder a model."""
    out = _dir(spark, "k6")
    SK.model_reports(QM.evaluation(spark, sf), out)
    back = spark.read.parquet(out)
    return back.select("conv_id", "turn", "model", "expect", "predict", *METRICS)


@register("K7_materialize_by_params", sql=f"SELECT doc_id, CAST(len({TK.sql_tokens('text')}) AS INTEGER) AS n_tokens FROM documents")
def k7(spark, sf):
    params = {"op": "tokenize", "sf": os.path.basename(sf.rstrip("/")), "vocab": TK.vocab_size, "run": uuid.uuid4().hex}
    build = lambda: X.documents(spark, sf).select("doc_id", TK.ids(F.col("text")).alias("input_ids"))
    first = SK.materialize(spark, build, params)
    again = SK.materialize(spark, build, params)  # reused: _SUCCESS exists
    assert first.inputFiles() == again.inputFiles()
    return again.select("doc_id", F.size("input_ids").alias("n_tokens"))


@register("K7_materialize_by_sources", sql=f"SELECT doc_id, CAST(len({TK.sql_tokens('text')}) AS INTEGER) AS n_tokens FROM documents")
def k7_sources(spark, sf):
    """Prepared from half of the documents; when the others come, the key changes and all are prepared."""
    src, base = _dir(spark, "k7s"), _dir(spark, "k7p")
    docs = X.documents(spark, sf).select("doc_id", "text")
    half = F.col("doc_id") % 2 == 0

    def prepared():
        build = lambda: spark.read.parquet(src).select("doc_id", F.size(TK.tokens(F.col("text"))).alias("n_tokens"))
        return SK.materialize(spark, build, {"op": "count"}, base, sources=[src])

    docs.where(half).write.parquet(src)
    prepared()
    docs.where(~half).write.mode("append").parquet(src)
    return prepared()
