"""Sinks and format conversion (K1-K7).

Writers are ``DataFrameWriter`` calls: each task writes its own part
files, nothing is collected.  Paths should live on shared storage (the
session's checkpoint folder or a table location), never a machine-local
temporary folder.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from typing import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.tokens import IGNORE_INDEX
from weft.operators.align import instruction_to_chat
from weft.session import checkpoint_dir, ensure_checkpoint_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A folder under the session's shared checkpoint directory."""
    ensure_checkpoint_dir(spark)
    return os.path.join(checkpoint_dir(spark), "weft", *parts)


def csv_to_json(df: DataFrame, out: str) -> None:
    """K1: CSV rows (S9) as JSON objects keyed by header (JSON Lines)."""
    df.write.mode("overwrite").json(out)


def json_to_pretrain(df: DataFrame, out: str, n: int | None = None, order: str | None = None,
                     column: str = "data") -> DataFrame:
    """K2: items' ``column`` as pre-training text, each followed by a blank
    line, appended to ``out``; all items, or the first ``n`` by ``order``."""
    if n is not None and not order:
        raise ValueError("n needs an order")
    d = df if n is None else df.orderBy(order).limit(n)
    d = d.select(F.col(column).alias("value"))
    d.write.mode("append").option("lineSep", "\n\n").text(out)
    return d


def instructions_to_chat(df: DataFrame, out: str | None = None) -> DataFrame:
    """K3: instruction rows -> ``{"chat": [{"input", "output"}]}`` JSON Lines."""
    chat = instruction_to_chat(df).select("chat")
    if out:
        chat.write.mode("overwrite").json(out)
    return chat


def write_predictions(df: DataFrame, out: str) -> None:
    """K4: evaluation rows with their ``predict`` map as JSON Lines."""
    df.write.mode("overwrite").json(out)


def decode_ids(ids, vocab, skip_ids: set[int], sep: str = " "):
    """Text of an id array: ``vocab`` is an ARRAY<STRING> column indexed by id
    (unknown ids give nothing); special ids are skipped."""
    shown = F.filter(ids, lambda i: ~i.isin(sorted(skip_ids))) if skip_ids else ids
    return F.array_join(F.transform(shown, lambda i: F.coalesce(F.get(vocab, i), F.lit(""))), sep)


def vocabulary(rows: DataFrame, size: int, id_col: str = "id", token_col: str = "token") -> DataFrame:
    """One row with ``vocab``, the array id -> token; at most ``size`` entries, whatever the rows."""
    one = rows.where(F.col(id_col).between(0, size - 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(token_col).alias("t"))
    table = one.agg(F.map_from_entries(F.collect_list(F.struct("id", "t"))).alias("m"))
    return table.select(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.try_element_at("m", i)).alias("vocab"))


def generated_predictions(df: DataFrame, vocab: DataFrame, skip_ids: set[int], pad_id: int, preds: str = "preds",
                          labels: str = "labels", out: str | None = None) -> DataFrame:
    """K5: ``-100`` -> pad in predictions and labels, then decode (specials
    skipped) to ``{label, predict}``.  ``vocab`` is :func:`vocabulary`'s one
    row, bounded by the vocabulary's size, used as a scalar."""
    fix = lambda c: F.transform(F.col(c), lambda x: F.when(x == IGNORE_INDEX, F.lit(pad_id)).otherwise(x))
    both = df.withColumn("_vocab", vocab.scalar())
    res = both.select(*[decode_ids(fix(c), F.col("_vocab"), skip_ids).alias(n) for c, n in ((labels, "label"), (preds, "predict"))])
    if out:
        res.write.mode("overwrite").json(out)
    return res


def write_shards(sharded: DataFrame, out: str, fmt: str = "parquet", rows_per_file: int = 1_000_000) -> None:
    """X4 sink: one folder per data-parallel worker (``shard=<k>``), in files of
    ``rows_per_file`` rows by position; rows are ordered by (batch, pos) inside
    a file, and a shard is written by as many tasks as it has files."""
    part = F.floor(F.col("pos") / rows_per_file)
    (sharded.withColumn("part", part).repartition("shard", "part").sortWithinPartitions("shard", "batch", "pos").drop("part")
     .write.mode("overwrite").partitionBy("shard").format(fmt).save(out))


def model_reports(metrics: DataFrame, out: str, fmt: str = "parquet") -> None:
    """K6: the long metrics table, one folder per model."""
    w = metrics.write.mode("overwrite").partitionBy("model")
    (w.option("header", True).csv(out) if fmt == "csv" else w.format(fmt).save(out))


def param_key(params: dict) -> str:
    """Canonical sha256 of the parameters that define a prepared dataset."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode("utf-8")).hexdigest()


def source_version(spark: SparkSession, paths: list[str]) -> str:
    """sha256 of the names, sizes and modification times of all files under ``paths``: it changes with any of them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.sha256()
    for path in sorted(paths):
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs, found = p.getFileSystem(conf), []
        each = fs.listFiles(p, True)
        while each.hasNext():
            f = each.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        digest.update("\n".join([path, *sorted(found)]).encode("utf-8"))
    return digest.hexdigest()


MANIFEST = "manifest.json"


class _Folder:
    """Small files of one folder, through Hadoop's file API."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        self.gateway = spark.sparkContext._gateway

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, name) if name else self.path)

    def read(self, name: str) -> str | None:
        p = self._path(name)
        if not self.fs.exists(p):
            return None
        stream = self.fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def rename(self, old: str, new: str, replace: bool) -> bool:
        """One step; without ``replace`` False if ``new`` is there already."""
        rename = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            self.context.rename(self._path(old), self._path(new), options)
            return True
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" not in str(failed.java_exception.getClass().getName()):
                raise
            return False


def materialize(spark: SparkSession, build: Callable[[], DataFrame], params: dict, base: str | None = None,
                reload: bool = False, sources: list[str] | None = None) -> DataFrame:
    """K7: prepared data stored under a key derived from its parameters, and
    from the names, sizes and times of all files under ``sources`` if given;
    reused when a committed copy exists unless ``reload``.

    Rows are written to a folder of their own and committed by renaming a
    manifest that names it, so readers see a whole copy or none.  Of two
    writers of one key the first to commit wins and both return its rows;
    ``reload`` replaces the manifest.  Folders without a manifest's name are
    leftovers of writers that failed or lost."""
    key = dict(params) if sources is None else {"params": params, "sources": source_version(spark, sources)}
    folder = _Folder(spark, os.path.join(base or scratch_path(spark, "prepared"), param_key(key)))
    held = None if reload else folder.read(MANIFEST)
    if held is None:
        name = f"data-{uuid.uuid4().hex}"
        build().write.parquet(os.path.join(folder.path, name))
        folder.write(f"{name}.json", json.dumps({"data": name}))
        folder.rename(f"{name}.json", MANIFEST, replace=reload)
        held = folder.read(MANIFEST)
    return spark.read.parquet(os.path.join(folder.path, json.loads(held)["data"]))
