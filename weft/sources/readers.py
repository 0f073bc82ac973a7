"""File sources.

Every reader is a ``spark.read`` call: files are split across tasks and the
schema is given where known.  The first character of a ``.json`` file tells an
array from JSON Lines: a job over the files looks (:func:`json_arrays`), the
driver itself only where there are few.
Malformed records stop the read (``FAILFAST``) unless a ``mode`` says otherwise;
:func:`read_json_lines` keeps them in a table of their own.
"""

from __future__ import annotations

import fnmatch
import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weft.session import materialize

EXT_TYPES = {"csv": "csv", "json": "json", "jsonl": "json", "txt": "text"}


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> list[str]:
    """Files under ``path`` (or ``[path]`` for a file) via the Hadoop
    FileSystem, so any cluster file system works.  Names (and folders below
    ``path``) that start with ``_`` or ``.`` are skipped, as Spark does; ``glob`` filters by name."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.isFile(p):
        return [path]
    if recursive:   # listed by Spark: the driver's own walk takes milliseconds a file
        listed = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
        found = [_slashes(unquote(f)) for f in listed]   # names come URL-encoded
        return sorted(f for f in found if glob is None or fnmatch.fnmatchcase(os.path.basename(f), glob))
    found, each = [], fs.listFiles(p, False)
    while each.hasNext():
        f = each.next().getPath()
        name = f.getName()
        if not name.startswith(("_", ".")) and (glob is None or fnmatch.fnmatchcase(name, glob)):
            found.append(f.toString())
    return sorted(found)


def _ext(path: str) -> str:
    return os.path.basename(path).rsplit(".", 1)[-1].lower() if "." in os.path.basename(path) else ""


def is_json_array(spark: SparkSession, path: str) -> bool:
    """True when the file's first non-blank character is ``[``.  Reads up to
    that character; a compressed file is JSON Lines."""
    fs, p = _hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        byte = stream.read()
        while byte in (9, 10, 13, 32, 0xEF, 0xBB, 0xBF):  # white space, byte order mark
            byte = stream.read()
        return byte == ord("[")
    finally:
        stream.close()


#: Up to so many files the driver looks itself, which is quicker than a job.
FEW_FILES = 16


def json_arrays(spark: SparkSession, files: list[str], few: int = FEW_FILES) -> list[str]:
    """Which of ``files`` hold a JSON array: their first character, past white space and a byte order mark, is ``[``.

    A job over the files, many small ones to a task and without Python: text up
    to a ``{`` is a record, and a file's first one (in its first split) tells.
    The rest of the files is passed over unparsed.  Only the arrays' names come
    back, as the driver's file list does."""
    if len(files) <= few:
        return [f for f in files if is_json_array(spark, f)]
    records = spark.read.option("lineSep", "{").text(files).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        F.substring("value", 1, 4096).rlike(r"^[\s\ufeff]*\[").alias("array"))
    # the least place, doubled, is odd where that record opens no array
    first = records.groupBy("file").agg(F.min(F.col("at") * 2 + F.when(F.col("array"), 0).otherwise(1)).alias("first"))
    found = first.where("first % 2 = 0").select("file").collect()
    named = {_slashes(unquote(r["file"])) for r in found}   # metadata writes paths as URIs
    return [f for f in files if _slashes(f) in named]


def _slashes(path: str) -> str:
    """One slash after a scheme without authority, as file lists write it."""
    return path.replace(":///", ":/")


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None, mode: str = "FAILFAST",
              corrupt_column: str | None = None, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """JSON Lines and JSON array files.  Each file is told apart by its
    own first character, so a folder may mix both; arrays are read whole
    (``multiLine``), lines are split."""
    files = list_files(spark, path, recursive, glob)
    arrays = json_arrays(spark, [f for f in files if _ext(f) != "jsonl"])
    lines = sorted(set(files) - set(arrays))

    def read(chosen: list[str], whole: bool) -> DataFrame:
        r = spark.read.option("mode", mode).option("multiLine", whole)
        if files != [path]:
            r = r.option("basePath", path)
        if schema is not None:
            r = r.schema(schema)
        if corrupt_column:
            r = r.option("columnNameOfCorruptRecord", corrupt_column)
        return r.json(chosen)

    if not arrays or not lines:
        return read(arrays or lines, bool(arrays))
    return read(arrays, True).unionByName(read(lines, False), allowMissingColumns=True)


def _reason(value: Column, kind: str) -> Column:
    """Why a line is no record, most basic first."""
    return (F.when(~F.is_valid_utf8(value), "not UTF-8").when(F.try_parse_json(value).isNull(), "not JSON")
            .when(~value.rlike(r"^[ \t\r]*\{"), "not an object").otherwise(F.lit(f"does not fit {kind}")))


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, recursive: bool = False,
                    glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S5 with nothing lost: ``(records, rejects)`` of JSON Lines files from one pass over them.

    ``records`` has the schema's columns.  ``rejects`` has every other line that
    is not blank: ``file``, ``line`` (its number in the file, from 1), ``value``
    (its bytes), ``reason``.  Each line is parsed once, in the task that reads
    it, and written with its place; a table of line counts a file and split
    gives the numbers.  A line that fits but for a field's type is rejected
    whole."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    corrupt = "_corrupt"
    while corrupt in fields.names:
        corrupt += "_"
    wide = StructType([*fields.fields, StructField(corrupt, StringType())])
    lines = read_text(spark, path, recursive, glob).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    value = F.when(~F.col("value").rlike(r"^[ \t\r]*$"), F.col("value"))
    parsed = F.from_json(F.when(F.is_valid_utf8(value), value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    d = lines.select("file", "start", "at", value.alias("value"), parsed.alias("row"))
    good = F.col("row").isNotNull() & F.col(f"row.{corrupt}").isNull() & F.col("value").rlike(r"^[ \t\r]*\{")
    bad = F.struct(F.col("value").cast("binary").alias("value"), _reason(F.col("value"), fields.simpleString()).alias("reason"))
    both = materialize(d.select("file", "start", "at", F.when(F.col("value").isNotNull() & ~good, bad).alias("bad"),
                                F.when(F.col("value").isNotNull() & good, F.col("row")).alias("row")), "json_lines")
    records = both.where("row is not null").select(*[F.col(f"row.`{n}`") for n in fields.names])
    splits = both.groupBy("file", "start").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))   # a row a split
    rejects = both.where("bad is not null").join(splits, ["file", "start"]).select(
        "file", (F.col("_off") + F.col("at") - F.col("_first") + 1).alias("line"), "bad.value", "bad.reason")
    return records, rejects


def read_csv(spark: SparkSession, path: str, mode: str = "FAILFAST", multiline: bool = True) -> DataFrame:
    """Header row, every cell a string, quoted cells may hold doubled
    quotes and newlines; empty cells become ''.  A row with too few or too
    many cells, or a file whose header differs from the others', stops the
    read.  ``multiline=False`` lets one file be split over tasks where no
    cell holds a newline."""
    df = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("mode", mode)
          .option("enforceSchema", False).option("inferSchema", False).csv(path))
    return df.na.fill("")


def read_text(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None,
              line_sep: str | None = "\n") -> DataFrame:
    """One row per line (blank lines kept); lines end at ``line_sep`` only."""
    r = spark.read
    if line_sep:
        r = r.option("lineSep", line_sep)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.text(path)


def scan(spark: SparkSession, path: str, schema: StructType | str | None = None, mode: str = "FAILFAST", multiline: bool = True) -> DataFrame:
    """One file or one flat directory; the extension picks the reader
    (csv, json, jsonl, txt); a folder holds one kind.  ``multiline`` goes to :func:`read_csv`."""
    found = {_ext(f) for f in list_files(spark, path)}
    unknown = sorted(found - set(EXT_TYPES))
    if unknown or not found:
        raise ValueError(f"cannot read {path}: {'no files' if not found else f'unknown extensions {unknown}'}; known are {sorted(EXT_TYPES)}")
    kinds = {EXT_TYPES[e] for e in found}
    if len(kinds) > 1:
        raise ValueError(f"{path} mixes the formats {sorted(kinds)}")
    kind = kinds.pop()
    if kind == "csv":
        return read_csv(spark, path, mode, multiline)
    return read_text(spark, path) if kind == "text" else read_json(spark, path, schema, mode)


def scan_recursive(spark: SparkSession, path: str, extension: str, schema: StructType | str | None = None,
                   mode: str = "FAILFAST") -> DataFrame:
    """S3: every file under ``path`` whose name ends exactly in ``.extension``
    (``.jsonl.archived`` is not ``.jsonl``)."""
    glob = f"*.{extension}"
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("mode", mode)
    if extension in ("json", "jsonl"):
        return (r.schema(schema) if schema is not None else r).json(path)
    if extension == "csv":
        return r.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False).csv(path).na.fill("")
    return read_text(spark, path, recursive=True, glob=glob, line_sep=None)


def read_pretrain_lines(spark: SparkSession, path: str, glob: str = "*.txt", drop_invalid_files: bool = False) -> DataFrame:
    """Every line of every file under ``path`` that matches ``glob`` (blank
    lines kept), with its file.  A line that is not UTF-8 is left out; with
    ``drop_invalid_files`` so is the rest of its file (a distributed
    anti-join on the few files that have one).  :func:`invalid_lines` has
    what was left out."""
    df = read_text(spark, path, recursive=True, glob=glob).withColumn("file", F.input_file_name())
    if drop_invalid_files:
        return df.join(invalid_lines(spark, path, glob).select("file").distinct(), "file", "left_anti")
    return df.where(F.is_valid_utf8("value"))


def invalid_lines(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """The lines that :func:`read_pretrain_lines` rejects, as bytes, with their file."""
    df = read_text(spark, path, recursive=True, glob=glob).withColumn("file", F.input_file_name())
    return df.where(~F.is_valid_utf8("value")).select(F.col("value").cast("binary").alias("value"), "file")


def read_named_splits(spark: SparkSession, base: str, names: dict[str, str], fmt: str = "parquet") -> DataFrame | None:
    """Files per split (e.g. {'train': 'train.parquet'}); a missing
    file is tolerated (its split is simply absent); adds ``split``."""
    parts = []
    for split, name in names.items():
        p = os.path.join(base, name)
        fs, hp = _hadoop_fs(spark, p)
        if not fs.exists(hp):
            continue
        df = spark.read.parquet(p) if fmt == "parquet" else read_json(spark, p)
        parts.append(df.withColumn("split", F.lit(split)))
    if not parts:
        return None
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def samples_per_file(spark: SparkSession, path: str, glob: str = "*.json", schema: StructType | str | None = None) -> DataFrame:
    """A2: number of samples per JSON array file under ``path`` plus a total
    row (file = NULL) via ``rollup``; files that do not match ``glob`` are
    skipped.  A ``schema`` saves the pass that infers one."""
    r = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("mode", "FAILFAST")
    df = (r.schema(schema) if schema is not None else r).json(path)
    df = df.withColumn("file", F.col("_metadata.file_path"))
    return df.rollup("file").agg(F.count(F.lit(1)).alias("samples"))
