import json
import os

import pytest
from pyspark.sql import functions as F

from weft.sources import readers as RD
from weft.sources import registry as RG
from weft.sources import sinks as SK


def _w(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def test_recursive_scan_exact_extension(spark, tmp_dir):
    _w(f"{tmp_dir}/a/x.jsonl", '{"input": "1", "label": 1}\n')
    _w(f"{tmp_dir}/a/b/y.jsonl", '{"input": "2", "label": 0}\n')
    _w(f"{tmp_dir}/a/b/z.jsonl.archived", '{"input": "3", "label": 0}\n')
    df = RD.scan_recursive(spark, f"{tmp_dir}/a", "jsonl", "input string, label int")
    assert sorted(r["input"] for r in df.collect()) == ["1", "2"]


def test_pretrain_lines_keep_blanks_and_drop_bad_lines(spark, tmp_dir):
    _w(f"{tmp_dir}/t/good.txt", "line one\n\nline three\n")
    os.makedirs(f"{tmp_dir}/t/sub", exist_ok=True)
    with open(f"{tmp_dir}/t/sub/bad.txt", "wb") as f:
        f.write(b"ok line\n\xff\xfe broken\n")
    _w(f"{tmp_dir}/t/skip.md", "not text\n")
    got = sorted(r["value"] for r in RD.read_pretrain_lines(spark, f"{tmp_dir}/t").collect())
    assert got == ["", "line one", "line three", "ok line"]
    strict = RD.read_pretrain_lines(spark, f"{tmp_dir}/t", drop_invalid_files=True)
    assert sorted(r["value"] for r in strict.collect()) == ["", "line one", "line three"]
    assert [bytes(r["value"]) for r in RD.invalid_lines(spark, f"{tmp_dir}/t").collect()] == [b"\xff\xfe broken"]


def test_a_folder_may_mix_json_arrays_and_lines(spark, tmp_dir):
    _w(f"{tmp_dir}/mix/a.json", json.dumps([{"data": "x"}, {"data": "y"}]))
    _w(f"{tmp_dir}/mix/b.json", '{"data": "z"}\n{"data": "v"}\n{"data": "w"}\n')
    _w(f"{tmp_dir}/mix/c.json", "\n  [" + json.dumps({"data": "u", "more": 1}) + "]")
    assert sorted(r["data"] for r in RD.scan(spark, f"{tmp_dir}/mix").collect()) == ["u", "v", "w", "x", "y", "z"]


def test_broken_records_stop_the_read(spark, tmp_dir):
    _w(f"{tmp_dir}/bad/a.jsonl", '{"a": "1"}\n{"a": bro\n')
    with pytest.raises(Exception):
        RD.scan_recursive(spark, f"{tmp_dir}/bad", "jsonl", "a string").collect()
    assert RD.scan_recursive(spark, f"{tmp_dir}/bad", "jsonl", "a string", mode="DROPMALFORMED").count() >= 1
    _w(f"{tmp_dir}/short/a.csv", "a,b\n1,2\n5\n")
    with pytest.raises(Exception):
        RD.read_csv(spark, f"{tmp_dir}/short").collect()
    _w(f"{tmp_dir}/heads/a.csv", "a,b\n1,2\n")
    _w(f"{tmp_dir}/heads/b.csv", "b,a\n3,4\n")
    with pytest.raises(Exception):
        RD.read_csv(spark, f"{tmp_dir}/heads").collect()


def test_limits_need_an_order(spark, tmp_dir):
    _w(f"{tmp_dir}/l/one.jsonl", '{"instruction": "i", "input": "", "output": "o"}\n')
    with pytest.raises(ValueError):
        RG.load_datasets(spark, "one", {"one": {"file_name": "one.jsonl"}}, f"{tmp_dir}/l", max_samples=1)
    items = spark.createDataFrame([(i, f"t{i}") for i in range(150)], "k long, data string")
    with pytest.raises(ValueError):
        SK.json_to_pretrain(items, f"{tmp_dir}/k2", n=3)
    SK.json_to_pretrain(items, f"{tmp_dir}/k2")
    assert RD.read_text(spark, f"{tmp_dir}/k2").where("value <> ''").count() == 150


def test_decoding_skips_specials_and_unknown_ids(spark):
    vocab = SK.vocabulary(spark.createDataFrame([(3, "c"), (3, "b"), (5, "e"), (99, "z")], "id int, token string"), 8)
    rows = spark.createDataFrame([([3, 1, 5, -100], [5, 4, 3])], "labels array<int>, preds array<int>")
    assert [tuple(r) for r in SK.generated_predictions(rows, vocab, {0, 1}, 0).collect()] == [("b e", "e  b")]


def test_json_array_vs_lines(spark, tmp_dir):
    _w(f"{tmp_dir}/arr/d.json", json.dumps([{"data": "x"}, {"data": "y"}], indent=2))
    _w(f"{tmp_dir}/lines/d.json", '{"data": "x"}\n{"data": "y"}\n')
    for sub in ("arr", "lines"):
        assert sorted(r["data"] for r in RD.scan(spark, f"{tmp_dir}/{sub}").collect()) == ["x", "y"]
    counts = {r["file"]: r["samples"] for r in RD.samples_per_file(spark, f"{tmp_dir}/arr").collect()}
    assert counts[None] == 2 and len(counts) == 2


def test_csv_all_strings(spark, tmp_dir):
    _w(f"{tmp_dir}/c/x.csv", 'a,b,c\n"say ""hi""","two\nlines",\n1,,3\n')
    rows = [tuple(r) for r in RD.scan(spark, f"{tmp_dir}/c").collect()]
    assert rows == [('say "hi"', "two\nlines", ""), ("1", "", "3")]


def test_scan_rejects_mixed_extensions(spark, tmp_dir):
    _w(f"{tmp_dir}/m/a.csv", "a\n1\n")
    _w(f"{tmp_dir}/m/b.json", '{"a": 1}\n')
    with pytest.raises(ValueError):
        RD.scan(spark, f"{tmp_dir}/m")


def test_registry_sources():
    reg = {"a": {"file_name": "a.json"}, "b": {"hf_hub_url": "org/b", "file_name": "x"},
           "c": {"script_url": "c", "columns": {"prompt": "q", "response": "r"}}, "d": {"columns": {}}}
    found = RG.sources("a, b,c", reg, "p")
    assert [(s.kind, s.place, s.prefix) for s in found] == [("file", "a.json", "p"), ("hub", "org/b", "p"), ("script", "c", "p")]
    assert found[2].columns == {"prompt": "q", "query": None, "response": "r", "history": None}
    assert found[0].columns["prompt"] == "instruction" and found[0].columns["history"] is None
    for names, prefixes in (("a,b", "p|q|r"), ("zzz", None), ("d", None)):
        with pytest.raises(ValueError):
            RG.sources(names, reg, prefixes)


def test_load_datasets_aligns_and_limits(spark, tmp_dir):
    _w(f"{tmp_dir}/r/one.jsonl", "".join(json.dumps({"instruction": f"i{k}", "input": "", "output": f"o{k}"}) + "\n"
                                         for k in range(5)))
    reg = {"one": {"file_name": "one.jsonl"}}
    df = RG.load_datasets(spark, "one", reg, f"{tmp_dir}/r", "pre", max_samples=3, order=["instruction"])
    rows = df.orderBy("prompt").collect()
    assert [r["prompt"] for r in rows] == ["i0", "i1", "i2"] and rows[0]["prefix"] == "pre"
    assert df.schema["history"].dataType.simpleString() == "array<struct<query:string,answer:string>>"


def test_materialize_reuses(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    key = {"x": 1, "nonce": os.urandom(4).hex()}
    a = SK.materialize(spark, build, key)
    b = SK.materialize(spark, build, key)
    assert a.count() == b.count() == 5 and len(calls) == 1
    SK.materialize(spark, build, key, reload=True)
    assert len(calls) == 2


def test_jsonl_permissive_keeps_corrupt_lines(spark, tmp_dir):
    _w(f"{tmp_dir}/j/a.jsonl", '{"input": "ok", "label": 1}\n{"input": broken\n')
    df = RD.read_json(spark, f"{tmp_dir}/j/a.jsonl", "input string, label int, _corrupt_record string",
                      mode="PERMISSIVE", corrupt_column="_corrupt_record")
    rows = sorted(df.collect(), key=lambda r: r["_corrupt_record"] or "")
    assert rows[0]["input"] == "ok" and rows[1]["_corrupt_record"] == '{"input": broken'
    with pytest.raises(Exception):
        RD.read_json(spark, f"{tmp_dir}/j/a.jsonl", "input string, label int", mode="FAILFAST").collect()


def test_format_probe_as_a_job(spark, tmp_dir):
    """The job and the driver's own look agree, for odd names, blanks, byte order marks, empty and many-split files."""
    files = {"a b.json": "[1]", "c%20d.json": '\n \t[{"x": 1}]', "e.json": '{"x": [1]}\n{"x": 2}', "f.json": "", "g.json": "\ufeff[{}]", "ü+.json": '  {"x": 1}',
             "deep/h.json": "[" + ",".join(json.dumps({"x": i}) for i in range(40_000)) + "]", "i.json": '{"x": 1}\n[{"x": 2}]'}
    for name, text in files.items():
        _w(f"{tmp_dir}/p/{name}", text)
    found = RD.list_files(spark, f"{tmp_dir}/p", recursive=True)
    assert len(found) == len(files)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        arrays = RD.json_arrays(spark, found, few=0)
        assert spark.conf.get("spark.sql.files.openCostInBytes") != "64k"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert arrays == RD.json_arrays(spark, found, few=100)
    assert sorted(os.path.basename(f) for f in arrays) == ["a b.json", "c%20d.json", "g.json", "h.json"]


def test_rejects_keep_file_place_and_reason(spark, tmp_dir):
    """Every line is a record, a blank or a reject; places are right in files of several splits."""
    lines = []
    for i in range(3000):
        lines.append({0: b'{"a": %d, "b": "x"' % i, 1: b"", 2: b'{"a": "no", "b": "x"}', 3: b'[{"a": 1}]', 4: b"\xff{}", 5: b"  \t\r"}.get(i % 50, b'{"a": %d, "b": "r\xc3\xa9"}' % i))
    reason = {0: "not JSON", 2: "does not fit struct<a:bigint,b:string>", 3: "not an object", 4: "not UTF-8"}
    os.makedirs(f"{tmp_dir}/rej/sub")
    for name in ("one.jsonl", "sub/two.jsonl"):
        with open(f"{tmp_dir}/rej/{name}", "wb") as f:
            f.write(b"\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        records, rejects = RD.read_json_lines(spark, f"{tmp_dir}/rej", "a bigint, b string", recursive=True)
        good, bad = records.collect(), rejects.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["a"] for r in good) == sorted([i for i in range(3000) if i % 50 > 5] * 2) and {r["b"] for r in good} == {"ré"}
    want = sorted((name, i + 1, lines[i], reason[i % 50]) for name in ("one.jsonl", "two.jsonl") for i in range(3000) if i % 50 in reason)
    assert sorted((os.path.basename(r["file"]), r["line"], bytes(r["value"]), r["reason"]) for r in bad) == want
    _w(f"{tmp_dir}/none/x.jsonl", "\n\n")
    assert [d.count() for d in RD.read_json_lines(spark, f"{tmp_dir}/none", "a bigint, _corrupt string")] == [0, 0]


def test_materialize_follows_its_sources(spark, tmp_dir):
    _w(f"{tmp_dir}/src/a.txt", "one\n")
    calls = []

    def build():
        calls.append(1)
        return spark.read.text(f"{tmp_dir}/src")

    def rows():
        return sorted(r["value"] for r in SK.materialize(spark, build, {"k": 1}, f"{tmp_dir}/out", sources=[f"{tmp_dir}/src"]).collect())

    assert rows() == rows() == ["one"] and len(calls) == 1
    _w(f"{tmp_dir}/src/b.txt", "two\n")
    assert rows() == rows() == ["one", "two"] and len(calls) == 2
    os.utime(f"{tmp_dir}/src/b.txt", (1, 1))
    assert rows() == ["one", "two"] and len(calls) == 3


def test_two_writers_of_one_key(spark, tmp_dir):
    """The second writer commits while the first one writes: both return the rows committed first; a failed writer leaves no copy."""
    key = {"k": 2}

    def slow():
        SK.materialize(spark, lambda: spark.range(3), key, f"{tmp_dir}/out")
        return spark.range(7)

    assert SK.materialize(spark, slow, key, f"{tmp_dir}/out").count() == 3
    assert SK.materialize(spark, lambda: spark.range(9), key, f"{tmp_dir}/out", reload=True).count() == 9
    assert SK.materialize(spark, lambda: spark.range(1), key, f"{tmp_dir}/out").count() == 9
    with pytest.raises(Exception):
        SK.materialize(spark, lambda: spark.range(4).select(F.raise_error(F.lit("stop"))), {"k": 3}, f"{tmp_dir}/out")
    assert SK.materialize(spark, lambda: spark.range(5), {"k": 3}, f"{tmp_dir}/out").count() == 5


def test_format_probe_packs_small_files(spark, tmp_dir):
    """Many small files share a task, where each had one (and a Python worker) of its own."""
    for i in range(30):
        _w(f"{tmp_dir}/many/k={i % 3}/{i}.json", "[1]" if i % 2 else '{"x": 1}')
    found = RD.list_files(spark, f"{tmp_dir}/many", recursive=True)
    assert len(found) == 30
    spark.sparkContext.setJobGroup("probe", "probe")
    try:
        assert len(RD.json_arrays(spark, found, few=0)) == 15
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup("probe") for s in status.getJobInfo(j).stageIds]
    assert stages and max(info.numTasks for s in stages if (info := status.getStageInfo(s))) < 30
