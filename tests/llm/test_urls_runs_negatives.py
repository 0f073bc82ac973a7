"""URL rules, periodic runs and hard negatives against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES
from weft.llm import hard_negatives, periodic_runs, queries, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# ---- op11 -------------------------------------------------------------------------------------------

def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):]).group()


def decide(url, rules, default="allow"):
    host, path = parse(url)
    fits = []
    for rule, verdict in rules.items():
        h, p = rule[: rule.index("/")], rule[rule.index("/"):]
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), len(h), verdict, rule))
    return (host, path, *((max(fits)[3], max(fits)[2]) if fits else (None, default)))


def as_rules(pairs):
    rules = {}
    for verdict, rule in pairs:
        rules[rule] = max(verdict, rules.get(rule, ""))
    return rules


@pytest.fixture(scope="module")
def urls(spark):
    long_host = ".".join(["a"] * 50_000) + ".example.net"
    odd = [None, "", "no scheme", "://", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://a..net/x", "http://xnet/", "http://example.net:80/en/",
           "http://u@example.net/en/", "a://b://example.com/de/", "http://example.com?x=/de/", "http://example.com/de", "http://example.com/de/#f",
           "http://É.Org/fr/é", "http://x.org/fr\n/", f"http://{long_host}/en/1", "http://example.org/fr/" + "x" * 200_000, "http://a.example.net/En/"]
    rows = [(i, u) for i, u in enumerate([*odd, *odd])]
    return spark.createDataFrame(rows, "page_id long, url string").select("*", *[F.lit(i).alias(c) for i, c in enumerate([*CLASHES, "path", "verdict", "rule", "found"])])


def test_url_rules_on_odd_urls(spark, urls):
    rules = url_filter.rule_table(spark, queries.RULES)
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(urls, rules).collect()}
    want = {r["page_id"]: decide(r["url"], as_rules(queries.RULES)) for r in urls.select("page_id", "url").collect()}
    assert got == want
    kept = url_filter.keep_allowed(urls, rules)
    assert kept.columns == urls.columns
    assert {r["page_id"] for r in kept.select("page_id").collect()} == {i for i, w in want.items() if w[3] == "allow"}


@pytest.mark.parametrize("max_keys", [10**6, 150])
def test_url_rules_many(spark, max_keys):
    """Long lists, in one part and in several, with rules in both lists, against every rule tried."""
    rnd = random.Random(3)
    hosts = [".".join(rnd.choices(["a", "bb", "c3", "net", "org"], k=rnd.randint(1, 4))) for _ in range(120)]
    paths = ["/", "/en/", "/en", "/d", "", "/en/x/y", "/1", "/22"]
    pairs = [(rnd.choice(["block", "allow"]), rnd.choice(hosts) + "/" + rnd.choice(paths)[1:]) for _ in range(600)]
    table = url_filter.rule_table(spark, pairs).unionAll(spark.sql("select * from values ('block', null, '/'), ('block', '', '/'), ('other', 'net', '/'), ('allow', 'net', null)"))
    urls = spark.createDataFrame([(i, f"http://{rnd.choice(hosts)}.{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'z', '?q'])}") for i in range(800)], "page_id long, url string")
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(urls, table, max_keys=max_keys).collect()}
    rules = as_rules(pairs)
    assert got == {r["page_id"]: decide(r["url"], rules) for r in urls.collect()}


def test_cascade_is_exact_with_poor_filters(spark):
    """A first level that lets half of the keys pass: the later levels set every key right."""
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where(F.xxhash64("key") % 10 == 0)
    levels, data = url_filter.build(universe, listed, listed.count(), n_universe=1)
    assert len(levels) >= 3
    answer = url_filter.with_answer(universe, "key", data, "said", lambda k, f: url_filter.listed(levels, k, f))
    assert answer.where(F.col("said") != (F.xxhash64("key") % 10 == 0)).count() == 0


def test_url_rules_empty(spark, urls):
    none = url_filter.rule_table(spark, queries.RULES).where("false")
    assert {(r["rule"], r["verdict"]) for r in url_filter.judge(urls, none, default="block").collect()} == {(None, "block")}
    assert url_filter.judge(urls.where("false"), url_filter.rule_table(spark, queries.RULES)).collect() == []


def test_url_rules_stay_in_the_jvm(spark, urls):
    plan = url_filter.judge(urls, url_filter.rule_table(spark, queries.RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Join" not in plan and "Exchange hash" not in plan


# ---- op12 -------------------------------------------------------------------------------------------

def brute_runs(words, min_length=6, min_exponent=4):
    """All lags, all stretches, smallest periods by trial."""
    names = {}
    x = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    found = []
    for q in range(1, len(x) // min_exponent + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[0], (x[q:] == x[:-q]).astype(np.int8), [0]])))
        for start, stop in zip(same[::2].tolist(), same[1::2].tolist()):
            length = stop - start + q
            part = x[start:start + length]
            if length >= max(min_length, min_exponent * q) and all((part[d:] != part[:-d]).any() for d in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbers(words):
    return np.unique(np.array(words, np.int64), return_inverse=True)[1]


def test_runs_of_random_words():
    rnd = random.Random(0)
    for _ in range(1500):
        n, alphabet = rnd.randint(0, 120), rnd.choice([1, 2, 3, 30])
        w = [rnd.randrange(alphabet) for _ in range(n)]
        if n and rnd.random() < 0.7:
            s = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - s) // 3))
            w = w[:s] + [w[s + (i - s) % p] for i in range(s, n)]
        for bounds in ((6, 4), (2, 2), (20, 3)):
            assert periodic_runs.runs_of(numbers(w), *bounds) == brute_runs(w, *bounds), (w, bounds)


def expected_runs(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_op12_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op12_periodic_runs(spark, sf).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] > 0 for r in rows) >= 10
    for r in rows:
        assert tuple(r)[1:] == expected_runs(r["doc_id"], texts[r["doc_id"]]), r["doc_id"]


def test_runs_on_odd_documents(spark, odd_docs, no_docs):
    more = [("a " * 9, [(0, 9, 1)], "a"), ("x a b a b a b a b", [(1, 8, 2)], "x a b"), ("a\u00a0b a\u00a0b\x1ca\u00a0b", [], None), ("a a a a a", [], None)]
    docs = odd_docs.unionByName(spark.createDataFrame([(100 + i, t) for i, (t, _, _) in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    got = periodic_runs.find_runs(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] in (3, 4, 7):
            assert (r["n_words"], r["runs"], bytes(r["collapsed"])) == (0, [], b"")
        if r["doc_id"] is not None and r["doc_id"] >= 100:
            text, runs, rest = more[r["doc_id"] - 100]
            assert [tuple(x) for x in r["runs"]] == runs and bytes(r["collapsed"]).decode() == (rest or text)
    assert periodic_runs.find_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_exponent=1)


def test_runs_of_very_long_texts():
    """Two million words: one period throughout, many runs, no runs; and a text over the piece size."""
    n = 2_000_000
    assert periodic_runs.runs_of(np.arange(n) % 3001) == [(0, n, 3001)]
    assert len(periodic_runs.runs_of(np.repeat(np.arange(n // 10), 10))) == n // 10
    text = b"one  two\t" * 300_000
    ids, words = periodic_runs.words_of(text)
    assert len(text) > 2 * periodic_runs.PIECE and len(ids) == 600_000 and words == [b"one", b"two"]
    assert periodic_runs.collapse(ids, words, periodic_runs.runs_of(ids)) == b"one two"


# ---- op13 -------------------------------------------------------------------------------------------

def brute_negatives(rows, positives=5, negatives=10, low=30, high=90):
    """rows: (id, label, integer components), all valid."""
    out = []
    for i, label, v in rows:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if len(w) == len(v)]
        for s, j in sorted((s, j) for s, j, other in scored if other == label and j != i)[:positives]:
            hard = sorted((t, k) for t, k, other in scored if other != label and low * -s <= 100 * -t <= high * -s)[:negatives]
            out += [(i, j, rank + 1, k, -s, -t) for rank, (t, k) in enumerate(hard)]
    return sorted(out)


def test_op13_query(spark, sf):
    rows = []
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, [math.floor(256 * x) for x in r["embedding"]]))
    got = sorted(map(tuple, queries.op13_hard_negatives(spark, sf).collect()))
    assert got == brute_negatives(rows) and got


@pytest.mark.parametrize("top", [3, 300, 40_000, 10**9, 2**60])
def test_scores_are_exact(top):
    """Python's integers are the measure, from one prime to many; scores beyond a long are cut to its range."""
    rng = np.random.default_rng(top % 1000)
    a, b = (np.trunc(rng.uniform(-top, top, (n, 150))) for n in (7, 30))
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(u, v)), -2**63), 2**63 - 1) for v in b] for u in a]
    assert hard_negatives.scores(a, b).tolist() == want
    whole = np.full((1, 64), float(top))
    assert hard_negatives.scores(whole, -whole).tolist() == [[max(-64 * int(top) ** 2, -2**63)]]


def test_blocks_and_cells_change_nothing(spark):
    """Ties, repeated ids, several lengths, many small cells, one label for most rows."""
    rng = np.random.default_rng(5)
    rows = [(int(i), int(rng.integers(0, 3)) * int(rng.random() < 0.4), rng.integers(-3, 4, 8 if i % 11 else 5).tolist()) for i in range(900)]
    rows += [rows[i] for i in (3, 3, 10, 17)]
    table = spark.createDataFrame([(i, lab, [x / 256 for x in v]) for i, lab, v in rows], "vec_id long, label int, embedding array<double>").repartition(7)
    table = table.select("*", *[F.lit(i).alias(c) for i, c in enumerate([*CLASHES, "part", "asks", "raw", "wanted", "slot"])])
    want = brute_negatives(rows)
    for plan in (hard_negatives.Plan(), hard_negatives.Plan(rows=100, anchors=2)):
        assert sorted(map(tuple, hard_negatives.mine(table, F.col("vec_id") % 100 == 0, plan).collect())) == want


def test_negatives_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.25, 0.5]), (3, 2, [1.0, -0.5]), (4, 1, [0.0, 0.0]), (100, 5, [1.0, 2.0]), (200, 1, [])]
    bad = [(None, 1, [1.0, 1.0]), (5, None, [1.0, 1.0]), (6, 1, None), (7, 1, [1.0, None]), (8, 1, [inf, 0.0]), (9, 1, [nan, 0.0]), (None, None, None), (10, 2, [1e200, 0.0])]
    schema = "vec_id long, label int, embedding array<double>"
    got = sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(good + bad, schema), F.col("vec_id") % 100 == 0).collect()))
    assert got == brute_negatives([(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in good]) and got
    for none in (spark.createDataFrame([], schema), spark.createDataFrame(bad, schema), spark.createDataFrame(good[1:5], schema)):
        assert hard_negatives.mine(none, F.col("vec_id") % 100 == 0).collect() == []
    huge = spark.createDataFrame([(0, 1, [1e140]), (1, 1, [1e140]), (2, 2, [1e139]), (3, 2, [0.004])], schema)
    assert [tuple(r) for r in hard_negatives.mine(huge, F.col("vec_id") == 0).collect()] == []
