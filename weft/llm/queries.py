"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import (bpe, cross_polytope, entropy_mix, hard_negatives, html_template, langid, license_rules, ngram_trie, periodic_runs, quality_rules, simhash_index,
                      suffix_dedup, url_filter)
from weft.session import read_table

#: Vocabulary of op6, and the weights that op9's sources take in turn.
VOCABULARY = "byte_bpe_50k.json"
WEIGHTS = [5.0, 2.0, 1.0]


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(read_table(spark, sf_dir, "pages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = suffix_dedup.mark_repeats(read_table(spark, sf_dir, "documents"), length=50)
    return marked.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.with_language(read_table(spark, sf_dir, "documents"), modulus=4, held=2)


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return cross_polytope.nearest(vectors, F.col("vec_id") % 20 == 0, cross_polytope.Plan(tables=16, probes=8, k=20))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score(read_table(spark, sf_dir, "documents"), modulus=7, held=2)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_rules.judge(docs, labels, alpha=0.02, delta=0.05).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return entropy_mix.mix(docs, WEIGHTS, cap=3).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_index.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


#: op11's rules, and the same in SQL.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
OP11_SQL = """
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parsed AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS n FROM cut),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (SELECT n, r.verdict, h || p AS rule, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, length(h) DESC) AS place
         FROM parsed JOIN rules r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""


def op11_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.rule_table(spark, RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """op12's input: where crc32(doc_id) ends in 0, the words from ``a`` on repeat the ``p`` words there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    made = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    made = made.withColumn("n", n).withColumn("a", (g % F.col("n")).cast("int")).withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    period, left = F.slice("words", F.col("a") + 1, F.col("p")), F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return made.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_periods(read_table(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("most", first)
    start, length, period = -F.col("most.col2"), F.col("most.length"), -F.col("most.col3")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS s
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.b AS negative_id,
       p.s AS positive_score, n.s AS negative_score
FROM pos p JOIN s n ON n.a = p.a AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)
QUALIFY row_number() OVER w <= 10
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    plan = hard_negatives.Plan(positives=5, negatives=10, low=30, high=90)
    return hard_negatives.mine(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0, plan, scale=256)


# ---- parts of operators that SQL can state: held against it over the whole tables ----------------------------------------

PLACES_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
h AS (SELECT doc_id, w, list_concat(
        list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'gnu' AND w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license'), lambda i: {'p': i - 1, 'l': 'gpl'}),
        list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'apache' AND w[i + 1] = 'license'), lambda i: {'p': i - 1, 'l': 'apache'}),
        list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' AND w[i + 1] = 'by'), lambda i: {'p': i - 1, 'l': 'cc-by'}),
        list_transform(list_filter(range(1, len(w) + 1), lambda i: w[i] = 'mit' AND w[i + 1] = 'license'), lambda i: {'p': i - 1, 'l': 'mit'})) AS hits FROM t)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(hits) AS BIGINT) AS n_base, list_min(list_transform(hits, lambda x: x.p)) AS first_word,
       list_max(list_transform(hits, lambda x: x.p)) AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(hits, lambda x: x.l))), ',') AS base_labels
FROM h
"""


def base_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3's contract fixes."""
    return op3_license_rules(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


MEASURES_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rn FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT rn, i, count(*) OVER (PARTITION BY rn, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS c
        FROM (SELECT rn, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM win WHERE c > 1) GROUP BY rn),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN rep USING (rn))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
"""


def quality_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op8's contract fixes."""
    return quality_rules.with_measures(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


TARGETS_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, sum(size) AS n, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY source),
-- the water level: the highest that the sources left over when the first are capped would need
k AS (SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY 3 * n / w DESC, source DESC) AS level FROM s),
f AS (SELECT source, n, round(least(3 * n, w * max(level) OVER ()), 3) AS target FROM k)
SELECT d.doc_id, d.size, CAST(f.n AS BIGINT) AS source_size, f.target FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
"""


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op9's contract fixes but for the words taken."""
    return op9_mix_sources(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


PARTS = {"llm_base_places": (base_places, PLACES_SQL), "llm_quality_measures": (quality_measures, MEASURES_SQL), "llm_mix_targets": (mix_targets, TARGETS_SQL)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)} | {k: f for k, (f, _) in PARTS.items()}


def oracle_sql() -> dict[str, str]:
    return {"op11_url_cascade": OP11_SQL, "op13_hard_negatives": OP13_SQL} | {k: sql for k, (_, sql) in PARTS.items()}
