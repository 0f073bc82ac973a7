"""URL rules by Bloom filter cascades: exact membership for every key of the corpus, without joins.

A rule is a host and the start of a path.  The keys of a URL are the rules
that could fit it: each of its host's last labels (as many as any rule has)
with each start of its path (of the lengths that rules have).  A cascade
answers whether a key is listed.  Its first level is a Bloom filter of the
listed keys; the second encodes the keys of the corpus that pass the first but
are not listed, the third the listed keys that pass the second, and so on until
a level lets nothing false pass.  The corpus's keys are all asked while it is
built, so the answer is exact for each of them.

All work is DataFrame functions.  URLs are read three times (a sketch of the
number of keys, the keys that pass the first level, the verdicts) and never
shuffled; only the distinct keys that pass are.  A cascade is one row, asked
as a scalar: a part holds at most ``max_keys`` listed keys, which bounds its
bytes; a longer list is cut by the hash of its keys into parts, asked one after
the other with the rows written in between.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import materialise

VERDICTS = ("block", "allow")
FLOOR_BITS = 1 << 13
BEST = "struct<len:int,host_len:int,verdict:string,rule:string>"


@dataclass(frozen=True)
class Level:
    """A Bloom filter's shape; ``seed`` keeps the hashes of levels apart."""

    seed: int
    words: int
    hashes: int

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.seed), F.lit(j), key), F.lit(self.words * 64)) for j in range(self.hashes)]

    def has(self, key: Column, data: Column) -> Column:
        """Whether all of a key's bits are set in ``data``, words of 8 bytes, high byte first."""
        def bit(p: Column) -> Column:
            at = F.shiftright(p, 6) * 8 + 8 - F.shiftright(p.bitwiseAND(63), 3)
            byte = F.conv(F.hex(F.substr(data, at.cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, p.bitwiseAND(7).cast("int")) == 1

        return reduce(lambda a, b: a & b, [bit(p) for p in self.positions(key)])

    def encode(self, keys: DataFrame) -> DataFrame:
        """One row with ``data``, the filter of column ``key``; ``words`` rows are gathered, whatever the keys."""
        found = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("p"))
        bits = found.select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
        every = keys.sparkSession.range(self.words).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
        words = bits.unionAll(every).groupBy("w").agg(F.bit_or("b").alias("b"))
        ordered = F.array_sort(F.collect_list(F.struct("w", F.lpad(F.hex("b"), 16, "0").alias("h"))))
        return words.agg(F.unhex(F.array_join(F.transform(ordered, lambda x: x["h"]), "")).alias("data"))


def shape(seed: int, keys: int, rate: float) -> Level:
    """The smallest filter of whole words for ``keys`` keys at a false positive rate."""
    bits = max(1, keys) * math.log(1 / rate) / math.log(2) ** 2
    return Level(seed, math.ceil(bits / 64), max(1, round(math.log2(1 / rate))))


def listed(levels: list[Level], key: Column, filters: Column, first: int = 0) -> Column:
    """A cascade's answer; its filters are ``filters[first:]``.

    Levels hold listed keys and false positives in turn, so the first level that a key fails decides.
    """
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[i].has(key, F.get(filters, F.lit(first + i))), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def one_row(data: list[DataFrame]) -> DataFrame:
    """``filters``: the binaries of ``data`` as one array."""
    rows = reduce(DataFrame.unionAll, [d.select(F.lit(i).alias("i"), "data") for i, d in enumerate(data)])
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "data"))), lambda x: x["data"]).alias("filters"))


def with_answer(df: DataFrame, column: str, data: list[DataFrame], out: str, fn: Callable[[Column, Column], Column]) -> DataFrame:
    """``out`` = ``fn(column, filters)``.  Both are bound once, so the optimizer puts the scalar in place of the filters and no row carries them."""
    bound = F.array(F.struct(F.col(column).alias("x"), F.col("filters").alias("f")))
    return (df.withColumn("filters", one_row(data).scalar())
            .withColumn(out, F.get(F.transform(bound, lambda b: fn(b["x"], b["f"])), F.lit(0))).drop("filters"))


def build(universe: DataFrame, keys: DataFrame, n: int, n_universe: int, seed: int = 0) -> tuple[list[Level], list[DataFrame]]:
    """Levels and filters of the cascade that tells ``keys`` (``n`` distinct non-null ``key``) from every other key of ``universe``.

    ``n_universe`` (about the number of distinct keys) only sizes the first
    level: its rate is sqrt(1/2) listed / others, that of the later ones 1/2 or,
    for few keys, what ``FLOOR_BITS`` give.
    """
    levels, data, wrong, n_wrong, marked, others = [], [], keys, n, None, 0
    rate = min(0.5, max(1e-9, math.sqrt(0.5) * n / max(1, n_universe)))
    while n_wrong:
        level = shape(seed + len(levels), n_wrong, rate)
        levels, data = [*levels, level], [*data, materialise(level.encode(wrong), "level")]
        if marked is None:  # the listed keys, and all others that pass the first level
            passing = with_answer(universe, "key", data, "said", lambda k, f: listed(levels, k, f)).where("said")
            both = keys.select("key", F.lit(True).alias("in")).unionAll(passing.select("key", F.lit(False).alias("in")))
            marked = materialise(both.groupBy("key").agg(F.max("in").alias("in")), "passing")
            others = marked.count()
        wrong = with_answer(marked, "key", data, "said", lambda k, f: listed(levels, k, f)).where(F.col("said") != F.col("in"))
        n_wrong = wrong.count()
        # half of the others pass a level; where FLOOR_BITS do better they are spent
        rate = min(0.5, max(0.5 / others, math.exp(-FLOOR_BITS * math.log(2) ** 2 / max(1, n_wrong))))
    return levels, data


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://`` or url."""
    return F.coalesce(_ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From there up to ``?``, ``#`` or the end; '' without ``://`` or url."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules given as ``(verdict, "host/path")``."""
    cut = [(v, r[: (r + "/").index("/")], r[(r + "/").index("/"):]) for v, r in rules]
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in cut]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every rule that could fit: (length, host's length, key), each host tail with each path start."""
    tails = F.array_distinct(F.filter(F.array(*[F.substring_index(host, ".", -d) for d in range(1, labels + 1)]), lambda t: t != ""))
    starts = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path)), lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(tails, lambda t: F.transform(starts, lambda s: F.struct(
        (F.length(t) + F.length(s)).alias("len"), F.length(t).alias("host_len"), F.concat(t, s).alias("key")))))


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", max_keys: int = 1_000_000) -> DataFrame:
    """All columns of ``urls`` in a struct ``row``, with ``host``, ``path``, ``rule`` and ``verdict`` by the longest rule that fits.

    ``rules`` has ``host``, ``path`` and ``verdict`` (block or allow).  A rule
    fits its host and all subdomains where the path starts with its own.  Of
    equally long rules the one with the longer host wins; a rule in both lists
    blocks; repeated rules count once; rules with a null, no host or another
    verdict fit nothing.  Where none fits, ``rule`` is null and the verdict is
    ``default``: the key is then in neither list.  A null url, or one without
    ``://``, has empty host and path and fits no rule.  Repeated rows are judged
    each; an empty table gives no rows, and no rules give ``default``.
    """
    spark = urls.sparkSession
    lists = (rules.select(_ascii_lower(F.col("host")).alias("host"), "path", "verdict")
             .where((F.col("host") != "") & F.col("path").isNotNull() & F.col("verdict").isin(*VERDICTS)))
    keys = materialise(lists.groupBy(F.concat("host", "path").alias("key"))
                       .agg(F.max("verdict").alias("verdict"), F.max(F.size(F.split("host", r"\."))).alias("labels"), F.any_value(F.length("path")).alias("n")), "rules")
    about = keys.agg(F.max("labels").alias("labels"), F.sort_array(F.collect_set("n")).alias("lengths"), F.count("*").alias("n")).first()
    row = F.struct(*[F.col(f"`{c}`") for c in urls.columns])
    out = (urls.select(row.alias("row")).withColumn("host", host_of(F.col("row")[url_col])).withColumn("path", path_of(F.col("row")[url_col]))
           .withColumn("best", F.lit(None).cast(BEST)))
    if about["n"]:
        found = _candidates(F.col("host"), F.col("path"), about["labels"], about["lengths"])
        universe = out.select(F.explode(found).alias("c")).select("c.key")
        n_universe = universe.agg(F.approx_count_distinct("key")).first()[0]
        parts = math.ceil(about["n"] / max_keys)
        keys = keys.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
        sizes = {(r["part"], r["verdict"]): r["count"] for r in keys.groupBy("part", "verdict").count().collect()}  # two rows a part
        for part in range(parts):
            cascades, data = [], []
            for v in [v for v in VERDICTS if (part, v) in sizes]:
                mine = keys.where((F.col("part") == part) & (F.col("verdict") == v)).select("key")
                levels, own = build(universe, mine, sizes[part, v], n_universe, seed=1000 * (2 * part + VERDICTS.index(v)))
                cascades.append((v, levels, len(data)))
                data += own

            def fitting(x: Column, filters: Column) -> Column:
                hits = [F.transform(F.filter(x["found"], lambda x: listed(levels, x["key"], filters, first)),
                                    lambda x: F.struct(x["len"].alias("len"), x["host_len"].alias("host_len"), F.lit(v).alias("verdict"), x["key"].alias("rule")))
                        for v, levels, first in cascades]
                return F.array_max(F.concat(*[h.cast(f"array<{BEST}>") for h in hits], F.filter(F.array(x["best"]), lambda b: b.isNotNull())))

            if cascades:
                out = with_answer(out.withColumn("both", F.struct(found.alias("found"), "best")), "both", data, "now", fitting)
                out = out.drop("both", "best").withColumnRenamed("now", "best")
            if part + 1 < parts:
                out = materialise(out, "asked")
    return out.select("row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def keep_allowed(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``urls`` whose verdict is allow, with their columns."""
    judged = judge(urls, rules, url_col, default)
    return judged.where(F.col("verdict") == "allow").select("row.*")
