"""Licence detection with ordered signature rules, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters outside words: ASCII that is neither digit nor letter (A-Z count as letters).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Base phrases and their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: No rule matches a text (in lower case) without one of these, nor without the last: each is a plain byte search.
HINTS = ("licens", "licenc", "copyright", "reserved", "cc0", "commons", "domain", "gpl", "gfdl", "spdx", "wtfpl", "permission",
         "redistribution", "bsd", "warranty", "endorse", "advertising", "proprietary", "unencumbered")
CC_BY = rf"(?i)cc{GAP}by"
#: Words on either side of a keyword that its rules read.
REACH = 20
V = r"(?:version |v ?)?"
LATER = r"(?: or (?:at your option )?(?:any )?later(?: version)?)"


@dataclass(frozen=True)
class Rule:
    """A regex over a text's words, lower-cased and joined by single spaces.

    ``keyword`` begins a word of each match, and no match has over ``REACH``
    words; ``priority`` orders rules on the same place and is the confidence
    in per cent.
    """

    label: str
    keyword: str
    pattern: str
    priority: int


def _gnu() -> list[Rule]:
    names = [("gpl", "general", "gpl", ["1", "2", "3"]), ("lgpl", "lesser general", "lgpl", ["2", "2 1", "3"]),
             ("lgpl", "library general", "lgpl", ["2", "2 1"]), ("agpl", "affero general", "agpl", ["1", "3"]),
             ("gfdl", "free documentation", "gfdl", ["1 1", "1 2", "1 3"])]
    out = []
    for label, words, short, versions in names:
        public = "" if words.startswith("free") else "public "
        full = f"(?:gnu )?{words} {public}licen[cs]e"
        out.append(Rule(label, words.split()[0], f"gnu {words} {public}licen[cs]e", 70))
        for v in versions:
            number, tag = f"{v}(?: 0)?", v.replace(" ", ".")
            out += [Rule(f"{label}-{tag}", words.split()[0], f"{full} {V}{number}", 90),
                    Rule(f"{label}-{tag}-or-later", words.split()[0], f"{full} {V}{number}{LATER}", 95),
                    Rule(f"{label}-{tag}-only", words.split()[0], f"{full} {V}{number} only", 95),
                    Rule(f"{label}-{tag}", short, f"{short} ?v?{number}", 80),
                    Rule(f"{label}-{tag}-or-later", short, f"{short} ?v?{number}{LATER}", 92),
                    Rule(f"{label}-{tag}-only", short, f"spdx license identifier {short} {number}(?: only)?", 99),
                    Rule(f"{label}-{tag}-or-later", short, f"spdx license identifier {short} {number} or later", 99)]
    return out


def _creative_commons() -> list[Rule]:
    parts = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
             "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
             "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"}
    out = []
    for (tag, words), version in product(parts.items(), ["1 0", "2 0", "2 5", "3 0", "4 0"]):
        short, label = tag.replace("-", " "), f"cc-{tag}-{version.replace(' ', '.')}"
        out += [Rule(label, "cc", f"cc {short} {version}", 90),
                Rule(label, "cc", f"spdx license identifier cc {short} {version}", 99),
                Rule(label, "commons", f"creative commons {words} {version}(?: (?:international|unported|generic))?(?: public)?(?: licen[cs]e)?", 95),
                Rule(label, "creativecommons", f"creativecommons org licenses {short} {version}", 97)]
    for tag, words in parts.items():
        short = tag.replace("-", " ")
        out += [Rule(f"cc-{tag}", "cc", f"cc {short}", 70), Rule(f"cc-{tag}", "commons", f"creative commons {words}(?: licen[cs]e)?", 72)]
    return out + [Rule("cc0-1.0", "cc0", "cc0(?: 1 0(?: universal)?)?", 90), Rule("cc", "commons", "creative commons(?: licen[cs]e)?", 40)]


def _versioned() -> list[Rule]:
    names = [("apache", "apache", "apache(?: software)? licen[cs]e", ["1 0", "1 1", "2 0"]),
             ("mpl", "mozilla", "mozilla public licen[cs]e", ["1 0", "1 1", "2 0"]),
             ("epl", "eclipse", "eclipse public licen[cs]e", ["1 0", "2 0"]),
             ("cddl", "common", "common development and distribution licen[cs]e", ["1 0", "1 1"]),
             ("cpl", "common", "common public licen[cs]e", ["0 5", "1 0"]),
             ("artistic", "artistic", "artistic licen[cs]e", ["1 0", "2 0"]),
             ("eupl", "european", "european union public licen[cs]e", ["1 0", "1 1", "1 2"]),
             ("osl", "open", "open software licen[cs]e", ["1 0", "2 0", "2 1", "3 0"]),
             ("afl", "academic", "academic free licen[cs]e", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
             ("ofl", "open", "(?:sil )?open font licen[cs]e", ["1 0", "1 1"]),
             ("bsl", "boost", "boost software licen[cs]e", ["1 0"]),
             ("odbl", "open", "open database licen[cs]e", ["1 0"]),
             ("odc-by", "open", "open data commons attribution licen[cs]e", ["1 0"]),
             ("python", "python", "python(?: software foundation)? licen[cs]e", ["2", "2 0"]),
             ("zpl", "zope", "zope public licen[cs]e", ["1 1", "2 0", "2 1"]),
             ("ms-pl", "microsoft", "microsoft public licen[cs]e", []), ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", []),
             ("php", "php", "php licen[cs]e", ["3 0", "3 01"]), ("lppl", "latex", "latex project public licen[cs]e", ["1 0", "1 1", "1 2", "1 3c?"]),
             ("ecl", "educational", "educational community licen[cs]e", ["1 0", "2 0"]), ("ipl", "ibm", "ibm public licen[cs]e", ["1 0"]),
             ("apsl", "apple", "apple public source licen[cs]e", ["1 0", "1 1", "1 2", "2 0"]), ("qpl", "q", "q public licen[cs]e", ["1 0"]),
             ("upl", "universal", "universal permissive licen[cs]e", ["1 0"]), ("mulan", "mulan", "mulan permissive software licen[cs]e", ["1", "2"])]
    out = []
    for label, keyword, words, versions in names:
        out.append(Rule(label, keyword, words, 70))
        for v in versions:
            tag = v.replace(" ", ".").replace("?", "")
            out += [Rule(f"{label}-{tag}", keyword, f"{words} {V}{v}", 90), Rule(f"{label}-{tag}", keyword, f"(?:under|by) the (?:terms of the )?{words} {V}{v}", 93),
                    Rule(f"{label}-{tag}", label.split("-")[0], f"spdx license identifier {label} {v}".replace("-", " "), 99)]
    return out


def _plain() -> list[Rule]:
    fixed = [("mit", "mit", "mit(?: x11)? licen[cs]e", 70), ("mit", "expat", "expat licen[cs]e", 70), ("mit", "mit", "(?:under|by) the (?:terms of the )?mit licen[cs]e", 85),
             ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", 95),
             ("mit", "spdx", "spdx license identifier mit", 99), ("mit", "x11", "x11 licen[cs]e", 70),
             ("isc", "isc", "isc licen[cs]e", 75), ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 92),
             ("isc", "spdx", "spdx license identifier isc", 99), ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", 75),
             ("zlib", "provided", "this software is provided as is without any express or implied warranty", 60),
             ("bsd", "bsd", "bsd(?: style)? licen[cs]e", 65), ("bsd", "redistribution", "redistribution and use in source and binary forms", 80),
             ("bsd-3-clause", "endorse", "endorse or promote products derived from this software", 88),
             ("bsd-4-clause", "advertising", "all advertising materials mentioning features", 88),
             ("unlicense", "unlicense", "(?:the )?unlicense", 85), ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 97),
             ("wtfpl", "wtfpl", "wtfpl", 85), ("public-domain", "domain", "(?:in|into|to) the public domain", 50), ("public-domain", "domain", "public domain", 35),
             ("proprietary", "reserved", "all rights reserved", 30), ("copyright-notice", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 25),
             ("proprietary", "confidential", "proprietary and confidential", 60)]
    out = [Rule(*f) for f in fixed]
    for n, word in (("2", "two|simplified"), ("3", "three|new|revised|modified"), ("4", "four|original|old")):
        out += [Rule(f"bsd-{n}-clause", "bsd", f"bsd {n} clause(?: licen[cs]e)?", 90), Rule(f"bsd-{n}-clause", "bsd", f"(?:{n}|{word})(?: clause)? bsd(?: licen[cs]e)?", 88),
                Rule(f"bsd-{n}-clause", "bsd", f"spdx license identifier bsd {n} clause", 99)]
    return out


#: In order of priority; equal ones as listed.
RULES = sorted([*_gnu(), *_creative_commons(), *_versioned(), *_plain()], key=lambda r: -r.priority)


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _places(words: Column, pattern: Column) -> Column:
    """Intervals ``(start, stop)`` in words of a regex's matches in a few words, by counting the blanks between them."""
    found, between = F.regexp_extract_all(words, pattern, F.lit(0)), F.split(words, pattern, F.lit(-1))
    empty = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(acc, pair):
        start = acc["at"] + _spaces(pair["gap"])
        stop = start + _spaces(pair["hit"]) + 1
        return F.struct((stop - 1).alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), stop.alias("stop")))).alias("spans"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.aggregate(pairs, empty, step, lambda acc: acc["spans"])


def _framed(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections)`` for every row.

    A text without any hint is only counted.  The others are split into words;
    each word that begins with a keyword has that keyword's rules read the
    ``REACH`` words on either side of it (no match is longer), and keeps the
    matches that hold it, so work and memory are linear in the text.
    Detections are sorted by start, then the longer, then the higher priority;
    one that lies inside an earlier one is suppressed, so a mention inside a
    fuller notice (or the same place under a weaker rule) adds no label;
    partial overlaps both stay.  Base labels are never suppressed.  ``score``
    is the highest priority among what stays, in [0, 1].

    Null, empty and word-less texts have no words and empty labels; repeated
    rows, null ids and other columns pass through or are ignored; no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.lower(text).alias("low"))
    text = F.col("text")
    words = F.split(F.translate(F.trim(F.regexp_replace(text, GAP, " ")), UPPER, UPPER.lower()), " ")
    hint = reduce(or_, [F.contains(F.col("low"), F.lit(h)) for h in HINTS]) | (F.contains(F.col("low"), F.lit("cc")) & text.rlike(CC_BY))
    hinted = low.select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.when(hint, words).alias("ws"))
    keywords = sorted({r.keyword for r in rules}, key=lambda k: (-len(k), k))
    table = F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*[
        F.struct(F.lit(_framed(r.pattern)).alias("pattern"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"))
        for r in rules if r.keyword == k]).alias("rules")) for k in keywords])
    starts = "^(?:" + "|".join(keywords) + ")"

    def phrases(ws: Column) -> Column:
        """The first words of all base phrases."""
        def at(i: Column, phrase: str) -> Column:
            return reduce(lambda a, b: a & b, [F.get(ws, i + j) == word for j, word in enumerate(phrase.split())])

        first = F.sequence(F.lit(0), F.size(ws) - 1)
        return F.flatten(F.array(*[F.transform(F.filter(first, lambda i: F.coalesce(at(i, phrase), F.lit(False))),
                                               lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))) for phrase, label in BASE.items()]))

    def hits(ws: Column) -> Column:
        """Matches of each keyword's rules that hold the keyword, from the words around it."""
        found = F.filter(F.transform(ws, lambda w, i: F.struct(i.alias("at"), F.regexp_extract(w, starts, 0).alias("keyword"))), lambda f: f["keyword"] != "")

        def around(f: Column) -> Column:
            low = F.greatest(f["at"] - REACH, F.lit(0))
            near = F.concat(F.lit(" "), F.array_join(F.slice(ws, low + 1, F.lit(2 * REACH + 1)), " "), F.lit(" "))
            return F.struct(f["at"].alias("at"), low.alias("from"), near.alias("text"), F.filter(table, lambda t: t["keyword"] == f["keyword"])[0]["rules"].alias("rules"))

        def matched(a: Column) -> Column:
            every = F.flatten(F.transform(a["rules"], lambda r: F.transform(_places(a["text"], r["pattern"]), lambda s: F.struct(
                (a["from"] + s["start"]).alias("start"), (-(a["from"] + s["stop"])).alias("stop"), (-r["priority"]).alias("priority"), r["label"].alias("label")))))
            return F.filter(every, lambda h: (h["start"] <= a["at"]) & (a["at"] < -h["stop"]))

        return F.array_sort(F.flatten(F.transform(F.transform(found, around), matched)))

    # an array of one binds the words, so that they are split once
    found = hinted.select("doc_id", "n_words", F.transform(F.array("ws"), phrases)[0].alias("base"), F.transform(F.array("ws"), hits)[0].alias("hits"))
    none = F.struct(F.lit(-1).alias("reach"), F.lit(0).alias("best"), F.lit(0).alias("kept"), F.array().cast("array<string>").alias("labels"))

    def keep(acc, h):
        fresh = -h["stop"] > acc["reach"]
        return F.struct(F.greatest(acc["reach"], -h["stop"]).alias("reach"),
                        F.when(fresh, F.greatest(acc["best"], -h["priority"])).otherwise(acc["best"]).alias("best"),
                        (acc["kept"] + fresh.cast("int")).alias("kept"),
                        F.when(fresh, F.array_union(acc["labels"], F.array(h["label"]))).otherwise(acc["labels"]).alias("labels"))

    kept = F.aggregate(F.coalesce("hits", F.array().cast("array<struct<start:int,stop:int,priority:int,label:string>>")), none, keep)
    starts = F.transform("base", lambda b: b["start"])
    names = F.coalesce(F.array_distinct(F.transform("base", lambda b: b["label"])), F.array().cast("array<string>"))
    out = found.select("doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).alias("n_base"), F.array_min(starts).alias("first"),
                       F.array_max(starts).alias("last"), names.alias("names"), kept.alias("kept"))
    return out.select(
        "doc_id", "n_words", F.greatest(F.col("n_base"), F.lit(0)).cast("long").alias("n_base"),
        F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort("names")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("names", F.col("kept.labels")))).alias("labels"),
        (F.col("kept.best") / 100.0).alias("score"), F.col("kept.kept").cast("long").alias("detections"))
