"""HTML extraction, licence rules and quality rules against plain rewrites."""

import collections
import html
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHES, documents
from weft.llm import html_template, license_rules, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# ---- op1 --------------------------------------------------------------------------------------------

def text_of(page: str) -> list[str]:
    return html_template.main_text(html_template.Page(page), {}).split("\n")


def test_pages_match_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    source = {r.page_id: (r.url, r.html) for r in pages.collect()}
    rows = html_template.extract(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|<footer>)", source[r.page_id][1], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>|<br>", article))
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text) and r.url == source[r.page_id][0]


def test_furniture_markup_and_references():
    assert text_of("""<html><head><title>T</title></head><body><div id=top class="main-menu">menu</div><div class=wrap>
      <h2>A &amp; b&nbsp;c</h2>one<br>two <b>x</b>y<p>three<p>four &lt;tag&gt;<ul><li>a<li>b</ul>tail
      <table><tr><td>c1<td>c2<tr><td>d</table></div><aside>side</aside><form>f<input></form>
      <div class="user-comments"><p>no</div><script>if(a<b){"</p>"}</script><!-- x > y --><p hidden>gone</p>
      <div style="display: none">gone</div><a title="a>b">link</a><![CDATA[raw &amp;]]></body>""") == [
        "A & b c", "one two xy", "three", "four <tag>", "a", "b", "tail", "c1", "c2", "d", "linkraw &amp;"]
    assert text_of("<body><nav>n</nav><p>before</p><article><header>h</header><p>in</p><footer>f</footer></article><p>after</p>") == ["in"]
    assert text_of("") == text_of("<p") == [""] or text_of("<p") == ["<p"]
    assert text_of("plain text only") == ["plain text only"]
    assert text_of("<p>" * 3000 + "deep") == ["deep"]
    assert text_of('<p a="unclosed>one</p><p>two') != []


def test_template_finds_the_region_and_constant_texts(spark):
    """Pages without article elements: the menu's links and a line on every page are template, the rest is slots."""
    def page(i):
        body = "".join(f"<p>text {i} {j} with some words of its own</p>" for j in range(4))
        return (f"<html><body><div class=x><ul><li><a href=/>home</a><li><a href=/b>about us all</a></ul></div>"
                f"<div class=y><p>Thank you for reading our site</p>{body}</div><div class=z>made by no one {i}</div></body></html>")
    rows = [(i, f"https://Host.example/{i}", page(i)) for i in range(10)] + [(99, "https://lone.example/", page(99))]
    rows += [(100 + i, f"http://copies.example/{i}", page(7)) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in html_template.extract(pages).collect()}
    for i in range(10):
        assert got[i] == [f"text {i} {j} with some words of its own" for j in range(4)]
    assert "Thank you for reading our site" in got[99]
    assert got[100] == got[108] and len(got[100]) >= 5            # all pages alike: nothing is taken for a template


def host_texts(spark, bodies):
    """page number -> lines of the text, for a host whose pages have these bodies."""
    rows = [(i, f"https://host.example/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text.split("\n") for r in html_template.extract(pages).collect()}


def test_a_lead_beside_the_body_stays(spark):
    def body(i):
        return (f"<div class=top>All our pages</div><div class=post><h1>Title {chr(97 + i)}</h1><div class=lead>lead {chr(97 + i)} in a few words</div>"
                f"<div class=body><p>{f'body words {chr(97 + i)} ' * 20}</p></div></div><div class=end>page {i} of ours</div>")
    got = host_texts(spark, map(body, range(9)))
    for i in range(9):
        x = chr(97 + i)
        assert got[i] == [f"Title {x}", f"lead {x} in a few words", " ".join([f"body words {x}"] * 20)]


def test_teaser_articles_do_not_hide_the_real_text(spark):
    def body(i, cards):
        x = chr(97 + i)
        return (f"<div class=text><p>real text {x}</p><p>more of {x}</p></div>" + "".join(
            f"<article class=card>{x} card {chr(97 + c)}</article>" for c in range(cards)) + "<p>our site</p>")
    for cards in (1, 3):
        got = host_texts(spark, [body(i, cards) for i in range(9)])
        for i in range(9):
            x = chr(97 + i)
            assert got[i] == [f"real text {x}", f"more of {x}", *(f"{x} card {chr(97 + c)}" for c in range(cards))]
    assert text_of(body(0, 3)) == ["real text a", "more of a", "a card a", "a card b", "a card c", "our site"]


def test_classes_that_repeat_in_a_page_are_ordered_and_nested(spark):
    """The constant label of a record that repeats as often as its element is template; words that only share the number are not."""
    def body(i):
        x = chr(97 + i)
        return (f"<div class=post><h1>Title {x}</h1><p>{f'body words {x} ' * 9}</p>" + "".join(
            f"<div class=item><b class=label>Our review of it</b><p>{x} record {chr(97 + c)} is told here</p></div>" for c in range(1 + i % 3)) + "</div>")
    got = host_texts(spark, map(body, range(12)))
    for i in range(12):
        x = chr(97 + i)
        assert got[i] == [f"Title {x}", " ".join([f"body words {x}"] * 9), *(f"{x} record {chr(97 + c)} is told here" for c in range(1 + i % 3))]


def test_class_checks():
    check = html_template.check_page
    assert check([1, 2, 9, 1, 2], [[1, 2]]) == ([], [])
    assert check([1, 1, 2, 2], [[1, 2]]) == ([0], [])                            # not round by round
    assert check([2, 1], [[1, 2]]) == ([0], [])
    assert check([1, 3, 4, 3, 4, 2], [[1, 2], [3, 4]]) == ([], [])               # in one gap
    assert check([1, 3, 2, 4], [[1, 2], [3, 4]]) == ([], [(0, 1)])
    assert check([1, 3, 2, 4, 5], [[1, 2, 5], [3, 4]]) == ([], [(0, 1)])         # over two gaps
    many, few = {"on": 20, "tokens": [1, 2]}, {"on": 9, "tokens": [3, 4]}
    assert html_template.nested([few, many], set(), {(0, 1)}) == [many]
    assert html_template.nested([few, many], {1}, {(0, 1)}) == [few]             # a class that is not ordered pushes none out


@pytest.mark.parametrize("page,lines", [
    ("<div class='content has-sidebar'><p>text of it</p></div>", ["text of it"]),
    ("<div id='ad-free-article'><p>text of it</p></div><div class=sidebar-left>x</div>", ["text of it"]),
    ("<div class='post no-comments'><p>text of it</p><ul class='share-links'><li>x</ul></div>", ["text of it"]),
    ("<form id=aspnet><div class=menu>m</div><p>text of it</p></form>", ["text of it"]),
    ("<div class=widget><p>text of it, longer</p></div><p>b</p>", ["text of it, longer", "b"]),
    ("<p><a class='social'>Name</a> long paragraph</p><p><a class=social>x</a></p>", ["Name long paragraph"]),
    ("<div class='ad'>x</div><article><br>Lead text<p>more</p></article>", ["Lead text", "more"]),
    ("<article><p>short</p></article><div class=ad>an ad with far more text than that</div>", ["short"]),
    ("<p>seen <span hidden>not</span> again</p>", ["seen again"]),
])
def test_names_alone_remove_no_article(page, lines):
    assert text_of(f"<body>{page}</body>") == lines


def test_pages_odd_rows(spark):
    page = "<body><article><p>a</p></article>"
    rows = [(1, None, page), (2, "https://h.example/", None), (3, "no url", ""), (None, "https://h.example/x", page), (1, None, page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(0).alias(c) for c in CLASHES])
    got = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in html_template.extract(pages).collect())
    assert got == sorted([("1", "None", "a", 1), ("1", "None", "a", 1), ("2", "https://h.example/", "", 0), ("3", "no url", "", 0),
                          ("None", "https://h.example/x", "a", 1)])
    assert html_template.extract(pages.limit(0)).collect() == []


# ---- op3 --------------------------------------------------------------------------------------------

def base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in license_rules.BASE.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits})))


def test_base_phrases_match_a_plain_scan(spark, sf, odd_docs, no_docs):
    extra = [(-1, "MIT License, mit-license; the Apache License, Version 2.0 and GNU General Public License v3 or later. CC-BY 4.0"),
             (-2, " ...cc  by ccé by É mit license"), (-3, "mit license " * 300), (-4, "permit license, cc-byé, summit license")]
    docs = documents(spark, sf).select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    for table in (docs, odd_docs, no_docs):
        text = collections.defaultdict(list)
        for r in table.select("doc_id", "text").collect():
            text[r.doc_id].append(r.text)
        rows = license_rules.scan(table).collect()
        assert len(rows) == sum(map(len, text.values()))
        for r in rows:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) in [base_places(t) for t in text[r.doc_id]]
            assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_rules_priority_and_containment(spark):
    cases = {"licensed under the GNU GPL, GNU General Public License version 2 or later": "gpl,gpl-2-or-later",
             "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0", "SPDX-License-Identifier: MIT": "mit",
             "Licensed under the Apache License, Version 2.0": "apache,apache-2.0",
             "BSD 3-Clause License and public domain": "bsd-3-clause,public-domain", "no terms at all": "",
             "Mozilla Public License 2.0; all rights reserved": "mpl-2.0,proprietary"}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_rules.scan(docs).collect()}
    assert got == dict(enumerate(cases.values()))
    assert len(license_rules.RULES) >= 300


def matches(parsed):
    """Every string that a parsed pattern without open repeats matches (one letter for a class)."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "IN":
            some = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])]
        elif name == "SUBPATTERN":
            some = matches(arg[3])
        elif name == "BRANCH":
            some = [m for branch in arg[1] for m in matches(branch)]
        elif name == "MAX_REPEAT":
            assert arg[:2] == (0, 1)
            some = ["", *matches(arg[2])]
        else:
            raise AssertionError(name)
        out = [o + m for o in out for m in some]
    return out


def test_every_rule_has_its_keyword_and_a_hint():
    """The prefilters lose nothing: whatever a rule matches holds its keyword and a hint."""
    cc_by = re.compile(license_rules.CC_BY)
    for rule in license_rules.RULES:
        for text in matches(re._parser.parse(rule.pattern)):
            assert re.fullmatch(rule.pattern, text) and f" {rule.keyword}" in f" {text}" and (
                any(h in text for h in license_rules.HINTS) or cc_by.search(text)), (rule, text)
            assert len(text.split()) <= license_rules.REACH


def detect(text, rules):
    """Every rule tried on all words, then containment: (labels without the base's, detections, best priority)."""
    words = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) + " "
    hits = set()
    for rule, pattern in rules:
        for m in pattern.finditer(words):
            start = words.count(" ", 0, m.start()) - 1
            hits.add((start, -(start + m.group().count(" ") + 1), -rule.priority, rule.label))
    reach, kept = -1, []
    for start, stop, priority, label in sorted(hits):
        if -stop > reach:
            reach = -stop
            kept.append((label, -priority))
    return {label for label, _ in kept}, len(kept), max([p for _, p in kept], default=0) / 100


def test_detections_match_all_rules_tried(spark):
    """All rules on every text of sf0.01 and on texts put together from what rules match, with fillers between."""
    rules = [(r, re.compile(license_rules._framed(r.pattern))) for r in license_rules.RULES]
    rnd = random.Random(8)
    strings = [m for r in license_rules.RULES for m in matches(re._parser.parse(r.pattern))]
    filler = ["the", "license", "gnu", "cc", "by", "mit", "version", "2", "public", "apache", "x"]
    made = []
    for i in range(400):
        parts = [w for _ in range(rnd.randint(1, 12)) for w in (rnd.choice(strings), *rnd.choices(filler, k=rnd.randint(0, 3)))]
        made.append((10**6 + i, rnd.choice([" ", ", ", "\n", " - "]).join(parts).title()))
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text").unionAll(spark.createDataFrame(made, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = 0
    for r in license_rules.scan(docs).collect():
        labels, n, score = detect(texts[r["doc_id"]], rules)
        base = set(r["base_labels"].split(",")) - {""}
        assert (set(r["labels"].split(",")) - {""}, r["detections"], r["score"]) == (labels | base, n, pytest.approx(score)), texts[r["doc_id"]][:300]
        found += n
    assert found > 1500


def test_a_long_text_of_phrases(spark):
    """A megabyte of one phrase: linear in the text."""
    import time
    n = 87_000
    docs = spark.createDataFrame([(1, "mit license " * n)], "doc_id long, text string")
    began = time.time()
    r = license_rules.scan(docs).first()
    assert (r["n_words"], r["n_base"], r["last_word"], r["labels"], r["detections"]) == (2 * n, n, 2 * n - 2, "mit", n)
    assert time.time() - began < 60


# ---- op8 --------------------------------------------------------------------------------------------

def measured(text):
    text = text or ""
    words = WORD.findall(text)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words)


def test_measures_match_a_plain_scan(spark, sf, odd_docs):
    for table in (documents(spark, sf), odd_docs):
        got = sorted(tuple(map(str, r)) for r in quality_rules.with_measures(table).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
        assert got == sorted(tuple(map(str, (r.doc_id, *measured(r.text)))) for r in table.collect())


def exact_tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("k,n,p", [(0, 1, .5), (0, 100, .01), (3, 40, .1), (39, 40, .1), (40, 40, .1), (7, 500, .02), (20, 500, .02)])
def test_binomial_tail(k, n, p):
    assert quality_rules._tail(k, n, p) == pytest.approx(exact_tail(k, n, p), rel=1e-9, abs=1e-12)


def test_cutoffs_are_certified_and_as_tight_as_the_bound_allows():
    cells = quality_rules.CELLS
    rejected = [max(0, 40 - c) for c in range(cells + 1)]
    cut = quality_rules.certified_cutoff(rejected, 2000, 0.01, 0.01)
    passes = [rejected[c] <= 20 and exact_tail(rejected[c], 2000, 0.01) <= 0.01 for c in range(cells + 1)]
    assert cut == min(c for c in range(cells + 1) if all(passes[c:]))
    assert quality_rules.certified_cutoff(rejected, 0, 0.01, 0.01) == cells
    assert quality_rules.certified_cutoff([0] * (cells + 1), 100, 0.01, 0.01) == cells      # too few labels certify nothing
    assert quality_rules.certified_cutoff([0] * (cells + 1), 5000, 0.01, 0.01, floor=30) == 30


def test_rules_reject_junk_and_keep_labelled_good(spark, odd_docs, no_docs):
    rows = [(i, " ".join(f"plain{(i * 31 + j) % 997} words{j}" for j in range(40)), "en") for i in range(900)]
    rows += [(1000 + i, " ".join(f"w{i * j}*** ###" for j in range(70)), "en") for i in range(50)] + [(2000, "a b c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(900)] + [(3, 1, 0), (None, 1, 0), (1000, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules.judge(docs, labels, alpha=0.1).collect()}
    assert all(got[i].kept for i in range(900)) and not any(got[1000 + i].kept for i in range(50))
    assert "symbols" in got[1000].failed_rules.split(",") and not got[2000].kept
    assert all(got[i].kept == (not got[i].base_failed) for i in got) is False
    nothing = quality_rules.judge(docs, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in nothing)
    assert quality_rules.judge(odd_docs, labels).count() == odd_docs.count()
    assert quality_rules.judge(no_docs, labels).collect() == []


def test_rules_are_tested_jointly(spark):
    """Labels that certify the union of the rules at alpha are enough; false rejections of several rules add up."""
    def plain(i):
        return " ".join(f"plain{(i * 31 + j) % 997} words{j}" for j in range(40))

    def starred(i):
        return " ".join(f"word{i + j} *%" for j in range(40))

    rows = [(i, plain(i), s) for s, n in (("de", 230), ("fr", 170)) for i in range(2000 * (s == "fr"), 2000 * (s == "fr") + n)]
    rows += [(9000 + i, starred(i), s) for i, s in enumerate(("de", "fr"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows if i < 9000], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert not got[9000] and got[9001]          # ln(0.05 / 2) / ln(0.98) = 183 labels
    assert all(got[i] for i in got if i < 9000)


def test_steps_match_a_plain_count(spark):
    measured = spark.createDataFrame([(i, "en", i % 100 + 1, (i * 7) % 1100, i % 60, (i * 3) % (i % 100 + 1), i % 9, 8, False) for i in range(400)],
                                     "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_repeat_words long, n_dup_lines long, "
                                     "n_lines long, base_failed boolean")
    measured = measured.where("n_symbols <= word_chars and n_dup_lines <= n_lines")
    want = collections.Counter()
    for r in measured.select(*[F.ceil(F.expr(v) * 200).alias(r) for r, (v, _) in quality_rules.RULES.items()]).collect():
        want["en", max([c for c in range(200) if any(r[x] > quality_rules._cell(x, c) for x in quality_rules.RULES)], default=-1)] += 1
    labels = measured.select("doc_id", F.lit(1).alias("quality"))
    assert quality_rules._histogram(measured, labels, "doc_id", "quality") == want
