"""Main text of web pages by equivalence classes of tokens over the pages of a host."""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from weft.llm.common import map_columns, materialise

ATTRIBUTE = r"""(?:"[^"]*"|'[^']*'|[^>"'])*"""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTE})>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
NAMED = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
RAW = frozenset("script style noscript iframe template title textarea noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var "
                   "ruby rb rt rp wbr img br".split())
#: Tags that end an open element of the same group, up to the nearest of the second kind.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
        "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
#: Page furniture by tag and role, and by name: words that a class or id ends in, or starts with if only places follow.
FURNITURE = frozenset("head nav header footer aside button select dialog menu object canvas svg audio video map".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
WORDS = frozenset("ad ads adv advert advertisement advertising banner sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus "
                  "cookie cookies consent notice notification promo related recommended share sharing social newsletter subscribe popup modal overlay "
                  "widget toolbar pagination pager sponsor sponsored masthead signup login footer copyright skip".split())
PLACES = frozenset("area bar block box buttons container group inner item items left link links list outer right section top bottom wrap wrapper".split())
#: Words of a class that says what an element has or lacks, not what it is.
STATES = frozenset("has have no not non with without is hide hides hidden show shows free".split())
MAIN = frozenset(("article", "main"))
KEEP = frozenset(("html", "body", "article", "main", "#root"))
#: Pages that a host needs before it has a template.
SUPPORT = 8
#: A class is on one page in so many of its host's, or more.
SHARE = 8
#: Groups that a host's pages meet its template in.
SALTS = 32
mask_numbers = re.compile(r"\d+").sub


@lru_cache(maxsize=1 << 14)
def names_furniture(name: str) -> bool:
    """Whether a whole class or id (in lower case, modifiers after ``--`` apart) is a name of page furniture."""
    words = re.findall("[a-z]+", name.split("--")[0])
    if not words or not STATES.isdisjoint(words):
        return False
    return words[-1] in WORDS or (words[0] in WORDS and all(w in WORDS or w in PLACES for w in words))


class Page:
    """A page's element tree and its blocks of text.

    ``key[i]`` is a hash of element i's path (tags with class and id), which
    tells apart equal tags in different roles; ``blocks`` are (element, text)
    with the innermost element that holds all of the text.  Text in ``banned``
    elements (furniture by tag or role, hidden) is left out piece by piece;
    ``named`` elements are furniture by class or id only, or forms.
    """

    def __init__(self, html: str | None):
        self.key, self.tag, self.parent, self.banned, self.main, self.named = [0], ["#root"], [-1], [False], [False], [False]
        self.blocks: list[tuple[int, str]] = []
        self.order: list[int] = [0]  # elements, and ~i for block i, as they come
        self.open: list[int] = [0]
        self.parts: list[tuple[int, str]] = []  # pieces of the block at hand: element, text
        if html:
            self._read(html)
        self._flush()

    def _read(self, html: str) -> None:
        at = 0
        while m := TOKEN.search(html, at):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"), raw=True)
            elif m[1] or m[4]:
                self._close(tag)
            else:
                attributes = m[3] if m[2] else m[6]
                self._start(tag, attributes or "")
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                    at = end.end() if end else len(html)
                    self._close(tag)
        if at < len(html):
            self._text(html[at:])

    def _text(self, text: str, raw: bool = False) -> None:
        if not self.banned[self.open[-1]]:
            self.parts.append((self.open[-1], text if raw or "&" not in text else markup.unescape(text)))

    def _flush(self) -> None:
        if self.parts:
            words = "".join([t for _, t in self.parts]).split()
            if words:
                nodes = {n for n, t in self.parts if t.strip()}
                while len(nodes) > 1:  # parents come before children
                    low = max(nodes)
                    nodes.remove(low)
                    nodes.add(self.parent[low])
                self.order.append(~len(self.blocks))
                self.blocks.append((nodes.pop(), " ".join(words)))
            self.parts = []

    def _pop(self, count: int) -> None:
        del self.open[len(self.open) - count:]

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self._flush()
            for depth, i in enumerate(reversed(self.open), 1):  # a block ends an open paragraph
                if self.tag[i] == "p":
                    self._pop(depth)
                    break
                if self.tag[i] not in INLINE:
                    break
        elif tag == "br":
            self.parts.append((self.open[-1], " "))
        if tag in ENDS:
            same, until = ENDS[tag]
            for depth, i in enumerate(reversed(self.open), 1):
                if self.tag[i] in until:
                    break
                if self.tag[i] in same:
                    self._pop(depth)
                    if tag != "tr":
                        break
        up = self.open[-1]
        found = {k.lower(): v.strip("\"'") for k, v in NAMED.findall(attributes)} if attributes.strip() else {}
        marks = f"{found.get('class', '')} {found.get('id', '')}".lower()
        style = found.get("style", "").replace(" ", "").lower()
        banned = self.banned[up] or tag in FURNITURE or (tag not in KEEP and (
            found.get("role", "").lower() in ROLES or "hidden" in found
            or found.get("aria-hidden") == "true" or "display:none" in style))
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        self.key.append(xxh64_intdigest(f"{self.key[up]}/{tag}/{marks}") >> 1)
        self.tag.append(tag)
        self.parent.append(up)
        self.banned.append(banned)
        self.named.append(tag == "form" or (tag not in KEEP and any(map(names_furniture, marks.split()))))
        self.main.append(self.main[up] or tag in MAIN or found.get("role", "").lower() == "main")
        self.order.append(len(self.tag) - 1)
        self.open.append(len(self.tag) - 1)

    def _close(self, tag: str) -> None:
        for depth, i in enumerate(reversed(self.open), 1):
            if self.tag[i] == tag and i:
                if tag not in INLINE or any(self.tag[j] not in INLINE for j in self.open[-depth:]):
                    self._flush()
                self._pop(depth)
                return
            if tag in INLINE and self.tag[i] not in INLINE:
                return

    def text_key(self, block: tuple[int, str]) -> int:
        return xxh64_intdigest(f"{self.key[block[0]]}\n{block[1]}") >> 1

    def masked_key(self, block: tuple[int, str]) -> int:
        """The key of the text without its numbers; of a text without any, its own key."""
        masked = mask_numbers("#", block[1])
        return self.text_key(block) if masked == block[1] else self.text_key((block[0], f"#\n{masked}"))

    def up(self, node: int) -> Iterator[int]:
        """The element and those around it, without the root."""
        while node > 0:
            yield node
            node = self.parent[node]

    def articles(self, blocks: list[tuple[int, str]]) -> set[int]:
        """The outermost article and main elements around the blocks."""
        return {n for node, _ in blocks for n in self.up(node) if self.main[n] and not self.main[self.parent[n]]}

    def furniture(self, template: dict[int, bool]) -> set[int]:
        """Elements in furniture by name.

        A name alone does not remove an element with most of the page's text
        (the host's constant texts apart), unless that text is beside the
        page's one article or main element.
        """
        if not any(self.named):
            return set()
        weight: Counter = Counter()
        for node, text in [b for b in self.blocks if self.text_key(b) not in template] or self.blocks:
            for n in self.up(node):
                weight[n] += len(text)
            weight[0] += len(text)
        top = {t for t in self.articles(self.blocks) if not any(self.named[n] for n in self.up(t))}
        around = {n for t in top for n in self.up(t)} if len(top) == 1 else None
        out: set[int] = set()
        for i in range(1, len(self.tag)):
            beside = around is not None and not self.main[i] and i not in around
            if self.parent[i] in out or (self.named[i] and (beside or 2 * weight[i] <= weight[0])):
                out.add(i)
        return out

    def tokens(self) -> list[tuple[int, bool]]:
        """(token, whether it is a text) in page order: tags by path, blocks of text by path and content (also without numbers); 0 is the page."""
        out = []
        for i in self.order:
            if i >= 0:
                out.append((self.key[i], False))
                continue
            block = self.blocks[~i]
            out.append((self.text_key(block), True))
            if (masked := self.masked_key(block)) != self.text_key(block):
                out.append((masked, True))
        return out


def check_page(line: list[int], classes: list[list[int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """What a page has against the classes (lists of tokens in their order): those not ordered on it, and pairs that cross.

    A class is ordered if its tokens come in their order, round by round.  Two
    ordered classes nest if each round of one lies in one gap of a round of the
    other, or outside it."""
    place = {t: (c, k) for c, tokens in enumerate(classes) for k, t in enumerate(tokens)}
    events = [place[t] for t in line if t in place]
    due = [0] * len(classes)
    broken = set()
    for c, k in events:
        if k != due[c]:
            broken.add(c)
        due[c] = (k + 1) % len(classes[c])
    broken.update(c for c, k in enumerate(due) if k)
    crossed, running = set(), []  # running: classes in a round, the innermost last
    for c, k in events:
        if c in broken:
            continue
        if k == 0:
            running.append(c)
        else:
            at = running.index(c)  # rounds that began inside this one's gap and have not ended
            crossed.update((min(c, r), max(c, r)) for r in running[at + 1:])
            running.append(running.pop(at))
        if k == len(classes[c]) - 1:
            running.remove(c)
    return sorted(broken), sorted(crossed)


def nested(classes: list[dict], broken: set[int], crossed: set[tuple[int, int]]) -> list[dict]:
    """The classes that are ordered on every page and nest; of two that cross, the one on more pages (then with more tokens) stays."""
    kept: list[int] = []
    for c in sorted(range(len(classes)), key=lambda c: (-classes[c]["on"], -len(classes[c]["tokens"]), c)):
        if c not in broken and not any((min(c, k), max(c, k)) in crossed for k in kept):
            kept.append(c)
    return [classes[c] for c in kept]


def main_text(page: Page, template: dict[int, bool]) -> str:
    """The blocks of the page's main region, without its furniture and its host's constant texts.

    ``template`` maps the tokens of the host's page class, and the constant texts
    of classes nested in it, to whether they are texts.  The region is the innermost template element that holds every slot:
    every block that is not template (texts that are constant but for their
    numbers are none), in an article element or not.  Without a template it is
    the page's one article or main element, or else the body.
    """
    furniture = page.furniture(template)
    blocks = [b for b in page.blocks if b[0] not in furniture]
    if template:
        slots = [b for b in blocks if page.text_key(b) not in template and page.masked_key(b) not in template]
        held: Counter = Counter()
        for node, _ in slots:
            held.update(page.up(node))
        # elements are numbered in page order, so children come after parents
        root = max((n for n, count in held.items() if count == len(slots) and page.key[n] in template), default=0)

        def within(node: int) -> bool:
            while node > root:
                node = page.parent[node]
            return node == root

        blocks = [b for b in blocks if within(b[0])]
    elif len(top := page.articles(blocks)) == 1:
        blocks = [b for b in blocks if not top.isdisjoint(page.up(b[0]))]
    own = [b for b in blocks if page.text_key(b) not in template]
    if 2 * sum(len(t) for _, t in own) >= sum(len(t) for _, t in blocks):  # else the host's pages are copies of one text
        blocks = own
    return "\n".join(t for _, t in blocks)


def templates(pages: DataFrame) -> DataFrame:
    """``(host, template)`` from ``(page_id, host, html)``: the tokens of the host's nested classes.

    Tokens of a host with the same occurrence vector (how often on which page)
    are one class; a vector is compared by sums of hashes of its entries, so a
    host's pages are combined before and after the shuffle and never meet in
    one place.  A class counts on ``SUPPORT`` pages and a ``SHARE``-th of the
    host's, so all of a host's are at most ``SHARE`` average pages.  The page's
    own class holds the tags and texts that occur once on each page; tags, told
    apart by path, nest it.  The others (records that repeat in a page, parts
    of some pages) are valid if ordered on every page, and nested
    (:func:`check_page`, over the pages' tokens; pages are parsed once).  Of a
    valid class, a text counts whose own element is in the class: it is all
    that this element ever holds.
    """
    lines = materialise(map_columns(pages.where("host is not null"), [F.col("page_id"), F.col("host"), F.col("html")], _page_tokens,
                                    "host string, page_id long, tokens array<struct<token:long,text:boolean,inside:long,n:int,at:int>>, line array<int>"), "page_tokens")
    each = lines.select("host", "page_id", F.explode("tokens").alias("t"))
    entry = F.xxhash64("page_id", "t.n")
    seen = each.groupBy("host", "t.token").agg(
        F.max("t.text").alias("text"), F.max("t.inside").alias("inside"), F.count("*").alias("on"), F.sum("t.at").alias("place"),
        F.sum(entry.bitwiseAND(F.lit(0x7FFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(entry, 33)).alias("high"))
    own = F.xxhash64("page_id", F.lit(1))  # the page's token is once on each
    page = lines.groupBy("host").agg(F.count("*").alias("pages"), F.sum(own.bitwiseAND(F.lit(0x7FFFFFFF))).alias("p_low"), F.sum(F.shiftrightunsigned(own, 33)).alias("p_high"))
    counted = seen.join(page.where(F.col("pages") >= SUPPORT), "host").where((F.col("on") >= SUPPORT) & (F.col("on") * SHARE >= F.col("pages")))
    root = (F.col("on") == F.col("pages")) & (F.col("low") == F.col("p_low")) & (F.col("high") == F.col("p_high"))
    classes = counted.groupBy("host", "on", "low", "high").agg(
        F.first(root).alias("page"), F.array_sort(F.collect_list(F.struct("place", "token", "text", "inside"))).alias("tokens")).where(F.col("page") | (F.size("tokens") > 1))
    classes = materialise(classes.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("on", "low", "high", "page", "tokens"))).alias("classes")), "page_classes")
    others = classes.select("host", F.transform(F.filter("classes", lambda c: ~c["page"]), lambda c: F.transform(c["tokens"], lambda t: t["token"])).alias("others")).where(F.size("others") > 0)
    checked = map_columns(_with_host(lines, others, "page_id"), [F.col("host"), F.col("tokens.token"), F.col("line"), F.col("others")], _page_faults,
                          "host string, broken array<int>, crossed array<struct<a:int,b:int>>").where("size(broken) + size(crossed) > 0")
    broken = checked.select("host", F.explode("broken").alias("c")).groupBy("host").agg(F.collect_set("c").alias("broken"))
    crossed = checked.select("host", F.explode("crossed").alias("c")).groupBy("host").agg(F.collect_set("c").alias("crossed"))
    joined = classes.join(broken, "host", "left").join(crossed, "host", "left")
    return map_columns(joined, [F.col("host"), F.col("classes"), F.col("broken"), F.col("crossed")], _host_templates,
                       "host string, template array<struct<token:long,text:boolean>>")


def _with_host(rows: DataFrame, table: DataFrame, *by: str, how: str = "inner") -> DataFrame:
    """``rows`` with their host's row of ``table``, which goes to every salt, so that the pages of one host are spread over as many groups."""
    known = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).join(known, ["host", "salt"], how)


def _page_tokens(columns):
    tokens, lines = [], []
    for html in columns[2]:
        page = Page(html)
        found: dict[int, dict] = {}
        line = []
        for at, (token, text) in enumerate(page.tokens()):
            t = found.setdefault(token, {"token": token, "text": text, "inside": None, "n": 0, "at": at, "id": len(found)})
            t["n"] += 1
            line.append(t["id"])
        for block in page.blocks:
            for token in (page.text_key(block), page.masked_key(block)):
                found[token]["inside"] = page.key[block[0]]
        tokens.append([{k: v for k, v in t.items() if k != "id"} for t in found.values()])
        lines.append(line)
    return [columns[1], columns[0], tokens, lines]


def _page_faults(columns):
    found = [check_page([tokens[i] for i in line], classes) for tokens, line, classes in zip(*columns[1:])]
    return [columns[0], [b for b, _ in found], [[{"a": x, "b": y} for x, y in c] for _, c in found]]


def _host_templates(columns):
    out = []
    for classes, broken, crossed in zip(*columns[1:]):
        others = nested([c for c in classes if not c["page"]], set(broken or ()), {(c["a"], c["b"]) for c in crossed or ()})
        template = [t for c in classes if c["page"] for t in c["tokens"]]
        for c in others:
            held = {t["token"] for t in c["tokens"] if not t["text"]}
            template += [t for t in c["tokens"] if t["text"] and t["inside"] in held]
        out.append([{"token": t["token"], "text": t["text"]} for t in template])
    return [columns[0], out]


def _page_texts(columns):
    texts = []
    for html, template in zip(columns[2], columns[3]):
        texts.append(main_text(Page(html), {t["token"]: t["text"] for t in template or ()}))
    return [columns[0], columns[1], texts, [len(t) for t in texts]]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row.

    Blocks are trimmed, white space in them becomes one space, character
    references are decoded; they are joined in page order by a newline.  Null
    or empty pages give an empty text; a page without a host (null url) is read
    without a template; repeated rows come back as often (and count as often in
    their host's vectors); other columns are ignored; an empty table gives none.
    """
    host = F.lower(F.regexp_extract(url_col, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.nullif(host, F.lit("")).alias("host"), F.col(html_col).alias("html"))
    both = _with_host(rows, templates(rows), "page_id", "url", how="left")
    return map_columns(both, [F.col("page_id"), F.col("url"), F.col("html"), F.col("template")], _page_texts,
                       "page_id long, url string, text string, n_chars long")
