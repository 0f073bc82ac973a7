"""Text cleaning and extraction as Column expressions.

Everything is a built-in string/regex/array function, so cleaning runs in
the JVM and needs no shuffle (array lambdas are interpreted, the rest is
generated code).  Character classes
are written out so Spark (Java regex) and DuckDB (RE2) agree: Python's
``\\s`` on text is the Unicode whitespace set below, and ``.`` excludes
only ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str whitespace (what ``\s`` matches in the reference).
WS_CHARS = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"

LINK = f"https?://{NOT_WS}+"
RETWEET = f"^RT{WS}+"
MENTION = f"@[^\\n]*?{WS}"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
DIGITS = r"\p{Nd}+"

# The English stop-word list used by the reference's tweet
# cleaner (NLTK's English list, 179 words, case-sensitive).
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn "
    "mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't "
    "wouldn wouldn't"
).split()

# Translation results treated as failures.
TRANSLATION_PLACEHOLDERS = ("", "翻译数据正在路上...", "对不起，我正在学习该语种中")
# Key substrings that exempt a turn from the word-count rule.
ALLOWED_KEY_SUBSTRINGS = ("dany", "霍金")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_amp(c) -> Column:            # C2
    return F.replace(_c(c), F.lit("&amp;"), F.lit(" "))


def remove_links(c) -> Column:          # C3
    return F.regexp_replace(_c(c), LINK, " ")


def remove_hashes(c) -> Column:         # C4
    return F.replace(_c(c), F.lit("#"), F.lit(" "))


def remove_retweets(c) -> Column:       # C5
    return F.regexp_replace(_c(c), RETWEET, " ")


def remove_mentions(c) -> Column:       # C6
    return F.regexp_replace(_c(c), MENTION, " ")


def collapse_spaces(c) -> Column:       # C7
    return F.regexp_replace(_c(c), f"{WS}+", " ")


def remove_punctuation(c) -> Column:    # C8
    return F.translate(_c(c), PUNCTUATION, "")


def lowercase(c) -> Column:             # C10
    return F.lower(_c(c))


def remove_numbers(c) -> Column:        # C10
    return F.regexp_replace(_c(c), DIGITS, " ")


def word_tokens(c, collapsed: bool = False) -> Column:
    """Whitespace word tokens (empty pieces dropped).  ``collapsed`` text
    holds single spaces only, so a literal split (Java's fast path) suffices."""
    pattern = " " if collapsed else f"{WS}+"
    return F.filter(F.split(_c(c), pattern), lambda t: t != "")


def drop_stop_words(tokens: Column, stop_words=STOP_WORDS) -> Column:   # C9
    """Keep order and duplicates (unlike array_except).  ``isin`` over the
    literal list becomes a hash-set lookup (InSet) instead of a linear scan."""
    words = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(*words))


def strip_ws(c) -> Column:
    return F.regexp_replace(_c(c), f"^{WS}+|{WS}+\\z", "")


def clean_tweet(c, lower: bool = False, numbers: bool = False, stop_words=STOP_WORDS) -> Column:
    """Amp, links, hashes, leading RT, mentions, whitespace, (lowercase),
    punctuation, (numbers), tokens, stop words, join, strip."""
    x = collapse_spaces(remove_mentions(remove_retweets(remove_hashes(remove_links(remove_amp(c))))))
    if lower:
        x = lowercase(x)
    x = remove_punctuation(x)
    if numbers:
        x = remove_numbers(x)
    return strip_ws(F.array_join(drop_stop_words(word_tokens(x, collapsed=True), stop_words), " "))


def split_links(c) -> Column:
    """C11: ARRAY of the leading text and each ``http...`` piece (use
    ``posexplode`` for one row per piece)."""
    parts = F.split(_c(c), "http", -1)
    return F.transform(parts, lambda x, i: F.when(i > 0, F.concat(F.lit("http"), x)).otherwise(x))


def extract_tagged(c, kind: str = "student") -> Column:
    """First ``<kind>...</kind>`` body on one line (greedy), stripped;
    if none, the text with the tags, dialog tags and ':' removed."""
    pat = f"<{kind}>([^\\n]*)</{kind}>"
    x = _c(c)
    found = strip_ws(F.regexp_extract(x, pat, 1))
    fallback = x
    for tag in (f"<{kind}>", f"</{kind}>", "</dialog>", "<dialog>", ":"):
        fallback = F.replace(fallback, F.lit(tag), F.lit(""))
    return F.when(x.rlike(pat), found).otherwise(fallback)


def cut_response(c, num_rounds, end_marker: str = "<|endoftext|></s>", turn_marker: str = "Human: ") -> Column:
    """Drop the end marker; cut before the (num_rounds+1)-th turn marker."""
    n = num_rounds if isinstance(num_rounds, Column) else F.lit(num_rounds)
    out = F.replace(_c(c), F.lit(end_marker), F.lit(""))
    return F.call_function("substring_index", out, F.lit(turn_marker), (n + 1).cast("int"))


def after_last(c, marker: str) -> Column:
    """C14: text after the last marker (whole text when absent)."""
    return F.element_at(F.split(_c(c), "\\Q" + marker + "\\E", -1), -1)


def after_last_api(c, marker: str = "<|assistant|>: ", drop_tail: int = 8) -> Column:
    """C14 (API variant): after the last marker, minus the last ``drop_tail`` characters."""
    x = after_last(c, marker)
    return F.when(F.length(x) > drop_tail, F.substring(x, 1, F.length(x) - drop_tail)).otherwise(F.lit(""))


def judge_line_pattern(n_models: int = 2) -> str:
    body = ",  ".join(f"model{j + 1} score: ([0-9]+)" for j in range(n_models))
    return f"Question ([0-9]+): {body}"


def word_count(c) -> Column:
    return F.size(word_tokens(c))


def turn_passes(m, allow_keys=ALLOWED_KEY_SUBSTRINGS) -> Column:
    """every value has more than one word, or a key contains an
    allow-listed substring."""
    m = _c(m)
    ok_values = F.forall(F.map_values(m), lambda v: word_count(v) > 1)
    allowed = F.lit(False)
    for s in allow_keys:
        allowed = allowed | _key_contains(m, s)
    return ok_values | allowed


def _key_contains(m: Column, s: str) -> Column:
    return F.exists(F.map_keys(m), lambda k: k.contains(s))
