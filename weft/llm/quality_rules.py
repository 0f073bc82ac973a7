"""Quality rules whose cutoffs are certified on labelled documents by exact binomial bounds."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import map_columns, materialise

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CELLS = 200
#: Rule -> value in [0, 1] of which a document is rejected if it lies above the cutoff; no cutoff goes below the floor.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", 0.1),
    "repeated_words": ("n_repeat_words / greatest(n_words, 1)", 0.3),
    "repeated_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.3),
    "long_words": ("least(word_chars / greatest(n_words, 1) / 40, 1)", 0.3),
    "short_words": ("1 - least(word_chars / greatest(n_words, 1) / 10, 1)", 0.7),
}


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, the first included."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * len(known) + ids[2:]
    _, of, count = np.unique(window, return_inverse=True, return_counts=True)
    often = count[of] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= often
    return int(inside.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows, lines with a word."""
    if not text:
        return (0,) * 6
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return (len(words), len(text) - (len(raw) - len(raw.translate(None, SPACES))),
            len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines))


def with_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """``(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed)`` for every row."""
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit(None).cast("string")
    found = map_columns(docs, [F.col(id_col).alias("doc_id"), stratum.alias("s"), F.col(text_col).alias("t")],
                        lambda c: [c[0], c[1], *map(list, zip(*map(measures, c[2])))],
                        "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                        "n_repeat_words long, n_lines long")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def _tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exactly: the regularised incomplete beta function at 1 - p.

    Its continued fraction takes about sqrt(n) steps, so that any number of labels is affordable.
    """
    if k >= n:
        return 1.0
    a, b, x = float(n - k), k + 1.0, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        a, b, x = b, a, p
    tiny, c, d = 1e-300, 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1))
    total, m = d, 0
    while True:
        m += 1
        before = total
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / ((1.0 + term * d) or tiny)
            c = (1.0 + term / c) or tiny
            total *= d * c
        if abs(total / before - 1) < 1e-13:
            break
    part = front * total / a
    return 1 - part if swap else part


def certified_cutoff(rejected: list[int], good: int, limit: float, error: float, floor: int = 0) -> int:
    """The tightest cell whose false-rejection rate is below ``limit`` with confidence 1 - ``error``.

    ``rejected[c]`` counts the good documents above cell c.  Cells are tested
    from the loosest down by the exact binomial bound, up to the first that
    fails: a fixed sequence, which needs no further correction.
    """
    cut = CELLS
    for cell in range(CELLS, floor - 1, -1):
        k = rejected[cell]
        if good == 0 or k > limit * good or _tail(k, good, limit) > error:
            break
        cut = cell
    return cut


def fit_cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05,
                id_col: str = "doc_id", label_col: str = "quality") -> list[tuple[str | None, str, float]]:
    """``(stratum, rule, cutoff)``: certified on every labelled good document that passes the base rules.

    Of a stratum's good documents, all rules together reject more than
    ``alpha`` with a probability under ``delta`` over all strata: the rules are
    tightened together, in ``CELLS`` steps from the top to their floors, and
    tested by the documents that any of them rejects; delta is shared out among
    strata (Bonferroni).  A stratum with too few labels gets no cutoff below the
    top, so nothing of it is rejected.  Labels are made unique by id (null ids
    left out; a document labelled both ways counts as good).  What comes to the
    driver is a histogram of strata x 201 steps.
    """
    counts = _histogram(measured, labels, id_col, label_col)
    strata = {s for s, _ in counts}
    found = []
    for s in sorted(strata, key=lambda x: (x is None, x or "")):
        by = [counts.get((s, step), 0) for step in range(-1, CELLS)]
        above = [*np.cumsum(by[:0:-1])[::-1].tolist(), 0]
        cut = certified_cutoff(above, sum(by), alpha, delta / len(strata))
        found += [(s, rule, _cell(rule, cut) / CELLS) for rule in RULES]
    return found


def _cell(rule: str, step: int) -> int:
    """The rule's cutoff at a step: the floor at step 0, the top at the last."""
    floor = round(RULES[rule][1] * CELLS)
    return floor - (floor - CELLS) * step // CELLS


def _histogram(measured: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> dict[tuple[str | None, int], int]:
    """(stratum, the loosest step at which a rule rejects it) -> good documents; -1 if none does.

    A document above its rule's floor is rejected at that step and all tighter
    ones (``_cell`` solved for the step).
    """
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("doc_id")).where("doc_id is not null").distinct()
    rows = measured.where(~F.col("base_failed")).join(good, "doc_id")
    steps = []
    for value, floor in RULES.values():
        low = round(floor * CELLS)
        over = F.ceil(F.expr(value) * CELLS) - low - 1
        steps.append(F.when(over >= 0, F.floor(over * CELLS / (CELLS - low))).otherwise(-1))
    rows = rows.select("stratum", F.greatest(*steps).cast("int").alias("step")).groupBy("stratum", "step").count()
    return {(r["stratum"], r["step"]): r["count"] for r in rows.collect()}


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """Every row's measures, ``base_failed`` and ``kept``; ``failed_rules`` names what rejected it.

    ``kept`` is false for base failures, else unless a certified rule of the
    row's stratum rejects it.  Null and empty texts have no words and fail the
    base rules.  Null strata are a stratum.  Repeated rows come back as often,
    null ids are judged like others, other columns are ignored; empty tables
    give no rows (no labels: nothing beyond the base rules is rejected).
    """
    measured = materialise(with_measures(docs, id_col, text_col, stratum_col), "measures")
    cutoffs = [c for c in fit_cutoffs(measured, labels, alpha, delta, id_col) if c[2] < 1]
    hits = [F.when(F.col("stratum").eqNullSafe(F.lit(s)) & (F.ceil(F.expr(RULES[rule][0]) * CELLS) > round(cut * CELLS)), F.lit(rule))
            for s, rule, cut in cutoffs]
    failed = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return (measured.withColumn("failed_rules", F.concat_ws(",", failed))
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")))
