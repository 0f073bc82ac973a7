"""Periodic runs of words: seed and extend along diagonals.

A run is a stretch of words with smallest period ``q`` and a length of at
least ``max(min_length, min_exponent * q)`` that no neighbour extends.  On the
diagonal of lag ``q`` it is a stretch of at least that length less ``q`` where
a word equals the one ``q`` further on.  Periods go by scales: for all periods
of a scale the guaranteed stretch is at least ``k`` words, and none is longer
than ``k``.  The scale's seeds are k-grams that occur again.  Inside a run the
next occurrence of a k-gram is exactly one period on (nearer ones would give a
smaller period, as k reaches over the period), so it is enough to pair each
occurrence with the next: pairs are as many as words, not their square.  Each
seed is extended both ways on its diagonal; a table of the furthest place
covered on each lag keeps seeds of the same stretch from being extended again.

k-grams are named exactly, without hashing, by doubling: a name for each
distinct pair of names of half the length.  Places whose gram occurs once drop
out of all longer grams, so prose without repeats ends after a few words.

Texts are read whole, one at a time in a task; the state of a text is some
integers a word and its distinct words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import map_columns

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
PIECE = 1 << 20


def scales(n: int, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """``(lowest period, highest period, k)`` for all periods that fit in ``n`` words."""
    found, low = [], 1
    while max(min_length, min_exponent * low) <= n:
        high, k = low, max(min_length, min_exponent * low) - low
        while high < n:
            least = min(k, max(min_length, min_exponent * (high + 1)) - high - 1)
            if least < high + 1:
                break
            high, k = high + 1, least
        found.append((low, high, k))
        low = high + 1
    return found


class Grams:
    """Names of the grams of a sequence, by doubling; -1 where a gram occurs once or runs over the end."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.names, self.size = ids, ids.copy(), 1
        self.names[np.bincount(ids, minlength=1)[ids] < 2] = -1

    def _pairs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose ``k``-gram may occur twice, and its key: names of its first and last ``size`` words."""
        shift, names = k - self.size, self.names
        at = np.flatnonzero((names[:len(names) - shift] >= 0) & (names[shift:] >= 0)) if k <= len(names) else np.empty(0, np.int64)
        return at, names[at] * (len(names) + 1) + names[at + shift]

    def grow(self, k: int) -> None:
        """Name grams of the largest doubled size up to ``k``."""
        while self.size * 2 <= k and self.size:
            at, key = self._pairs(self.size * 2)
            distinct, name, count = np.unique(key, return_inverse=True, return_counts=True)
            name[count[name] < 2] = -1
            self.names = np.full(len(self.names), -1)
            self.names[at] = name
            self.size *= 2

    def next_pairs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Each occurrence of a ``k``-gram with the next one, by place."""
        at, key = self._pairs(k)
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        first, then = at[order[same]], at[order[same + 1]]
        by_place = np.argsort(first)
        return first[by_place], then[by_place]


def extend(ids: np.ndarray, start: int, stop: int, lag: int) -> tuple[int, int]:
    """The longest ``[start, stop)`` around the given one where each word equals the one ``lag`` on."""
    step = 64
    while start > 0 and ids[start - 1] == ids[start - 1 + lag]:
        low = max(0, start - step)
        differ = np.flatnonzero(ids[low:start] != ids[low + lag:start + lag])
        start, step = (low + int(differ[-1]) + 1 if len(differ) else low), step * 2
        if len(differ):
            break
    step = 64
    while stop + lag < len(ids) and ids[stop] == ids[stop + lag]:
        high = min(len(ids) - lag, stop + step)
        differ = np.flatnonzero(ids[stop:high] != ids[stop + lag:high + lag])
        stop, step = (stop + int(differ[0]) if len(differ) else high), step * 2
        if len(differ):
            break
    return start, stop


def runs_of(ids: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, by start, then period."""
    found, grams = [], Grams(ids)
    for low, high, k in scales(len(ids), min_length, min_exponent):
        grams.grow(k)
        if not (grams.names >= 0).any():
            break
        first, then = grams.next_pairs(k)
        lag = then - first
        fits = (lag >= low) & (lag <= high)
        first, lag = first[fits], lag[fits]
        # neighbouring seeds of one lag overlap: only the first of each row of them is looked up in the table
        leads = np.flatnonzero((np.diff(first, prepend=-2) != 1) | (np.diff(lag, prepend=-1) != 0))
        covered: dict[int, int] = {}
        for place, q in zip(first[leads].tolist(), lag[leads].tolist()):
            if place < covered.get(q, 0):
                continue
            start, stop = extend(ids, place, place + k, q)
            covered[q] = stop
            length = stop + q - start
            if length >= max(min_length, min_exponent * q):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Word numbers of a text and the distinct words: maximal rows of bytes other than space and tab to carriage return."""
    known: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(text):
        stop = at + PIECE
        while stop < len(text) and text[stop] not in b" \t\n\v\f\r":
            stop += 1
        parts.append(np.array([known.setdefault(w, len(known)) for w in text[at:stop].split()], np.int64))
        at = stop
    return np.concatenate(parts) if parts else np.empty(0, np.int64), list(known)


def collapse(ids: np.ndarray, words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stand in no run after its first period, joined by one space."""
    if runs:
        edge = np.zeros(len(ids) + 1, np.int64)
        for start, length, q in runs:
            edge[start + q] += 1
            edge[start + length] -= 1
        ids = ids[np.cumsum(edge[:-1]) == 0]
    return b" ".join([b" ".join(map(words.__getitem__, ids[i:i + PIECE].tolist())) for i in range(0, len(ids), PIECE)])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``: all periodic runs of each text, and the text with each run cut to its first period.

    ``runs`` is sorted by start, then period; ``collapsed`` is UTF-8 bytes.  A
    null, empty or blank text has no words, no runs and an empty rest.  Repeated
    rows and null ids are rows like others; other columns are ignored; an empty
    table gives no rows.  ``min_exponent`` is at least 2.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("min_exponent and min_length must be at least 2")

    def run(columns):
        numbers, texts = columns
        counts, runs, rest = [], [], []
        for text in texts:
            ids, words = words_of(text or b"")
            own = runs_of(ids, min_length, min_exponent)
            counts.append(len(ids))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
            rest.append(collapse(ids, words, own))
        return [numbers, counts, runs, rest]

    return map_columns(docs, [F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")],
                       run, f"id long, n_words long, runs {RUNS}, collapsed binary").withColumnRenamed("id", id_col)
