"""Byte-level BPE: merges from priority queues over linked symbol lists, and decoding.

Most pieces of a corpus are rare, so that no bounded cache holds them: the
pieces that a lot of texts needs and the cache lacks are merged together, each
with its own queue and list, as columns of a few arrays.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import map_columns

#: The byte-level pre-tokeniser's split rule (fixed value).
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space before white space or the end; this ``\s`` holds all that the split rule's holds.
find_run = re.compile(r" (?:\s|\Z)").search


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


#: Strings, and every eighth character of the texts, that are looked up together.
LOT = 1 << 16
#: Bytes of the pieces that are merged together, by powers of 2 up to the last; longer ones have a heap each.
WIDTHS = (8, 16, 32, 64)
#: Cells of the arrays that hold such pieces.
CELLS = 1 << 18

Cut = list[tuple[dict, list[str]]]


class Known(dict):
    """Bounded cache string -> token ids; two generations of at most ``limit`` strings each, and a lot.

    Ids are kept as the bytes of an int32 array: a tuple takes five times the
    memory, and Python's garbage collector goes through all tuples again and again.
    """

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.older = encode, limit, {}

    def fill(self, wanted: set[str]) -> None:
        """Hold all that is wanted; what neither generation knows is encoded together."""
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        missing = [*filterfalse(self.__contains__, wanted)]
        new = [*filterfalse(self.older.__contains__, missing)]
        self.update({s: self.older[s] for s in filter(self.older.__contains__, missing)})
        self.update(zip(new, self.encode(new)))

    def look_up(self, strings: list[str]) -> Iterator[bytes]:
        """The ids of each string; a lot at a time is looked up, and encoded if unknown."""
        for a in range(0, len(strings), LOT):
            lot = strings[a:a + LOT]
            self.fill(set(lot))
            yield from map(self.__getitem__, lot)


class PairRanks:
    """Rank of a pair of symbols, for arrays of pairs: a hash table with linear probing."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ranks: list[dict[int, int]]):
        """``none``, the symbol after the last, is in no pair; ``missing`` is the rank of other pairs."""
        self.none = len(ranks)
        pairs = [(left * (self.none + 1) + right, r) for left, of in enumerate(ranks) for right, r in of.items()]
        self.missing = 1 + max((r for _, r in pairs), default=0)
        bits = (4 * len(pairs) + 1).bit_length()
        self.shift = np.uint64(64 - bits)
        codes, rank = [-1] * ((1 << bits) + len(pairs) + 1), [self.missing] * ((1 << bits) + len(pairs) + 1)
        for at, (code, r) in zip(self.slots(np.array([c for c, _ in pairs], np.int64)).tolist(), pairs):
            while codes[at] >= 0:
                at += 1
            codes[at], rank[at] = code, r
        self.codes, self.rank = np.array(codes, np.int64), np.array(rank, np.int32)

    def slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * self.FACTOR >> self.shift).view(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left.astype(np.int64) * (self.none + 1) + right
        at = self.slots(code)
        found = self.codes[at]
        rank = np.where(found == code, self.rank[at], self.missing)
        rest = np.flatnonzero((found != code) & (found >= 0))
        while len(rest):
            at[rest] += 1
            found = self.codes[at[rest]]
            hit = found == code[rest]
            rank[rest[hit]] = self.rank[at[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return rank


class ByteBPE:
    """Encoder and decoder of a byte-level BPE vocabulary (the text of its JSON file).

    Added tokens found in a text become their own id, as the file states them;
    the rest is split into pieces and each piece's bytes are merged.
    """

    def __init__(self, definition: str, cache: int = 120_000):
        file = json.loads(definition)
        vocab, letters = file["model"]["vocab"], byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in s) for s, i in vocab.items()}
        self.first = [0] * 256
        for c, b in letters.items():
            self.first[b] = vocab[c]
        self.ranks: list[dict[int, int]] = [{} for _ in range(1 + max(vocab.values()))]  # left id -> right id -> rank
        self.rules = []  # by rank: left, right and merged id
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rules.append((vocab[left], vocab[right], vocab[left + right]))
            self.ranks[vocab[left]].setdefault(vocab[right], rank)
        self.pair_ranks = PairRanks(self.ranks)
        self.first_symbols = np.array(self.first, np.int32)
        self.merged = np.array([m for _, _, m in self.rules], np.int32)
        self.added = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        self.special = {s: np.int32(i).tobytes() for s, i in self.added.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.find_pieces = regex.compile(PIECE).findall
        self.pieces = Known(self.encode_pieces, cache // 3)
        self.spaced = Known(self.encode_spaced, cache)

    def encode_piece(self, piece: str) -> bytes:
        """Merge the lowest rank first, the leftmost among equals, until no pair has a rank.

        One piece of any length, by a heap that may hold stale entries.
        """
        symbol = [self.first[b] for b in piece.encode()]
        n, ranks, rules = len(symbol), self.ranks, self.rules
        # one number an entry: the rank, then the place (a rank names its two symbols)
        queue = [r * n + i for i in range(n - 1) if (r := ranks[symbol[i]].get(symbol[i + 1])) is not None]
        if not queue:
            return np.array(symbol, np.int32).tobytes()
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            rank, i = divmod(heappop(queue), n)
            left, right, merged = rules[rank]
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # stale: one of the two has been merged since
            symbol[i], symbol[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks[merged].get(symbol[k])) is not None:
                    heappush(queue, r * n + i)
            if (h := before[i]) >= 0 and (r := ranks[symbol[h]].get(merged)) is not None:
                heappush(queue, r * n + h)
        return np.array([s for s in symbol if s >= 0], np.int32).tobytes()

    def merge(self, raw: list[bytes], width: int) -> Iterator[bytes]:
        """The same for pieces of at most ``width`` bytes at a time, a column each.

        Row 0 and the last are the ends of the lists; a place's entry in the
        queue (its pair's rank, then its row) is replaced when its pair changes.
        """
        n, rows, none, missing = len(raw), width + 2, self.pair_ranks.none, self.pair_ranks.missing
        bits = rows.bit_length()
        symbol = np.full((rows, n), none, np.int32)
        symbol[1:-1] = self.first_symbols[np.frombuffer(b"".join([r.ljust(width) for r in raw]), np.uint8).reshape(n, width).T]
        symbol[1:-1][np.arange(width)[:, None] >= np.fromiter(map(len, raw), np.int64, n)] = none
        entry = np.full((rows, n), missing, np.int64)
        entry[:-1] = self.pair_ranks(symbol[:-1].ravel(), symbol[1:].ravel()).reshape(rows - 1, n)
        entry = entry << bits | np.arange(rows)[:, None]
        queue, symbols = entry.ravel(), symbol.ravel()
        after, before = np.arange(n, n * rows + n), np.arange(-n, n * rows - n)
        while True:
            lowest = entry.min(axis=0)
            column = np.flatnonzero(lowest < missing << bits)
            if not len(column):
                break
            lowest = lowest[column]
            row, merged = lowest & (1 << bits) - 1, self.merged[lowest >> bits]
            at = row * n + column
            gone, left = after[at], before[at]
            right = after[gone]
            symbols[at], symbols[gone] = merged, none
            after[at], before[right] = right, at
            queue[gone] = missing << bits
            queue[at] = self.pair_ranks(merged, symbols[right]).astype(np.int64) << bits | row
            queue[left] = self.pair_ranks(symbols[left], merged).astype(np.int64) << bits | left // n
        symbol = symbol[1:-1].T
        stays = symbol != none
        ids, ends = symbol[stays].tobytes(), (4 * stays.sum(axis=1).cumsum()).tolist()
        return (ids[a:b] for a, b in zip([0, *ends], ends))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list = [None] * len(raw)
        for narrower, width in zip((0, *WIDTHS), WIDTHS):
            chosen = np.flatnonzero((size > narrower) & (size <= width)).tolist()
            step = CELLS // (width + 2)
            for a in range(0, len(chosen), step):
                for i, ids in zip(chosen[a:a + step], self.merge([raw[i] for i in chosen[a:a + step]], width)):
                    out[i] = ids
        for i in np.flatnonzero(size > WIDTHS[-1]).tolist():
            out[i] = self.encode_piece(pieces[i])
        return out

    def encode_spaced(self, words: list[str]) -> Iterator[bytes]:
        """Words with the space before them."""
        pieces: list[str] = []
        ends = [0]
        for i, word in enumerate(words, 1):
            pieces += self.find_pieces(" " + word)
            ends.append(len(pieces))
            if len(pieces) >= LOT or i == len(words):
                ids = [*self.pieces.look_up(pieces)]
                yield from [ids[a] if b == a + 1 else b"".join(ids[a:b]) for a, b in zip(ends, ends[1:])]
                pieces, ends = [], [0]

    def cut(self, text: str | None) -> Cut:
        """The strings of a text in order, with the cache to look them up in.

        A piece goes on over a space only inside a run of white space, so that a text
        whose spaces are all followed by something else can be cut before every space."""
        out: Cut = []
        if not text:
            return out
        for part in self.split_added.split(text) if any(a in text for a in self.added) else [text]:
            if part in self.added:
                out.append((self.special, [part]))
            elif find_run(part):
                out.append((self.pieces, self.find_pieces(part)))
            else:
                first, *words = part.split(" ")
                out += [(self.pieces, self.find_pieces(first)), (self.spaced, words)]
        return out

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; a lot of strings at a time is looked up, and encoded if unknown."""
        waiting: list[list[bytes]] = []
        lot: list[tuple[list[bytes], dict, list[str]]] = []
        size = 0

        def finish():
            for cache in (self.spaced, self.pieces):
                wanted = [strings for _, c, strings in lot if c is cache]
                if wanted:
                    cache.fill(set().union(*wanted))
            for ids, cache, strings in lot:
                ids.append(b"".join(map(cache.__getitem__, strings)))
            lot.clear()

        for text in texts:
            waiting.append(ids := [])
            for cache, strings in self.cut(text):
                for a in range(0, len(strings), LOT):
                    lot.append((ids, cache, strings[a:a + LOT]))
                    size += len(lot[-1][2])
                    if len(lot[-1][2]) == LOT:
                        finish()
                        size = 0
            size += len(text or "") >> 3
            if size >= LOT:
                finish()
                size = 0
            if not lot:
                yield from (np.frombuffer(b"".join(ids), np.int32) for ids in waiting)
                waiting = []
        finish()
        yield from (np.frombuffer(b"".join(ids), np.int32) for ids in waiting)

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text])).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary strings of ``ids``, concatenated; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, ByteBPE] = {}


def _tokenizer(definition: str) -> ByteBPE:
    """One tokenizer per Python worker: its cache outlives the task."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(definition)
    return _LOADED[key]


def _definition(docs: DataFrame, path: str):
    """The vocabulary file (a few MB whatever the data) as a broadcast variable."""
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` for every row; a null or empty text has no ids."""
    definition = _definition(docs, path)

    def run(c):
        bpe = _tokenizer(definition.value)
        return [c[0], [*bpe.encode_all(c[1])]]

    return map_columns(docs, [F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")], run,
                       "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` for every row of token ids; null ids give an empty text."""
    definition = _definition(rows, path)

    def run(c):
        bpe = _tokenizer(definition.value)
        return [c[0], [bpe.decode(i or ()) for i in c[1]]]

    return map_columns(rows, [F.col(id_col).alias("doc_id"), F.col(ids_col).alias("i")], run,
                       "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row, encoded and decoded again.

    ``with_ids`` adds the ids themselves.  Null and empty texts have no tokens
    and the digests of nothing.  Repeated rows come back as often; other
    columns are ignored; a null id stays null.  One narrow stage: texts never
    shuffle, and only a bounded cache of pieces is kept between rows.
    """
    definition = _definition(docs, path)

    def run(c):
        bpe = _tokenizer(definition.value)
        number = {i: str(i) for i in bpe.bytes_of}
        sha = hashlib.sha256
        out: list[list] = [[], [], [], []]
        for array in bpe.encode_all(c[1]):
            ids = array.tolist()
            out[0].append(len(ids))
            out[1].append(sha(",".join(map(number.__getitem__, ids)).encode()).hexdigest())
            out[2].append(sha(bpe.decode(ids).encode()).hexdigest())
            if with_ids:
                out[3].append(array)
        return [c[0], *out[:4 if with_ids else 3]]

    return map_columns(docs, [F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")], run,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
