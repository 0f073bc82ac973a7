"""Language-model scores from a sharded Elias-Fano bigram trie with quantised smoothed probabilities."""

from __future__ import annotations

import mmap
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from weft.llm.blocks import ARROW_MESSAGE, MESSAGE, U, mix, pack, pack_documents, read_block, run_of, runs, steps, to_batches, unpack
from weft.llm.common import give_back, materialise, training_row

#: Stands for the end of a document; it holds white space, so no word is like it.
END = b"\n"
#: Probabilities are kept as steps of this many in -log10, in 16 bits.
STEP = 0.01


# ---- Elias-Fano -------------------------------------------------------------------------------------

def encode_monotone(values: np.ndarray) -> bytes:
    """A non-decreasing sequence: low bits packed side by side, high bits in unary."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    parts = []
    for at in range(0, n if low else 0, 1 << 16):  # a multiple of eight entries fills whole bytes
        bits = ((values[at:at + (1 << 16), None] >> np.arange(low, dtype=U)) & U(1)).astype(np.uint8)
        parts.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    lows = b"".join(parts)
    lows += bytes(-len(lows) % 8)
    unary = np.zeros((top >> low) + n + 1, np.uint8)
    unary[(values >> U(low)).astype(np.int64) + np.arange(n)] = 1
    highs = np.packbits(unary, bitorder="little").tobytes()
    highs += bytes(-len(highs) % 8)
    return np.array([n, low, len(lows), len(highs)], "<i8").tobytes() + lows + b"\0" * 8 + highs


def _bit(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the one with ``rank`` ones below it in each word, by halves."""
    at = np.zeros(len(words), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & U((1 << width) - 1))
        up = rank >= below
        rank = rank - below * up
        shift = up * np.int64(width)
        words = words >> shift.astype(U)
        at += shift
    return at


class Monotone:
    """Reads an encoded sequence from a (memory-mapped) buffer, many places at a time.

    The bits stay packed; beside them stand the ones and the zeros before each
    word of 64 high bits, at most a byte an entry.
    """

    def __init__(self, buffer: np.ndarray):
        self.n, self.low, lows, highs = buffer[:32].view("<i8").tolist()
        self.lows = buffer[32:32 + lows + 8].view("<u8")
        self.length = 32 + lows + 8 + highs
        self.words = buffer[self.length - highs:self.length].view("<u8")
        self.ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.zeros = 64 * np.arange(1, len(self.words) + 1) - self.ones
        #: high parts are below this
        self.parts = 64 * len(self.words) - self.n

    def low_bits(self, at: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(at), U)
        bit = at.astype(np.int64) * self.low
        word, shift = bit >> 6, (bit & 63).astype(U)
        return (self.lows[word] >> shift | self.lows[word + 1] << U(1) << (U(63) - shift)) & U((1 << self.low) - 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        at = at.astype(np.int64)
        word = np.searchsorted(self.ones, at, "right")
        high = self.words[word]
        rank = at - self.ones[word] + np.bitwise_count(high)
        return ((64 * word + _bit(high, rank) - at).astype(U) << U(self.low)) | self.low_bits(at)

    def up_to(self, part: np.ndarray) -> np.ndarray:
        """How many entries have a high part of ``part`` at most: the ones before the zero that ends it."""
        word = np.searchsorted(self.zeros, part, "right")
        low = ~self.words[word]
        rank = part - self.zeros[word] + np.bitwise_count(low)
        return 64 * word + _bit(low, rank) - part

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The first place whose value is at least x (n if there is none)."""
        part = (x >> U(self.low)).astype(np.int64)
        beyond = part >= self.parts
        part = np.where(beyond, 0, part)
        end = self.up_to(part)
        at = np.where(part > 0, self.up_to(np.maximum(part - 1, 0)), 0)
        at[beyond] = end[beyond] = self.n
        rest = x & U((1 << self.low) - 1)
        while True:  # binary search among the few that share the high bits
            open_ = np.flatnonzero(at < end)
            if not len(open_):
                return at
            middle = (at[open_] + end[open_]) // 2
            less = self.low_bits(middle) < rest[open_]
            at[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]


class Trie:
    """Contexts, and for each its successors with quantised probabilities.

    Levels: context ids; pointers to where each context's successors begin;
    successor ids, made monotone over the whole level by adding to each what the
    context before ends with, so that a search within a context is a successor
    search for id + that base.
    """

    def __init__(self, mapped: mmap.mmap):
        buffer = np.frombuffer(mapped, np.uint8)
        self.levels = []
        for _ in range(3):
            self.levels.append(Monotone(buffer))
            buffer = buffer[self.levels[-1].length:]
        self.values = buffer[:len(buffer) // 2 * 2].view("<u2")

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, value: np.ndarray) -> bytes:
        """From rows sorted by (context, word)."""
        new = np.concatenate(([True], context[1:] != context[:-1])) if len(context) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = word[np.append(first[1:], len(word)) - 1] + U(1) if len(first) else np.zeros(0, U)
        base = np.cumsum(last, dtype=U) - last
        shifted = word + np.repeat(base, np.diff(np.append(first, len(word))))
        body = encode_monotone(context[first]) + encode_monotone(np.append(first, len(word)).astype(U)) + encode_monotone(shifted)
        return body + value.astype("<u2").tobytes()

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each (context, word) is in the trie, and its quantised value; a run of one context is looked up once."""
        contexts, pointers, words = self.levels
        known = np.zeros(len(context), bool)
        value = np.zeros(len(context), np.uint16)
        if not contexts.n or not len(context):
            return known, value
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        run = np.diff(np.append(first, len(context)))
        at = contexts.successor(context[first])
        held = at < contexts.n
        held[held] = contexts[at[held]] == context[first[held]]
        rank = at[held]
        begin, end = pointers[rank].astype(np.int64), pointers[rank + 1].astype(np.int64)
        base = np.zeros(len(rank), U)
        base[begin > 0] = words[begin[begin > 0] - 1] + U(1)
        there = np.flatnonzero(np.repeat(held, run))
        target = word[there] + np.repeat(base, run[held])
        place = words.successor(target)
        inside = np.flatnonzero(place < np.repeat(end, run[held]))
        hit = inside[words[place[inside]] == target[inside]]
        known[there[hit]] = True
        value[there[hit]] = self.values[place[hit]]
        return known, value


# ---- blocks -----------------------------------------------------------------------------------------

class Words:
    """A block's tokens as local numbers, document after document, each with its end."""

    def __init__(self, texts: list[bytes], train: np.ndarray):
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        self.end = number[END]
        parts = []
        self.length = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            words = text.lower().split()
            self.length[i] = len(words) + 1
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            parts.append(np.array([self.end]))
        self.token = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.train = np.repeat(train, self.length)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.first] = self.end  # a document starts after an end
        self.before = before
        hashes = np.fromiter(map(xxh64_intdigest, number), U, len(number))
        self.order = np.argsort(hashes)
        self.hash = hashes[self.order]
        self.count = np.bincount(self.token[self.train], minlength=len(number))[self.order]

    def ask(self, block: str, shards: int):
        """The words' hashes and training counts, by shard (the high bits of the hash)."""
        shard = ((self.hash >> U(32)) * U(shards)) >> U(32)
        for s, at in runs(shard):
            yield block, s, pack(steps(self.hash[at]), self.count[at])

    def learn(self, replies: list[tuple[int, bytes]], shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Corpus count and number of each local word (number 0: never seen in training)."""
        shard = ((self.hash >> U(32)) * U(shards)) >> U(32)
        count, number = np.zeros(len(self.hash), U), np.zeros(len(self.hash), U)
        for s, body in replies:
            at = run_of(shard, s)
            count[at], number[at] = unpack(body)[:2]
        out = np.zeros((2, len(self.hash)), U)
        out[0, self.order], out[1, self.order] = count, number
        return out[0], out[1]


class Block:
    def __init__(self, table: pa.Table, shards: int, tokens: int):
        replies, body = [], None
        for shard, raw in zip(table.column("shard").to_pylist(), table.column("body").to_pylist()):
            if shard < 0:
                body = raw
            else:
                replies.append((shard, raw))
        self.rows, texts, _ = read_block(body)
        self.words = w = Words(texts, self.rows.column(2).to_numpy(zero_copy_only=False).astype(bool))
        self.count, number = w.learn(replies, shards)
        # distinct pairs of words that both occur in training, in order of their numbers, by shard
        pair = w.before * len(number) + w.token
        distinct, self.of = np.unique(pair, return_inverse=True)
        trained = np.bincount(self.of, weights=w.train, minlength=len(distinct)).astype(U)
        a, b = distinct // max(1, len(number)), distinct % max(1, len(number))
        known = np.flatnonzero((number[a] > 0) & (number[b] > 0))
        a, b = a[known], b[known]
        # a context with a large share of all tokens is spread over several shards by its successor
        spread = U(1) + self.count[a] * U(4 * shards) // U(max(1, tokens))
        shard = (mix(number[a] + (mix(number[b]) % spread) * U(0x9E3779B97F4A7C15)) % U(shards)).astype(np.int64)
        order = np.lexsort((number[b], number[a], shard))
        self.pair = known[order]
        self.shard, self.a, self.b = shard[order], a[order], b[order]
        self.number, self.trained, self.pairs = number, trained[self.pair], len(distinct)

    def ask(self, block: str):
        for s, at in runs(self.shard):
            a, b = self.a[at], self.b[at]
            yield block, s, pack(steps(self.number[a]), self.number[b], self.trained[at], self.count[a], self.count[b])

    def scores(self, replies: pa.Table, tokens: int, words: int, mu: float) -> list[np.ndarray]:
        w = self.words
        count = self.count.astype(np.float64)
        alone = np.log10((count + 1) / (tokens + words + 1))
        # a pair that the trie lacks: the share that smoothing leaves, times the word alone
        context = np.log10(mu / (count + mu))
        quantised = np.zeros(self.pairs, np.int64)
        for s, body in zip(replies.column("shard").to_pylist(), replies.column("body").to_pylist()):
            quantised[self.pair[run_of(self.shard, s)]] = unpack(body)[0].astype(np.int64)
        value = quantised[self.of]
        score = np.where(value > 0, (value - 1) * -STEP, context[w.before] + alone[w.token])
        add = np.add.reduceat if len(w.first) else (lambda x, at: np.zeros(0))
        return [w.length, add((count[w.token] > 0).astype(np.int64), w.first), add(alone[w.token], w.first), add(score, w.first)]


def _count_words(table: pa.Table, shards: int) -> pa.Table:
    """One shard of words: corpus counts and numbers, answered in the order of each question."""
    parts = [unpack(b)[:2] for b in table.column("body").to_pylist()]
    sizes = [len(p[0]) for p in parts]
    key, count = np.concatenate([np.cumsum(p[0], dtype=U) for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    group = np.cumsum(new) - 1
    total = np.add.reduceat(count[order], np.flatnonzero(new))
    shard = table.column("shard")[0].as_py()
    number = np.where(total > 0, (np.cumsum(total > 0) - 1).astype(U) * U(shards) + U(shard + 1), U(0))
    out = np.empty((2, len(key)), U)
    out[0, order], out[1, order] = total[group], number[group]
    cuts = np.cumsum(sizes)[:-1]
    bodies = [pack(a, b) for a, b in zip(np.split(out[0], cuts), np.split(out[1], cuts))]
    give_back()
    sums = [[int(total.sum())] + [0] * (len(sizes) - 1), [int((total > 0).sum())] + [0] * (len(sizes) - 1)]
    return pa.Table.from_arrays([table.column("block"), table.column("shard"), pa.array(bodies, pa.binary()), *map(pa.array, sums)],
                                schema=ARROW_MESSAGE.append(pa.field("tokens", pa.int64())).append(pa.field("words", pa.int64())))


def _answer_pairs(table: pa.Table, tokens: int, words: int, mu: float) -> pa.Table:
    """One shard of pairs: build its trie from the corpus counts, map it, and look up every question.

    An answer is 0 for a pair that training lacks, else one more than the quantised -log10 probability.
    """
    parts = [unpack(b)[:5] for b in table.column("body").to_pylist()]
    asked = [(np.cumsum(p[0], dtype=U), p[1]) for p in parts]
    cols = [np.concatenate([a for a, _ in asked]), *[np.concatenate([p[i] for p in parts]) for i in range(1, 5)]]
    del parts
    order = np.lexsort((cols[1], cols[0]))
    for i in range(5):
        cols[i] = cols[i][order]
    del order
    a, b, n, ca, cb = cols
    at = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    total = np.add.reduceat(n, at).astype(np.float64)
    alone = (cb[at].astype(np.float64) + 1) / (tokens + words + 1)
    smooth = (total + mu * alone) / (ca[at].astype(np.float64) + mu)
    value = np.minimum(np.round(-np.log10(smooth) / STEP), 65534)
    seen = total > 0
    a, b, value = a[at][seen], b[at][seen], value[seen]
    del cols, n, ca, cb, at, total, alone, smooth, seen
    bodies = []
    body = Trie.build(a, b, value)
    del a, b, value
    mapped = mmap.mmap(-1, len(body))  # pages that go back to the system with the task, and no file of one machine
    mapped.write(body)
    del body
    trie = Trie(mapped)
    for context, word in asked:
        known, found = trie.find(context, word)
        bodies.append(pack(np.where(known, found.astype(np.int64) + 1, 0)))
    del asked, trie
    give_back()
    return pa.Table.from_arrays([table.column("block"), table.column("shard"), pa.array(bodies, pa.binary())], schema=ARROW_MESSAGE)


def score(docs: DataFrame, modulus: int = 7, held: int = 2, mu: float = 100.0, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = 4 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    The model is a bigram model over all training texts, whole and unpruned,
    smoothed by the unigram (Dirichlet, ``mu`` pseudo-counts):
    p(w | v) = (c(vw) + mu p(w)) / (c(v) + mu), p(w) = (c(w) + 1) / (N + V + 1).
    A document starts after an end.  Probabilities of pairs seen in training
    come from the tries in steps of 0.01 of log10, the others from counts.

    Words are counted by shards of their hash, once per block and word; pairs
    go once per block to the shard of their context, where the trie is built,
    memory-mapped and asked.  A context with a large share of all tokens is
    spread over shards, so neither a frequent word nor a frequent pair gathers
    in one place.  Per document only its texts' block is held.

    Null and empty texts are the end alone; a null id trains; repeated rows
    count as often as they come; other columns are ignored; with no training
    text every count is 0; an empty table gives no rows.
    """
    packed, size = pack_documents(docs, id_col, text_col, [training_row(id_col, modulus, held)], block_bytes)
    shards = max(8, -(-size // shard_bytes))

    def ask_words(batches):
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, texts, _ = read_block(body)
                yield from to_batches(Words(texts, rows.column(2).to_numpy(zero_copy_only=False).astype(bool)).ask(block, shards))

    words = packed.select("block", "body").mapInArrow(ask_words, MESSAGE)
    counted = materialise(words.groupBy("shard").applyInArrow(lambda t: _count_words(t, shards), MESSAGE + ", tokens long, words long"), "words")
    total = counted.agg(F.sum("tokens"), F.sum("words")).first()
    n_tokens, n_words = total[0] or 0, total[1] or 0

    def ask_pairs(table):
        block = table.column("block")[0].as_py()
        return pa.Table.from_batches(to_batches(Block(table, shards, n_tokens).ask(block)), schema=ARROW_MESSAGE)

    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def finish(table, replies):
        block = Block(table, shards, n_tokens)
        length, known, base, model = block.scores(replies, n_tokens, n_words, mu)
        train = block.rows.column(2).to_numpy(zero_copy_only=False).astype(bool)
        return pa.Table.from_arrays([block.rows.column(0), pa.array(~train), pa.array(length), pa.array(known),
                                     pa.array(np.full(len(length), n_tokens, np.int64)), pa.array(base), pa.array(model)], schema=result)

    known = packed.select("block", F.lit(-1).cast("long").alias("shard"), "body").unionAll(counted.select("block", "shard", "body"))
    pairs = known.groupBy("block").applyInArrow(ask_pairs, MESSAGE)
    answers = pairs.groupBy("shard").applyInArrow(lambda t: _answer_pairs(t, n_tokens, n_words, mu), MESSAGE)
    return known.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
