"""Exact repeated-passage removal over sampled suffixes, sorted outside memory and induced to all positions.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id.  Sorting every suffix would carry a tuple of 16 or
more bytes for each byte of text, many times the input; so the suffixes that
are sorted are sampled by their content, as induced sorting samples by type:

1. Every window of ``length`` bytes names an anchor, the k-byte string in it
   with the least hash (the leftmost among equals).  Equal windows have equal
   anchors at equal places.  Neighbouring windows with one anchor form a unit;
   there are about 6 units for 100 bytes.
2. The unit tuples (anchor, unit name, least id) leave each block as sorted
   runs, once per block and name, and are merged and sorted by shard.  A unit
   name found in a smaller id induces the answer for all its windows.
3. Anchors with several unit names (edges of shared passages) go on to the
   next level: the windows of such units are sorted by their own names, and
   tell exactly where the common part begins and ends.

Blocks are packed once into the shared folder and answered by (block, shard)
messages of byte columns; no text meets another document's text, so no group
of copies gathers anywhere.  Per block and name there is one tuple, and an
anchor with many names in one block sends a marker in their place, so a
passage in a third of all documents costs each shard a tuple a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from weft.llm.blocks import ARROW_MESSAGE, MESSAGE, U, mix, pack, pack_documents, read_block, run_of, runs, steps, to_batches, unpack
from weft.llm.common import give_back

PLACE = 31  # low bits of a sliding minimum that hold the place
#: Windows handled at once; a longer text is cut, and the units at a cut go on to the next level.
SLICE = 1 << 20
#: Windows hashed at once.
TILE = 1 << 15
#: Names of one anchor in one block above which a marker stands for them.
MANY = 8


# ---- hashes of all positions ------------------------------------------------------------------------

def _table() -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8).digest() for b in range(256)), "<u8")


def _hashes(letters: np.ndarray, *widths: int) -> list[np.ndarray]:
    """Hashes of the bytes from each position, one array for each of the widths; all come from the same doubled widths."""
    power, size, part = 0x9E3779B97F4A7C15, 1, letters
    out: list = [None] * len(widths)
    done = [0] * len(widths)
    while True:
        for i, width in enumerate(widths):
            if width & size:
                if out[i] is None:
                    out[i], done[i] = part, size
                else:
                    m = len(letters) - done[i] - size + 1
                    out[i], done[i] = out[i][:m] * U(power) + part[done[i]:done[i] + m], done[i] + size
        if list(widths) == done:
            return [mix(o) for o in out]
        part = part[:-size] * U(power) + part[size:]
        power, size = power * power % (1 << 64), size * 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    size, part = 1, values
    while size * 2 <= width:
        part, size = np.minimum(part[:-size], part[size:]), size * 2
    m = len(values) - width + 1
    return np.minimum(part[:m], part[width - size:width - size + m])


class Units:
    """Units of a block: first window, number of windows, anchor hash, name, document; in text order.

    ``names`` are the hashes of the windows at all positions.
    """

    def __init__(self, texts: list[bytes], length: int, anchor: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
        windows = max(0, len(self.data) - length + 1)
        self.names = np.empty(windows, U)
        # no window of the last length - 1 positions of a text stays inside it
        self.crosses = np.zeros(windows, bool)
        for end in self.ends.tolist():
            self.crosses[max(0, end - length + 1):end] = True
        found = [self._slice(at, length, anchor) for at in range(0, windows, SLICE)]
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, U)] * 2
        self.first, self.count, self.anchor, self.name = cols
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    def _slice(self, at: int, length: int, anchor: int):
        """The units of ``SLICE`` windows, hashed in tiles that fit a processor's cache."""
        stop = min(at + SLICE, len(self.names))
        table, spread, low = _table(), length - anchor + 1, U((1 << PLACE) - 1)
        place, anchors = np.empty(stop - at, np.int64), np.empty(stop - at, U)
        for a in range(at, stop, TILE):
            b = min(a + TILE, stop)
            k, names = _hashes(table[self.data[a:b + length - 1]], anchor, length)
            least = _least((k & ~low) | np.arange(a - at, a - at + len(k), dtype=U), spread)
            self.names[a:b] = names
            place[a - at:b - at] = least & low
            anchors[a - at:b - at] = k[(least & low).astype(np.int64) - (a - at)]
        inside = np.flatnonzero(~self.crosses[at:stop])
        place = place[inside]
        if not len(place):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U)
        new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.append(new, len(place)))
        first = inside[new]
        names = self.names[at:stop]
        name = mix(names[first] * U(3) + names[first + count - 1] * U(7) + count.astype(U))
        return first + at, count, anchors[first], name >> U(16)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and names of all windows of the chosen units."""
        first, count = self.first[chosen], self.count[chosen]
        place = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(first) else first
        return place, self.names[place]


# ---- tuples and messages -----------------------------------------------------------------------------

def _code(ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned numbers of the same order."""
    return ids.astype(np.int64).view(U) ^ U(1 << 63)


class Tuples:
    """The distinct (anchor, name) tuples of a block, with their least id; in shard order."""

    def __init__(self, units: Units, ids: np.ndarray, shards: int):
        self.shard_of = ((units.anchor >> U(32)) % U(shards)).astype(np.int64)
        key = units.anchor & U(0xFFFFFFFF)
        order = np.lexsort((units.name, key, self.shard_of))
        s, k, n = self.shard_of[order], key[order], units.name[order]
        anew = np.concatenate(([True], (s[1:] != s[:-1]) | (k[1:] != k[:-1]))) if len(s) else np.zeros(0, bool)
        new = anew.copy()
        new[1:] |= n[1:] != n[:-1]
        number = np.cumsum(new) - 1
        self.of_unit = np.empty(len(s), np.int64)  # unit -> its tuple
        self.of_unit[order] = number
        at = np.flatnonzero(new)
        self.shard, self.anchor, self.name = s[at], k[at], n[at]
        self.least = np.minimum.reduceat(_code(ids)[units.doc[order]], at) if len(at) else np.zeros(0, U)
        group = np.cumsum(anew[at]) - 1
        self.many = np.bincount(group, minlength=1)[group] > MANY if len(at) else np.zeros(0, bool)
        # what is sent: tuples, and for an anchor with many names its first, as a marker without a name
        head = np.concatenate(([True], group[1:] != group[:-1])) if len(at) else np.zeros(0, bool)
        self.sent = np.flatnonzero(~self.many | head)

    def messages(self, block: str) -> Iterator[tuple[str, int, bytes]]:
        shard = self.shard[self.sent]
        for s, run in runs(shard):
            at = self.sent[run]
            name = np.where(self.many[at], U(0), self.name[at] + U(1))
            yield block, s, pack(steps(self.anchor[at]), name, self.least[at])

    def answers(self, replies: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """For every tuple: the least id anywhere, and whether its anchor has several names."""
        least, several = self.least.copy(), self.many.copy()
        shard = self.shard[self.sent]
        for s, body in replies:
            at = self.sent[run_of(shard, s)]
            lower, flag = unpack(body)[:2]
            plain = ~self.many[at]
            least[at[plain]] -= lower[plain]
            several[at] |= flag.astype(bool)
        return least, several


def _resolve_tuples(table: pa.Table) -> pa.Table:
    """One shard: merge the blocks' sorted runs; answer each run tuple by tuple."""
    parts = [unpack(b)[:3] for b in table.column("body").to_pylist()]
    sizes = [len(p[0]) for p in parts]
    key = np.concatenate([np.cumsum(p[0], dtype=U) for p in parts])
    name, least = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    order = np.lexsort((name, key))
    k, n = key[order], name[order]
    anew = np.concatenate(([True], k[1:] != k[:-1]))
    new = anew | np.concatenate(([True], n[1:] != n[:-1]))
    number, at = np.cumsum(new) - 1, np.flatnonzero(new)
    lowest = np.minimum.reduceat(least[order], at)[number]
    anchor = np.cumsum(anew) - 1
    several = (np.bincount(anchor, weights=new)[anchor] > 1) | np.maximum.reduceat(n == 0, np.flatnonzero(anew))[anchor]
    reply = np.empty((2, len(key)), U)
    reply[0, order], reply[1, order] = least[order] - lowest, several
    cuts = np.cumsum(sizes)[:-1]
    bodies = [pack(a, b) for a, b in zip(np.split(reply[0], cuts), np.split(reply[1], cuts))]
    del key, name, least, order, k, n, reply, parts
    give_back()
    return pa.Table.from_arrays([table.column("block"), table.column("shard"), pa.array(bodies, pa.binary())], schema=ARROW_MESSAGE)


def _resolve_windows(table: pa.Table) -> pa.Table:
    """One shard of windows: the least id of each name, as the difference to what the block knows."""
    parts = [unpack(b)[:2] for b in table.column("body").to_pylist()]
    sizes = [len(p[0]) for p in parts]
    key = np.concatenate([np.cumsum(p[0], dtype=U) for p in parts])
    least = np.concatenate([p[1] for p in parts])
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    reply = np.empty(len(key), U)
    reply[order] = least[order] - np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    bodies = [pack(a) for a in np.split(reply, np.cumsum(sizes)[:-1])]
    return pa.Table.from_arrays([table.column("block"), table.column("shard"), pa.array(bodies, pa.binary())], schema=ARROW_MESSAGE)


class Block:
    """A block with the answers about its tuples."""

    def __init__(self, table: pa.Table, length: int, anchor: int, shards: int):
        replies, body = [], None
        for shard, raw in zip(table.column("shard").to_pylist(), table.column("body").to_pylist()):
            if shard < 0:
                body = raw
            else:
                replies.append((shard, raw))
        self.rows, self.texts, self.ids = read_block(body)
        self.units = units = Units(self.texts, length, anchor)
        self.code = _code(self.ids)
        tuples = Tuples(units, self.ids, shards)
        least, several = tuples.answers(replies)
        t = tuples.of_unit
        self.gone = least[t] < self.code[units.doc]  # the whole unit starts in a smaller id
        # undecided: windows of a unit that no other block owns
        self.open = several[t] & (least[t] == tuples.least[t])

    def windows(self, shards: int):
        """Distinct windows of the undecided units, by shard; and where each place finds its answer."""
        chosen = np.flatnonzero(self.open)
        place, name = self.units.windows(chosen)
        doc = np.repeat(self.units.doc[chosen], self.units.count[chosen])
        shard = ((name >> U(48)) % U(shards)).astype(np.int64)
        order = np.lexsort((name, shard))
        new = np.concatenate(([True], (shard[order][1:] != shard[order][:-1]) | (name[order][1:] != name[order][:-1]))) if len(order) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(self.code[doc[order]], at) if len(at) else np.zeros(0, U)
        return place, doc, of, shard[order][at], name[order][at], least


def mark_repeats(docs: DataFrame, length: int = 50, anchor: int = 22, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = (), block_bytes: int = 4 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """``(doc_id, *carry, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row.

    ``kept`` (binary) holds the remaining bytes of the text's UTF-8.  Matches
    never cross documents, overlap freely and are judged on the input.  A null
    or short text loses nothing; rows with equal ids do not remove each other; a
    row with a null id counts as after every other and never as a source for
    another null id; ``carry`` names further columns to return as they are.
    An empty table gives no rows.
    """
    if not 1 <= anchor < length:
        raise ValueError("anchor must be shorter than length")
    packed, size = pack_documents(docs, id_col, text_col, [F.col(c) for c in carry], block_bytes)
    shards = max(8, -(-size // shard_bytes))

    def ask(batches):
        for batch in batches:
            for block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, texts, ids = read_block(body)
                yield from to_batches(Tuples(Units(texts, length, anchor), ids, shards).messages(block))
                give_back()

    def ask_windows(table):
        found = Block(table, length, anchor, shards)
        _, _, _, shard, name, least = found.windows(shards)
        block = table.column("block")[0].as_py()
        out = [(block, s, pack(steps(name[run]), least[run])) for s, run in runs(shard)]
        del found
        give_back()
        return pa.Table.from_batches(to_batches(out), schema=ARROW_MESSAGE)

    result = StructType([StructField("doc_id", LongType()), *[StructField(c, docs.schema[c].dataType) for c in carry],
                         StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                         StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("kept", BinaryType())])
    arrow_result = to_arrow_schema(result)

    def finish(table, replies):
        found = Block(table, length, anchor, shards)
        place, doc, of, shard, _, least = found.windows(shards)
        for s, body in zip(replies.column("shard").to_pylist(), replies.column("body").to_pylist()):
            least[run_of(shard, s)] -= unpack(body)[0]
        units = found.units
        edge = np.zeros(len(units.data) + 1, np.int32)
        whole = found.gone
        np.add.at(edge, units.first[whole], 1)
        np.add.at(edge, units.first[whole] + units.count[whole] + length - 1, -1)
        some = place[least[of] < found.code[doc]]
        np.add.at(edge, some, 1)
        np.add.at(edge, some + length, -1)
        gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
        del edge, some
        start, outs = 0, ([], [], [], [], [])
        for text in found.texts:
            end = start + len(text)
            cut = gone[start:end]
            kept = units.data[start:end][~cut].tobytes() if cut.any() else text
            spans = int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum())
            for o, v in zip(outs, (len(text), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)):
                o.append(v)
            start = end
        give_back()
        columns = [found.rows.column(0), *[found.rows.column(2 + i) for i in range(len(carry))], *outs]
        return pa.Table.from_arrays([c if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, arrow_result)],
                                    schema=arrow_result)

    asked = packed.select("block", "body").mapInArrow(ask, MESSAGE)
    replies = asked.groupBy("shard").applyInArrow(_resolve_tuples, MESSAGE)
    known = packed.select("block", F.lit(-1).cast("long").alias("shard"), "body").unionAll(replies)
    windows = known.groupBy("block").applyInArrow(ask_windows, MESSAGE)
    decided = windows.groupBy("shard").applyInArrow(_resolve_windows, MESSAGE)
    return known.groupBy("block").cogroup(decided.groupBy("block")).applyInArrow(finish, result)


def cut_repeats(docs: DataFrame, length: int = 50, anchor: int = 22) -> DataFrame:
    """The documents with repeated passages cut out (columns unchanged, ``n_chars`` counted anew).

    A cut can fall inside a character; its remaining bytes are left out.  A
    null text stays null.  No row is dropped: one with nothing of its own
    keeps an empty text.
    """
    carry = {c: f"__c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    rows = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in carry.items()], F.col("text").isNull().alias("__null"))
    marked = mark_repeats(rows, length, anchor, carry=(*carry.values(), "__null"))

    def decode(batches):
        for batch in batches:
            kept = [k.decode("utf-8", "ignore") for k in batch.column("kept").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("kept"), "kept", pa.array(kept, pa.string()))

    shape = StructType([f if f.name != "kept" else StructField("kept", StringType()) for f in marked.schema])
    text = F.when(~F.col("__null"), F.col("kept"))
    made = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return marked.mapInArrow(decode, shape).select(*[made.get(c, F.col(carry.get(c, c))).alias(c) for c in docs.columns])
