"""Tokenizers as Column expressions (T1) and array helpers.

The default :class:`HashTokenizer` splits text with one regular expression
and maps each token to a stable id with md5, entirely inside the JVM (no
Python per row).  The regex call is generated code; the array lambdas
(``transform``, ``aggregate``, ``filter``) are interpreted by Spark.  :class:`PandasTokenizer` plugs any Python tokenizer in through
an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.session import materialize

# The label sentinel ignored by the loss.
IGNORE_INDEX = -100

# Word runs, or any single character that is neither a word character nor
# ASCII whitespace.  Written with explicit classes so DuckDB agrees.
TOKEN_PATTERN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


class HashTokenizer:
    """Regex tokens, id = reserved + (first 7 hex digits of md5) mod (V - reserved).

    Special ids: pad 0, bos 1, eos 2 by default.  ``algorithm="xxhash64"``
    uses Spark's code-generated xxhash64 instead of md5 (about 8x cheaper per
    token) when ids need not be reproduced outside Spark.  ``monotone`` says
    that a longer text never has fewer tokens (true of the default pattern);
    history look-backs are bounded by it.
    """

    def __init__(self, vocab_size: int = 32000, pad_id: int = 0, bos_id: int = 1,
                 eos_id: int = 2, reserved: int = 3, pattern: str = TOKEN_PATTERN, algorithm: str = "md5",
                 monotone: bool | None = None):
        if algorithm not in ("md5", "xxhash64"):
            raise ValueError("algorithm must be 'md5' (portable, checkable in DuckDB) or 'xxhash64' (fast)")
        self.algorithm = algorithm
        self.vocab_size = vocab_size
        self.pad_id = pad_id
        self.bos_id = bos_id
        self.eos_id = eos_id
        self.reserved = reserved
        self.pattern = pattern
        self.monotone = pattern == TOKEN_PATTERN if monotone is None else monotone

    # -- Spark ---------------------------------------------------------
    def tokens(self, text) -> Column:
        return F.regexp_extract_all(_col(text), F.lit(self.pattern), 0)

    def token_id(self, tok: Column) -> Column:
        if self.algorithm == "xxhash64":
            h = F.xxhash64(tok)
        else:
            h = F.conv(F.substring(F.md5(tok), 1, 7), 16, 10).cast("bigint")
        return (F.lit(self.reserved) + F.pmod(h, F.lit(self.vocab_size - self.reserved))).cast("int")

    def ids(self, text, add_special: bool = False) -> Column:
        out = F.transform(self.tokens(text), self.token_id)
        if add_special:
            out = F.concat(F.array(F.lit(self.bos_id)), out)
        return out

    def count(self, text, add_special: bool = False) -> Column:
        """Token count without hashing (cheap length for budgets)."""
        n = F.size(self.tokens(text))
        return n + 1 if add_special else n

    def ids_many(self, texts) -> Column:
        """ARRAY<STRING> -> ARRAY<ARRAY<INT>>."""
        return F.transform(_col(texts), lambda t: self.ids(t))

    def count_many(self, texts) -> Column:
        """ARRAY<STRING> -> ARRAY<INT> of token counts (no hashing)."""
        return F.transform(_col(texts), lambda t: self.count(t))

    # -- DuckDB oracle text ------------------------------------------
    def sql_tokens(self, text_sql: str) -> str:
        return f"regexp_extract_all({text_sql}, '{self.pattern}')"

    def sql_ids(self, text_sql: str, add_special: bool = False) -> str:
        if self.algorithm != "md5":
            raise NotImplementedError("only md5 ids have a DuckDB equivalent")
        m = self.vocab_size - self.reserved
        body = (f"list_transform({self.sql_tokens(text_sql)}, lambda t: "
                f"CAST({self.reserved} + (('0x' || substr(md5(t), 1, 7))::BIGINT % {m}) AS INTEGER))")
        return f"list_concat([{self.bos_id}], {body})" if add_special else body

    def sql_count(self, text_sql: str, add_special: bool = False) -> str:
        n = f"len({self.sql_tokens(text_sql)})"
        return f"({n} + 1)" if add_special else n


class VocabTokenizer:
    """Ids from a vocabulary table ``(token, id)``, looked up in the JVM.

    The table (at most ``max_size`` tokens, checked) is read once into a
    session variable: an array of as many buckets as tokens, indexed by the
    token's hash, with the few entries of a bucket compared as text, so a
    lookup costs the same for any vocabulary and exactly its tokens match.
    The optimizer makes the variable a constant of the plan, which is how it
    reaches each executor.

    Words (``pattern``) outside the vocabulary are ``unk_id``.  With
    ``greedy`` they are cut from the left into the longest vocabulary tokens
    (of up to ``max_piece`` characters); a character that begins none is
    ``unk_id``, and so is a whole word of more than ``max_word`` characters.
    An Arrow function cuts them, each different word of a batch once; it
    carries the vocabulary, bounded by ``max_size`` too.
    A token listed twice has its smallest id; rows with a null are ignored."""

    def __init__(self, table: DataFrame, unk_id: int, pad_id: int = 0, bos_id: int = 1, eos_id: int = 2, token_col: str = "token",
                 id_col: str = "id", greedy: bool = False, pattern: str = TOKEN_PATTERN, max_size: int = 1_000_000,
                 max_piece: int = 32, max_word: int = 200):
        self.unk_id, self.pad_id, self.bos_id, self.eos_id = unk_id, pad_id, bos_id, eos_id
        self.greedy, self.pattern, self.max_piece, self.max_word = greedy, pattern, max_piece, max_word
        self.monotone = pattern == TOKEN_PATTERN and not greedy
        spark = table.sparkSession
        rows = (table.select(F.col(token_col).alias("token"), F.col(id_col).cast("int").alias("id"))
                .where("token is not null and id is not null").groupBy("token").agg(F.min("id").alias("id")))
        rows = materialize(rows.limit(max_size + 1), "vocabulary")   # its own query runs once
        size = rows.count()
        if size > max_size:
            raise ValueError(f"a vocabulary of more than {max_size} tokens, which each executor would hold")
        self.buckets = 1 << max(0, size - 1).bit_length()
        own = rows.groupBy(self._bucket(F.col("token")).alias("b")).agg(F.collect_list(F.struct("token", "id")).alias("e"))
        every = spark.range(self.buckets).select(F.col("id").cast("int").alias("b")).join(own, "b", "left")
        name = f"weft_vocabulary_{uuid.uuid4().hex}"
        every.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "e"))), lambda x: x["e"]).alias("v")).createOrReplaceTempView(name)
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<ARRAY<STRUCT<token:STRING,id:INT>>>")
        spark.sql(f"SET VAR {name} = (SELECT v FROM {name})")
        spark.catalog.dropTempView(name)
        self._held = F.expr(name)
        if greedy:
            self._cut, self._cut_many = _longest_pieces(dict(rows.collect()), unk_id, max_piece, max_word)

    def _bucket(self, token: Column) -> Column:
        return F.pmod(F.xxhash64(token), F.lit(self.buckets)).cast("int")

    def lookup(self, token: Column) -> Column:
        """Id of a token; null if the vocabulary has none."""
        return F.get(F.filter(F.get(self._held, self._bucket(token)), lambda e: e["token"] == token), F.lit(0))["id"]

    def tokens(self, text) -> Column:
        return F.regexp_extract_all(_col(text), F.lit(self.pattern), 0)

    def ids(self, text, add_special: bool = False) -> Column:
        if self.greedy:
            out = self._cut(self.tokens(text))
        else:
            out = F.transform(self.tokens(text), lambda w: F.coalesce(self.lookup(w), F.lit(self.unk_id)))
        return F.concat(F.array(F.lit(self.bos_id)), out) if add_special else out

    def count(self, text, add_special: bool = False) -> Column:
        n = F.size(self.ids(text) if self.greedy else self.tokens(text))
        return n + 1 if add_special else n

    def ids_many(self, texts) -> Column:
        """ARRAY<STRING> -> ARRAY<ARRAY<INT>>; greedily in one call, as no Python function runs inside a lambda."""
        if self.greedy:
            return self._cut_many(F.transform(_col(texts), self.tokens))
        return F.transform(_col(texts), lambda t: self.ids(t))

    def count_many(self, texts) -> Column:
        if self.greedy:
            return F.transform(self.ids_many(texts), lambda x: F.size(x))
        return F.transform(_col(texts), lambda t: self.count(t))


def _regrouped(lists: pa.ListArray, items: pa.ListArray) -> pa.ListArray:
    """``lists`` with the lists of ``items`` (one for each of their elements) joined in place of the elements."""
    ends = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(lists), 0).to_numpy()]))
    return pa.ListArray.from_arrays(pa.array(items.offsets.to_numpy()[ends], pa.int32()), items.flatten(), mask=lists.is_null())


def _longest_pieces(vocabulary: dict[str, int], unk_id: int, max_piece: int, max_word: int):
    """Arrow UDFs that cut words from the left into the longest tokens: of a list of words, of a list of such lists.

    A batch's different words are cut once each, whatever their number."""
    longest = min(max_piece, max(map(len, vocabulary), default=0))

    def cut(word: str) -> list[int]:
        if word in vocabulary:
            return [vocabulary[word]]
        if len(word) > max_word:
            return [unk_id]
        out, i = [], 0
        while i < len(word):
            for n in range(min(longest, len(word) - i), 0, -1):
                if (found := vocabulary.get(word[i:i + n])) is not None:
                    out.append(found)
                    i += n
                    break
            else:
                out.append(unk_id)
                i += 1
        return out

    def ids(words: pa.Array) -> pa.Array:
        words = words.cast(pa.list_(pa.string()))
        coded = words.flatten().dictionary_encode()
        cuts = pa.array([cut(w) for w in coded.dictionary.to_pylist()], pa.list_(pa.int32()))
        return _regrouped(words, cuts.take(coded.indices))

    def ids_many(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.list_(pa.list_(pa.string())))
        each = ids(texts.flatten())
        ends = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(texts), 0).to_numpy()]))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each, mask=texts.is_null())

    numbers = T.ArrayType(T.IntegerType())
    return F.arrow_udf(ids, numbers), F.arrow_udf(ids_many, T.ArrayType(numbers))


class PandasTokenizer:
    """Wrap a user encode function ``list[str] -> list[list[int]]``.

    Runs once per Arrow batch on the executors.
    """

    def __init__(self, encode: Callable[[Sequence[str]], Sequence[Sequence[int]]],
                 pad_id: int = 0, bos_id: int = 1, eos_id: int = 2):
        self.encode = encode
        self.pad_id, self.bos_id, self.eos_id = pad_id, bos_id, eos_id
        fn = encode

        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def _ids(s: pd.Series) -> pd.Series:
            mask = s.isna()
            out = pd.Series([None] * len(s), dtype=object)
            if (~mask).any():
                enc = fn(s[~mask].tolist())
                out[~mask.values] = pd.Series([list(map(int, e)) for e in enc], dtype=object).values
            return out

        @F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
        def _ids_many(s: pd.Series) -> pd.Series:
            # one encode call per Arrow batch for all texts of all rows
            flat, sizes = [], []
            for arr in s:
                items = [] if arr is None else ["" if t is None else t for t in arr]
                sizes.append(None if arr is None else len(items))
                flat.extend(items)
            enc = [list(map(int, e)) for e in fn(flat)] if flat else []
            out, pos = [], 0
            for n in sizes:
                if n is None:
                    out.append(None)
                else:
                    out.append(enc[pos:pos + n])
                    pos += n
            return pd.Series(out, dtype=object)

        self._udf = _ids
        self._udf_many = _ids_many

    def ids(self, text, add_special: bool = False) -> Column:
        out = self._udf(_col(text))
        if add_special:
            out = F.concat(F.array(F.lit(self.bos_id)), out)
        return out

    def count(self, text, add_special: bool = False) -> Column:
        n = F.size(self.ids(text))
        return n + 1 if add_special else n

    def ids_many(self, texts) -> Column:
        """ARRAY<STRING> -> ARRAY<ARRAY<INT>> in one UDF call (Python UDFs
        cannot run inside higher-order-function lambdas)."""
        return self._udf_many(_col(texts))

    def count_many(self, texts) -> Column:
        return F.transform(self.ids_many(texts), lambda x: F.size(x))


DEFAULT_TOKENIZER = HashTokenizer()


def truncate(ids: Column, n) -> Column:
    """First ``n`` elements (``n`` may be a Column)."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(F.size(ids) > n, F.slice(ids, F.lit(1), n)).otherwise(ids)


def right_pad(ids: Column, length: int, pad) -> Column:
    """Truncate/right-pad to exactly ``length``."""
    cut = truncate(ids, length)
    return F.concat(cut, F.array_repeat(F.lit(pad) if not isinstance(pad, Column) else pad,
                                        F.lit(length) - F.size(cut)))


def left_pad(ids: Column, length, pad) -> Column:
    length = length if isinstance(length, Column) else F.lit(length)
    pad = pad if isinstance(pad, Column) else F.lit(pad)
    return F.concat(F.array_repeat(pad, length - F.size(ids)), ids)
