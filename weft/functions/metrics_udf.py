"""Arrow UDFs for the two metrics that need sequential
per-row logic: ROUGE-L (longest common subsequence) and sentence BLEU.

Both are row-local: Spark partitions the rows, Arrow ships them in
batches, and the Python here is a small per-row helper.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: list, b: list) -> int:
    """Bit-parallel LCS length (one big-int pass per element of ``a``)."""
    if not a or not b:
        return 0
    masks: dict = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def rouge_l(hyp: list, ref: list) -> tuple[float, float, float]:
    """ROUGE-L recall, precision, F (F with beta = P/R, as in the ROUGE paper)."""
    if not hyp or not ref:
        return 0.0, 0.0, 0.0
    lcs = lcs_length(hyp, ref)
    r = lcs / len(ref)
    p = lcs / len(hyp)
    beta = p / (r + 1e-12)
    num = (1 + beta ** 2) * r * p
    den = r + (beta ** 2) * p
    return r, p, num / (den + 1e-12)


def lcs_words(ref: list, hyp: list) -> set:
    """The words of one longest common subsequence (of several, the one found
    by walking back from the ends and leaving the reference first only where
    that is strictly longer).

    The table of lengths is kept as a bit a cell (a 0 where a row's length
    grows by one): two texts of 20,000 words take 50 MB."""
    masks: dict = {}
    for j, y in enumerate(hyp):
        masks[y] = masks.get(y, 0) | (1 << j)
    full = (1 << len(hyp)) - 1
    rows = [full]
    for x in ref:
        v = rows[-1]
        u = v & masks.get(x, 0)
        rows.append(((v + u) | (v - u)) & full)

    def length(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count()

    words, i, j = set(), len(ref), len(hyp)
    while i and j:
        if ref[i - 1] == hyp[j - 1]:
            i, j = i - 1, j - 1
            words.add(ref[i])
        elif length(i - 1, j) > length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return words


def rouge_l_sentences(hyp: list[list], ref: list[list]) -> tuple[float, float, float]:
    """Summary-level ROUGE-L: the words in the common subsequences of any two
    sentences, against the different words of each side."""
    n_ref, n_hyp = len({w for s in ref for w in s}), len({w for s in hyp for w in s})
    if not n_ref or not n_hyp:
        return 0.0, 0.0, 0.0
    common = len(set().union(*(lcs_words(r, h) for r in ref for h in hyp)))
    r, p = common / n_ref, common / n_hyp
    beta = p / (r + 1e-12)
    return r, p, (1 + beta ** 2) * r * p / (r + beta ** 2 * p + 1e-12)


def _clipped_counts(ref: str, hyp: str, max_n: int) -> tuple[list[int], list[int]] | None:
    """Per order n: (sum of min(hyp count, ref count) over hyp n-grams,
    number of hyp n-grams), with numpy: characters are ranked over the joint
    alphabet and each n-gram is packed into one uint64 (16 bits per rank).
    Returns None when the alphabet is too large to pack."""
    codes = np.frombuffer((ref + hyp).encode("utf-32-le"), dtype=np.uint32)
    alphabet, ranks = np.unique(codes, return_inverse=True)
    if len(alphabet) >= 1 << 16:
        return None
    ranks = ranks.astype(np.uint64)
    r, h = ranks[:len(ref)], ranks[len(ref):]
    nums, dens = [], []
    for n in range(1, max_n + 1):
        if len(h) < n:
            nums.append(0)
            dens.append(0)
            continue
        hk = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for i in range(n):
            hk = (hk << np.uint64(16)) | h[i:len(h) - n + 1 + i]
        hu, hc = np.unique(hk, return_counts=True)
        if len(r) >= n:
            rk = np.zeros(len(r) - n + 1, dtype=np.uint64)
            for i in range(n):
                rk = (rk << np.uint64(16)) | r[i:len(r) - n + 1 + i]
            ru, rc = np.unique(rk, return_counts=True)
            _, hi, ri = np.intersect1d(hu, ru, assume_unique=True, return_indices=True)
            nums.append(int(np.minimum(hc[hi], rc[ri]).sum()))
        else:
            nums.append(0)
        dens.append(int(hc.sum()))
    return nums, dens


def _clipped_counts_slow(ref: str, hyp: str, max_n: int) -> tuple[list[int], list[int]]:
    nums, dens = [], []
    for n in range(1, max_n + 1):
        hc = Counter(hyp[i:i + n] for i in range(len(hyp) - n + 1))
        rc = Counter(ref[i:i + n] for i in range(len(ref) - n + 1))
        nums.append(sum(min(c, rc[g]) for g, c in hc.items()))
        dens.append(sum(hc.values()))
    return nums, dens


def sentence_bleu_chars(ref: str, hyp: str, max_n: int = 4) -> float:
    """Sentence BLEU-4 over characters with NIST geometric smoothing
    (smoothing "method 3"): a zero numerator at order k becomes
    1 / (2**j * denominator) for the j-th zero; no unigram match -> 0."""
    counts = _clipped_counts(ref, hyp, max_n) or _clipped_counts_slow(ref, hyp, max_n)
    nums, dens = counts[0], [max(1, d) for d in counts[1]]
    if nums[0] == 0:
        return 0.0
    hl, rl = len(hyp), len(ref)
    if hl > rl:
        bp = 1.0
    elif hl == 0:
        bp = 0.0
    else:
        bp = math.exp(1 - rl / hl)
    k = 1
    logs = []
    for num, den in zip(nums, dens):
        if num == 0:
            p = 1 / (2 ** k * den)
            k += 1
        else:
            p = num / den
        logs.append(0.25 * math.log(p))
    return bp * math.exp(math.fsum(logs))


_ROUGE_L_T = T.StructType([T.StructField("r", T.DoubleType()), T.StructField("p", T.DoubleType()),
                           T.StructField("f", T.DoubleType())])


#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 128


def _scores(fn: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``fn`` of every row, converted a slice at a time: a row's lists of words take many times their Arrow size."""
    parts = []
    for at in range(0, len(columns[0]), SLICE):
        rows = zip(*(c.slice(at, SLICE).to_pylist() for c in columns))
        parts.append(pa.array([fn(*row) for row in rows], kind))
    pa.default_memory_pool().release_unused()
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _rpf(scores: tuple[float, float, float]) -> dict[str, float]:
    return dict(zip("rpf", scores))


_ROUGE_L_A = pa.struct([(m, pa.float64()) for m in "rpf"])


@F.arrow_udf(_ROUGE_L_T)
def rouge_l_udf(hyp: pa.Array, ref: pa.Array) -> pa.Array:
    return _scores(lambda h, r: _rpf(rouge_l(h or [], r or [])), _ROUGE_L_A, hyp, ref)


@F.arrow_udf(_ROUGE_L_T)
def rouge_l_sentences_udf(hyp: pa.Array, ref: pa.Array) -> pa.Array:
    return _scores(lambda h, r: _rpf(rouge_l_sentences(h or [], r or [])), _ROUGE_L_A, hyp, ref)


@F.arrow_udf(T.DoubleType())
def bleu_udf(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    return _scores(lambda r, h: sentence_bleu_chars(r or "", h or ""), pa.float64(), ref, hyp)
