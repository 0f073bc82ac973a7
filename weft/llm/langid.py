"""Language identification by compression with per-language raw-content dictionaries."""

from __future__ import annotations

import re

import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import give_back, map_columns, training_row

#: Language of texts without a letter, and of every text when nothing could be learned.
UNDETERMINED = "und"
#: Words are packed in pieces of so many bytes: what a dictionary saves is bounded, and would be lost in a longer piece.
PIECE = 8192
#: Runs of letters and number signs; the few with number signs (½, ², Ⅳ) are cut again into letters alone.
find_words, find_letters = re.compile(r"[^\W\d_]+").findall, regex.compile(r"\p{L}+").findall


def words_of(text: str | None) -> bytes:
    """Each different word (run of Unicode letters) of a text once, in order of appearance, in lower case: repetition and marks say nothing."""
    words = dict.fromkeys(find_words(text.lower())) if text else {}
    if not all(map(str.isalpha, words)):
        words = dict.fromkeys(w for run in words for w in find_letters(run))
    return " ".join(words).encode()


def fit_dictionaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     samples: int = 600, sample_chars: int = 512, dictionary_bytes: int = 128 * 1024, languages: int = 64,
                     ) -> dict[str, bytes]:
    """Language -> dictionary, the most frequent language first.

    The sample is bounded: of the ``languages`` labels with most texts (ties:
    the smaller name) the ``samples`` texts that come first by a hash of their
    id, an equal number from each of 20 hash buckets, so that no task ranks a
    language; of each text ``sample_chars`` characters, in four pieces spread
    over it if it is longer.  Dictionaries are cut to ``dictionary_bytes``.
    Texts are counted first and only those whose hash is below what yields
    some times ``samples`` are ranked, so tasks send few rows however many
    there are.  Rows with a null label or text teach nothing.
    """
    buckets, spare = 20, 4
    known = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if not sizes:
        return {}
    share = docs.sparkSession.createDataFrame([(lang, min(1.0, spare * samples / n)) for lang, n in sizes.items()], "lang string, share double")
    n, size = F.length("text"), sample_chars // 4
    spread = F.concat_ws(" ", *[F.substr("text", (F.floor((n - size) * i / 3) + 1).cast("int"), F.lit(size)) for i in range(4)])
    place = F.pmod(F.xxhash64("h"), F.lit(1 << 20)) / float(1 << 20)
    order = Window.partitionBy("lang", F.pmod("h", F.lit(buckets))).orderBy("h", "piece")
    rows = (known.join(F.broadcast(share), "lang").where(place < F.col("share"))
            .select("lang", "h", F.when(n <= sample_chars, F.col("text")).otherwise(spread).alias("piece"))
            .withColumn("n", F.row_number().over(order)).where(F.col("n") <= -(-samples // buckets)).collect())
    rows.sort(key=lambda r: (r["n"], r["h"], r["piece"]))
    found: dict[str, bytes] = {}
    for lang in sizes:
        pieces = dict.fromkeys(words_of(r["piece"]) for r in rows if r["lang"] == lang)
        content = b" ".join(p for p in pieces if p)[:dictionary_bytes]
        if len(content) >= 8:  # the least that the library takes
            found[lang] = content
    return found


class Classifier:
    """Chooses the language whose dictionary packs a text's words smallest, summed over pieces of them."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.packers = []
        for lang, content in dictionaries.items():
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=level)
            self.packers.append((lang, zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=False)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.packers:
            return UNDETERMINED, 0.0
        pieces = [words[at:at + PIECE] for at in range(0, len(words), PIECE)]
        sizes = [sum(len(packer.compress(p)) for p in pieces) for _, packer in self.packers]
        best = min(range(len(sizes)), key=sizes.__getitem__)  # ties: the language with more training rows
        others = [s for i, s in enumerate(sizes) if i != best]
        return self.packers[best][0], 1 - sizes[best] / min(others) if others else 1.0


_LOADED: dict[tuple, Classifier] = {}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             level: int = 6, min_margin: float = 0.005) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row, from its whole text only.

    ``score`` is the margin: by what share the best size is below the next.  Sizes
    are sums over pieces of ``PIECE`` bytes, so that it does not shrink with length.
    ``rejected`` is set when it is under ``min_margin`` or the text is null or
    has no letter (``lang_pred`` is ``und`` then, score 0).  A single learned
    language scores 1.  Repeated rows come back as often; other columns are
    ignored.  The dictionaries (languages x 128 KB) are broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(c):
        key = (level, tuple(model.value.items()))
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = Classifier(model.value, level)
        found = [_LOADED[key](t) for t in c[1]]
        return [c[0], [x for x, _ in found], [m for _, m in found],
                [x == UNDETERMINED or m < min_margin for x, m in found]]

    return map_columns(docs, [F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")], run,
                       "doc_id long, lang_pred string, score double, rejected boolean")


def with_language(docs: DataFrame, modulus: int = 4, held: int = 2, level: int = 6, min_margin: float = 0.005) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)``: fit on the training rows, predict all rows."""
    model = fit_dictionaries(docs.where(training_row("doc_id", modulus, held)))
    found = identify(docs, model, level=level, min_margin=min_margin)
    return found.withColumn("held_out", ~training_row("doc_id", modulus, held))


def keep_identified(docs: DataFrame, modulus: int = 4, held: int = 2, level: int = 6, min_margin: float = 0.005) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, columns unchanged.

    Filtered in the task that predicts, so that repeated and null ids need no join.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_dictionaries(docs.where(training_row("doc_id", modulus, held))))

    def run(batches):
        import pyarrow as pa

        classify = Classifier(model.value, level)
        for batch in batches:
            keep = []
            for t in batch.column("text"):
                lang, margin = classify(t.as_py())
                keep.append(lang != UNDETERMINED and margin >= min_margin)
            yield batch.filter(pa.array(keep))
        give_back()

    return docs.mapInArrow(run, docs.schema)
