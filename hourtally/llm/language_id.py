"""Language identification by bit-sliced Bloom filters of character n-grams.

A text is its lower-cased letters, other characters being one space; its n-grams have 3 and 4
characters. Each language has a Bloom filter of the n-grams that make up at least ``MIN_SHARE`` of
its n-grams, and at least ``MIN_PART`` of the share they have in any language. The filters lie side
by side: a row holds one bit for each language, so the ``HASHES`` rows of an n-gram, and-ed, are the
set of all languages that contain it.

For a language, the share of a text's n-grams that its bits report is corrected for the filter's
rate of false positives; the language with the greatest corrected share is predicted, and its part
of the sum over languages is the score.

The filters are learnt from a bounded sample (``MAX_PER_LANGUAGE`` documents of each language). At
most ``1 / MIN_SHARE`` n-grams of a language reach the driver, whatever the size of the corpus.

Defined results: a null text and a text without letters are ``und`` with score 0. A text without
any known n-gram gets the most frequent language, score 0. Equal shares: the language that comes
first by name. Nothing learnt: ``und``. Repeated rows, and rows without an id, are each judged; rows
without a language teach nothing. A very long text is one piece of work. An empty table gives no
rows; columns other than id, text and language are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.llm.features import crc_remainder
from hourtally.llm.tables import table
from hourtally.llm.text import U64, mix, per_piece, window_hashes

SIZES = (3, 4)
MAX_PER_LANGUAGE = 4_000
MIN_SHARE, MIN_PART = 2e-5, 0.125
HASHES, ROWS_PER_GRAM = 3, 8

_letters: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool))
    return _letters[0][points]


def grams(text: str | None) -> np.ndarray:
    """A 64-bit hash of each n-gram; empty if there is no letter."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter(points)
    if not letter.any():
        return np.empty(0, U64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each word
    keep[np.argmax(letter) - 1] = True  # and one before the first
    line = np.where(letter, points, 32)[keep].astype(U64)
    return np.concatenate([window_hashes(line, size) for size in SIZES])


def _count_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    by_language: dict[str, list[np.ndarray]] = {}
    for lang, text in zip(
        batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
    ):
        by_language.setdefault(lang, []).append(grams(text))
    langs, found, counts = [], [], []
    for lang, parts in by_language.items():
        own, n = np.unique(np.concatenate(parts), return_counts=True)
        langs += [lang] * len(own)
        found.append(own)
        counts.append(n)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.array(np.concatenate(found).view(np.int64)),
            pa.array(np.concatenate(counts)),
        ],
        names=["lang", "gram", "n"],
    )


def _places(found: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """The rows of each n-gram; ``n_rows`` is a power of two."""
    mask = U64(n_rows - 1)
    return [(mix(found + U64(i + 1)) & mask).astype(np.int64) for i in range(HASHES)]


class LanguageFilters:
    """``languages``, most frequent first for ties without evidence, and the filters' rows: one
    64-bit word for each 64 languages."""

    def __init__(self, languages: list[str], usual: int, found: np.ndarray, which: np.ndarray):
        self.languages, self.usual = languages, usual
        size = 1 << max(10, int(len(np.unique(found)) * ROWS_PER_GRAM - 1).bit_length())
        self.rows = np.zeros((size, max(1, -(-len(languages) // 64))), U64)
        bits = U64(1) << (which % 64).astype(U64)
        for place in _places(found, size):
            np.bitwise_or.at(self.rows, (place, which // 64), bits)
        self.false_rate = np.array(
            [float(self._bit(self.rows, i).mean()) ** HASHES for i in range(len(languages))]
        )

    @staticmethod
    def _bit(rows: np.ndarray, language: int) -> np.ndarray:
        return (rows[:, language // 64] >> U64(language % 64)) & U64(1)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text)
        if not len(found) or not self.languages:
            return "und", 0.0
        sets = None
        for place in _places(found, len(self.rows)):
            rows = self.rows[place]
            sets = rows if sets is None else sets & rows
        hits = np.array([int(self._bit(sets, i).sum()) for i in range(len(self.languages))])
        share = np.maximum((hits / len(found) - self.false_rate) / (1 - self.false_rate), 0)
        if not share.any():
            return self.languages[self.usual], 0.0
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum())


def fit_languages(docs: DataFrame, learn: Column) -> LanguageFilters:
    """From the documents ``(doc_id, text, lang)`` with a language that ``learn`` admits."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageFilters([], 0, np.empty(0, U64), np.empty(0, np.int64))
    # The share of each language's documents that is taken, by a hash of the id.
    shares = [x for lang in languages for x in (F.lit(lang), F.lit(MAX_PER_LANGUAGE / sizes[lang]))]
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    sample = known.where(place < F.element_at(F.create_map(*shares), F.col("lang")))
    counts = (
        sample.select("lang", "text")
        .mapInArrow(per_piece(_count_rows), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return LanguageFilters([], 0, np.empty(0, U64), np.empty(0, np.int64))
    by_name = F.create_map(*[x for k, v in totals.items() for x in (F.lit(k), F.lit(float(v)))])
    kept = (
        counts.withColumn("share", F.col("n") / F.element_at(by_name, F.col("lang")))
        .where(F.col("share") >= MIN_SHARE)
        .groupBy("gram")
        .agg(F.collect_list(F.struct("lang", "share")).alias("by"), F.max("share").alias("most"))
        .select("gram", "most", F.inline("by"))
        .where(F.col("share") >= MIN_PART * F.col("most"))
        .select("gram", "lang")
        .toPandas()  # at most 1 / MIN_SHARE n-grams a language
    )
    return LanguageFilters(
        languages,
        max(range(len(languages)), key=lambda i: (sizes[languages[i]], -i)),
        kept["gram"].to_numpy(np.int64).view(U64),
        kept["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.int64),
    )


def language_id(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs(doc_id, text)``."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [filters.predict(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ],
            names=["doc_id", "lang_pred", "score"],
        )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_piece(judge), "doc_id bigint, lang_pred string, score double"
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id(docs, fit_languages(docs, crc_remainder("doc_id", 5) != 0))
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
