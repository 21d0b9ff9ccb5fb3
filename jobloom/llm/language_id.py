"""Language identification by error-correcting output codes.

Every language has a codeword, and one binary classifier per bit tells the languages with
that bit set from the others. The classifiers are linear in the byte n-gram frequencies of
the lower-cased text: a weight is the log-ratio of the n-gram's probability in the two
halves, so they follow in closed form from one table of counts by language, gathered over
all training rows. Decoding sums over the bits a logistic loss of the classifier's margin
against the codeword's bit, weighted by how far the classifier separates its languages,
and takes the nearest codeword; a small lead over the second one flags the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import id_crc, prepare, table, utf8

BUCKETS = 1 << 14
FOLDS = 5
UNKNOWN = "und"
AMBIGUOUS_LEAD = 0.2
# Below this many characters an ambiguous text is too short to be refused for it.
LEAST_JUDGED = 200
MAX_LANGUAGES = 1000
EXHAUSTIVE_LANGUAGES = 7  # up to here the code has every split of the languages as a bit
# Bytes of a text whose n-grams are counted at one time.
_PIECE = 1 << 20
# Languages whose counts a task holds before it hands them on.
_LANGUAGES_HELD = 32


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte bigrams and trigrams of the whole lower-cased text."""
    data = np.frombuffer(utf8(f" {text.lower()} "), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(data) - 2, _PIECE):
        piece = data[i : i + _PIECE + 2].astype(np.uint32)
        two = piece[:-1] * np.uint32(0x01000193) + piece[1:]
        three = (two[:-1] * np.uint32(0x85EBCA6B)) ^ (piece[2:] * np.uint32(0xC2B2AE35))
        two = two[:-1] * np.uint32(0x9E3779B1)
        for grams in (two, three):
            counts += np.bincount((grams ^ (grams >> np.uint32(15))) >> np.uint32(4) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(languages: int) -> np.ndarray:
    """A matrix of +1 and -1, one row per language. Up to seven languages get every split
    as a bit, more get the best of 50 fixed random codes by least distance of two rows."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= EXHAUSTIVE_LANGUAGES:
        bits = np.arange(1, 1 << (languages - 1))
        return np.where(bits[None, :] >> np.arange(languages)[:, None] & 1, 1.0, -1.0)
    length = 4 * int(np.ceil(10 * np.log2(languages) / 4))
    random = np.random.default_rng(languages)
    best, best_distance = None, -1
    for _ in range(50):
        code = random.choice([-1.0, 1.0], (languages, length))
        code = code[:, np.abs(code.sum(axis=0)) < languages]  # a bit must split
        gram = code.shape[1] - code @ code.T
        distance = (gram + np.eye(languages) * 1e9).min()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray  # bits
    spread: np.ndarray  # bits: mean margin on the classifier's own languages
    trust: np.ndarray  # bits: weight of the bit's loss

    @classmethod
    def of_counts(cls, languages: list[str], counts: np.ndarray) -> LanguageModel:
        code = codewords(len(languages))
        if len(languages) < 2:
            none = np.zeros(0)
            return cls(languages, code, np.zeros((BUCKETS, 0)), none, none, none)
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = np.empty((BUCKETS, code.shape[1]))
        for bit in range(code.shape[1]):
            on, off = share[code[:, bit] > 0], share[code[:, bit] < 0]
            weights[:, bit] = np.log(on.mean(axis=0)) - np.log(off.mean(axis=0))
        margins = share @ weights
        high = np.where(code > 0, margins, np.inf).min(axis=0)
        low = np.where(code < 0, margins, -np.inf).max(axis=0)
        bias = -(high + low) / 2
        spread = np.maximum(np.abs(margins + bias).mean(axis=0), 1e-9)
        gap = np.maximum((high - low) / 2, 1e-3)
        return cls(languages, code, weights.astype(np.float32), bias, spread, gap / gap.sum())

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score from 0 to 1, ambiguous) for each text."""
        held = [t for t in texts if has_letter(t)]
        if not self.languages or not held:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        if len(self.languages) == 1:
            known = (self.languages[0], 1.0, False)
            return [known if has_letter(t) else (UNKNOWN, 0.0, True) for t in texts]
        margins = np.empty((len(held), self.code.shape[1]))
        for i in range(0, len(held), 128):
            counts = np.stack([ngram_counts(t) for t in held[i : i + 128]]).astype(np.float32)
            counts /= counts.sum(axis=1, keepdims=True)
            margins[i : i + 128] = counts @ self.weights
        margins = (margins + self.bias) / self.spread
        # texts x languages: the summed loss of every codeword
        loss = np.stack(
            [(np.logaddexp(0, -2 * margins * row) * self.trust).sum(axis=1) for row in self.code], 1
        )
        weight = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
        share = weight / weight.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        top = np.sort(share, axis=1)
        found = iter(
            (self.languages[b], float(s[-1]), bool(s[-1] - s[-2] < AMBIGUOUS_LEAD))
            for b, s in zip(best.tolist(), top, strict=True)
        )
        return [next(found) if has_letter(t) else (UNKNOWN, 0.0, True) for t in texts]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def handed_on():
        for language, counts in held.items():
            places = np.flatnonzero(counts)
            yield pa.record_batch(
                [
                    pa.array([language] * len(places), pa.string()),
                    pa.array(places, pa.int64()), pa.array(counts[places], pa.int64()),
                ],
                names=["language", "bucket", "n"],
            )
        held.clear()

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if has_letter(text):
                if language not in held and len(held) >= _LANGUAGES_HELD:
                    yield from handed_on()
                counts = ngram_counts(text)
                held[language] = held[language] + counts if language in held else counts
    yield from handed_on()


def fit(docs: DataFrame) -> LanguageModel:
    """Learn from every row whose ``lang`` is not null and whose id is outside the held-out
    fold. The driver gets one count per language and bucket; more than MAX_LANGUAGES
    languages raise an error."""
    rows = docs.where(F.col("lang").isNotNull() & (F.coalesce(id_crc(), F.lit(0)) % FOLDS != 0))
    counted = (
        rows.select("lang", "text")
        .mapInArrow(_counted, "language string, bucket long, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    per_language = counted.groupBy("language").agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts")
    )
    found = per_language.limit(MAX_LANGUAGES + 1).toArrow()
    if found.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the lang column")
    table_of = {}
    for language, buckets, counts in zip(*(found.column(i) for i in range(3)), strict=True):
        row = np.zeros(BUCKETS)
        row[buckets.values.to_numpy()] = counts.values.to_numpy()
        table_of[language.as_py()] = row
    languages = sorted(table_of)
    matrix = np.stack([table_of[x] for x in languages]) if languages else np.zeros((0, BUCKETS))
    return LanguageModel.of_counts(languages, matrix)


def language_of(model: LanguageModel, text: Column, docs: DataFrame) -> Column:
    """A struct (lang_pred, score, ambiguous) for each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(
        T.StructType(
            [
                T.StructField("lang_pred", T.StringType()),
                T.StructField("score", T.DoubleType()),
                T.StructField("ambiguous", T.BooleanType()),
            ]
        )
    )
    def predicted(texts: pa.Array) -> pa.Array:
        rows = shared.value.predict(texts.to_pylist())
        names, scores, flags = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [
                pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                pa.array(flags, pa.bool_()),
            ],
            names=["lang_pred", "score", "ambiguous"],
        )

    return predicted(text)


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    ``docs`` needs doc_id, text and lang; other columns are not read. A null or empty text
    and one without a letter is ``und`` with score 0; so is every text when no row can be
    learned from. A null doc_id is never held out. Repeated rows are predicted alike.
    """
    prepare(docs.sparkSession)
    found = docs.select(
        "doc_id", language_of(fit(docs), F.col("text"), docs).alias("found")
    )
    held_out = F.coalesce(id_crc() % FOLDS == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "found.*")


def in_known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without texts of no language and without ambiguous ones of LEAST_JUDGED
    characters or more; all columns stay."""
    prepare(docs.sparkSession)
    found = language_of(fit(docs), docs["text"], docs)
    short = F.length(docs["text"]) < LEAST_JUDGED
    return docs.where((found["lang_pred"] != UNKNOWN) & (~found["ambiguous"] | short))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
