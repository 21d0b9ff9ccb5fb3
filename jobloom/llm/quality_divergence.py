"""Quality rules by distribution divergence.

A text's histograms of character classes and of its language's common words are compared with
references of each language, taken from all documents, by Jensen-Shannon distance (the root of
the divergence, base 2, from 0 to 1): its own language's, or the nearest one's where that is not
known. How far its texts may be is
not fixed: of the distances of all its documents that pass the base rules, the lower half says
how much is usual, and those far above the median are too far, so junk of up to half a language
does not widen its limit. A text without any common word is too far in every language. Short
texts are not judged by a histogram they cannot fill: below LEAST_CHARACTERS or LEAST_WORDS
the comparison is left out. Counts for the base rules come with the verdict.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import WHITE_SPACE, prepare, table
from jobloom.session import stage

COMMON_WORDS = 50
LEAST_CHARACTERS = 400
LEAST_WORDS = 80
# Limits: so many times the distance from the lower quartile to the median above the median,
# and no less than so much above it. Of the distance that a text without any common word
# has, a limit is this part at most.
SPREADS = 4.0
LEAST_MARGIN = 0.15
PART_OF_CEILING = 0.95
MAX_LANGUAGES = 1000
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
LEAST_BASE_WORDS = 20
_LETTERS = re.compile(r"[^\W\d_]+")
# Words and languages whose counts a task holds before it hands them on.
_NAMES_HELD = 300_000

CLASSES = 9


def _class_table() -> np.ndarray:
    """Character class by code point; the last entry stands for all higher ones."""
    table_of = np.full(0x251, 8, np.int64)
    table_of[:0x20] = 7  # control
    table_of[0x7F:0xA0] = 7
    for c in WHITE_SPACE:
        table_of[ord(c)] = 4
    table_of[0x20] = 3
    for c in range(0x21, 0x7F):
        letter = chr(c)
        table_of[c] = (
            0 if letter.islower() else 1 if letter.isupper() else 2 if letter.isdigit()
            else 5 if letter in ".,;:!?'\"()-" else 6
        )
    for c in range(0xA0, 0x250):
        table_of[c] = 0 if chr(c).islower() else 1 if chr(c).isupper() else 8
    return table_of


_CLASS = _class_table()


def class_counts(text: str) -> np.ndarray:
    """Lower case, upper case, digits, spaces, other white space, punctuation, other ASCII
    symbols, control characters, all else."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(_CLASS[np.minimum(points, len(_CLASS) - 1)], minlength=CLASSES)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of histograms along the last axis."""
    p = a / np.maximum(a.sum(axis=-1, keepdims=True), 1e-300)
    q = b / np.maximum(b.sum(axis=-1, keepdims=True), 1e-300)
    m = (p + q) / 2

    def part(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0).sum(axis=-1)

    return np.sqrt(np.maximum((part(p) + part(q)) / 2, 0))


@dataclass
class References:
    languages: list[str]
    classes: np.ndarray  # languages x CLASSES
    words: list[dict[str, int]]  # place of each common word
    shares: list[np.ndarray]  # counts of the common words, and of all others at the end

    def __post_init__(self):
        self.place = {name: i for i, name in enumerate(self.languages)}

    def ceilings(self) -> list[tuple[str, float]]:
        """The word distance of texts without any common word, by language, as a limit."""
        nothing = [np.append(np.zeros(len(share) - 1), 1.0) for share in self.shares]
        found = [float(distance(n, s)) for n, s in zip(nothing, self.shares, strict=True)]
        return [(name, PART_OF_CEILING * d) for name, d in zip(self.languages, found, strict=True)]

    def distances(self, text: str, language: str | None) -> tuple[float | None, str | None, float | None, str | None]:
        """Distance of the character classes and of the common words, each with the language
        that is so near; null if not judged."""
        by_class = class_of = by_word = word_of = None
        own = range(len(self.languages))
        if language in self.place:
            own = [self.place[language]]
        if len(text) >= LEAST_CHARACTERS and own:
            found = distance(class_counts(text), self.classes[own])
            by_class, class_of = float(found.min()), self.languages[own[int(found.argmin())]]
        words = _words(text)
        if len(words) >= LEAST_WORDS and own:
            counts = Counter(words)
            found = []
            for i in own:
                seen = [counts[word] for word in self.words[i]]
                share = np.array([*seen, len(words) - sum(seen)], float)
                found.append((float(distance(share, self.shares[i])), self.languages[i]))
            by_word, word_of = min(found)
        return by_class, class_of, by_word, word_of


def _words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTERS.findall(text.lower())


# Names of the class counts and of the number of words among the word counts.
_OTHER_COUNTS = [f"#{i}" for i in range(CLASSES)] + ["#words"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, name, n): words and character classes of what the task has read so far."""
    held: dict[str, Counter] = {}

    def handed_on():
        for language, counts in held.items():
            yield pa.record_batch(
                [
                    pa.array([language] * len(counts), pa.string()),
                    pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64()),
                ],
                names=["lang", "name", "n"],
            )
        held.clear()

    for batch in batches:
        for language, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = held.setdefault(language, Counter())
            words = _words(text)
            counts.update(words)
            counts.update(dict(zip(_OTHER_COUNTS, [*class_counts(text).tolist(), len(words)], strict=True)))
        if sum(map(len, held.values())) > _NAMES_HELD:
            yield from handed_on()
    yield from handed_on()


def references(docs: DataFrame) -> References:
    """From all rows with text and lang. The driver gets CLASSES + COMMON_WORDS + 1 counts per
    language; more than MAX_LANGUAGES languages raise an error."""
    most = COMMON_WORDS + len(_OTHER_COUNTS)
    by_count = Window.partitionBy("lang").orderBy(
        F.col("name").startswith("#").desc(), F.desc("n"), "name"
    )
    rows = (
        docs.where("lang is not null and text is not null")
        .select("lang", "text")
        .mapInArrow(_counted, "lang string, name string, n long")
        .groupBy("lang", "name").agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(by_count))
        .where(F.col("place") <= most)
        .limit((MAX_LANGUAGES + 1) * most).collect()
    )
    of: dict[str, dict[str, int]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.place)):
        of.setdefault(r.lang, {})[r.name] = r.n
    if len(of) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the lang column")
    classes, words, shares = [], [], []
    for counts in of.values():
        *by_class, total = (counts.pop(name, 0) for name in _OTHER_COUNTS)
        classes.append(by_class)
        words.append({word: i for i, word in enumerate(counts)})
        shares.append(np.array([*counts.values(), total - sum(counts.values())], float))
    return References(list(of), np.array(classes, float).reshape(-1, CLASSES), words, shares)


def repeated_words(words: list[str]) -> int:
    """Words inside windows of REPEAT_WINDOW words that the text has twice or more."""
    count = len(words) - REPEAT_WINDOW + 1
    if count < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(count, np.uint64)
    for i in range(REPEAT_WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count]
        windows ^= windows >> np.uint64(32)
    _, group, size = np.unique(windows, return_inverse=True, return_counts=True)
    places = np.flatnonzero(size[group] > 1)
    if not len(places):
        return 0
    # The words themselves decide.
    seen: dict[tuple, int] = {}
    grams = [tuple(words[p : p + REPEAT_WINDOW]) for p in places.tolist()]
    for gram in grams:
        seen[gram] = seen.get(gram, 0) + 1
    covered = np.zeros(len(words) + 1, np.int64)
    for p, gram in zip(places.tolist(), grams, strict=True):
        if seen[gram] > 1:
            covered[p] += 1
            covered[p + REPEAT_WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


_PLAIN = str.maketrans(WHITE_SPACE, " " * len(WHITE_SPACE))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = [w for w in text.translate(_PLAIN).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(WHITE_SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE_SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RESULT = T.StructType(
    [T.StructField(f, T.LongType()) for f in _FIELDS]
    + [
        T.StructField("class_distance", T.DoubleType()), T.StructField("class_language", T.StringType()),
        T.StructField("word_distance", T.DoubleType()), T.StructField("word_language", T.StringType()),
    ]
)


def limits(measured: DataFrame, kind: str) -> DataFrame:
    """(language, limit) from the distances of all the language's documents that pass the base
    rules."""
    at = F.percentile_approx(f"{kind}_distance", [0.25, 0.5], 10_000)
    return (
        measured.where(~F.col("base_failed") & F.col("lang").isNotNull() & F.col(f"{kind}_distance").isNotNull())
        .groupBy(F.col("lang").alias(f"{kind}_language"))
        .agg((at[1] + F.greatest(SPREADS * (at[1] - at[0]), F.lit(LEAST_MARGIN))).alias(f"{kind}_limit"))
    )


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept, and distances
    with their limits, null if not judged.

    ``docs`` needs doc_id, text and lang; other columns are not read. A null text has no words
    and fails the base rules, as an empty one does. Rows without lang are judged against the
    nearest language of the others; without any reference only the base rules decide. Repeated rows
    are judged alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    known = references(docs)
    shared = spark.sparkContext.broadcast(known)

    @F.arrow_udf(_RESULT)
    def measured(texts: pa.Array, languages: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        counts = np.array([base_counts(t) for t in values], np.int64).reshape(-1, len(_FIELDS))
        apart = zip(*(shared.value.distances(t or "", x) for t, x in zip(values, languages.to_pylist()))) if values else [[]] * 4
        kinds = (pa.float64(), pa.string()) * 2
        return pa.StructArray.from_arrays(
            [*(pa.array(c) for c in counts.T), *map(pa.array, apart, kinds)], names=_RESULT.names
        )

    base_failed = (F.col("n_words") < LEAST_BASE_WORDS) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    )
    found = stage(
        docs.select("doc_id", "lang", measured("text", "lang").alias("found")).select("doc_id", "lang", "found.*")
        .withColumn("base_failed", base_failed),
        "quality",
    )
    ceilings = spark.createDataFrame(known.ceilings(), "word_language string, ceiling double")
    near = F.lit(True)
    for kind in ("class", "word"):
        limit = limits(found, kind)
        if kind == "word":
            limit = limit.join(ceilings, "word_language").withColumn("word_limit", F.least("word_limit", "ceiling")).drop("ceiling")
        found = found.join(limit, f"{kind}_language", "left")
        near &= F.coalesce(F.col(f"{kind}_distance") <= F.col(f"{kind}_limit"), F.lit(True))
    return found.select(
        "doc_id", *_FIELDS, "base_failed", (~F.col("base_failed") & near).alias("kept"),
        "class_distance", "class_limit", "word_distance", "word_limit",
    )


def op5_quality_divergence(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
