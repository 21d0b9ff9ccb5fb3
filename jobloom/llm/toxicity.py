"""Toxicity by weak supervision.

1. Voters look at a text (``toxicity_votes``): word lists by language and kind, patterns such
   as masked or spaced insults, and families of mined words and word beginnings. Each votes
   toxic, clean, or not at all. Mined features are those that training rows labelled toxic
   have significantly and far more often than the others.
2. A generative label model estimates by EM how often each voter votes what in each class,
   and how strongly voters agree beyond the class and beyond what their construction makes
   them; voters that repeat one another count less. It starts from the labelled training
   rows, is fitted to the votes on all documents, and gives every training text a
   probability.
3. A linear classifier (logistic, L1) on the features is trained on those probabilities.

Mining and the prior count all labelled training rows, near copies once; the label model
counts the votes on all documents. Only the classifier is fitted on a bounded sample of the
labelled training texts (SAMPLE_TOXIC, SAMPLE_CLEAN), weighted back to the classes' true
sizes; so of the mined features those count that its toxic texts have, and that bounds
the model. Texts are described where they are read; what is shuffled are their different
words, without repeats, of the training folds alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import id_crc, prepare, table, utf8
from jobloom.llm.minhash import least_values, shingles
from jobloom.llm.toxicity_votes import (
    BEGINNINGS,
    LEXICONS,
    PATTERNS,
    Cues,
    distinct_features,
    features_of,
    patterns_of,
    wider,
    without_blurred,
    words_of,
)
from jobloom.session import stage

FOLDS = 3
HELD_OUT_FOLD = 1
THRESHOLD = 0.7
# Labelled texts that the classifier is fitted on at most, by label; those of the least hash.
SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 8000
# Mined features: least number of unlike toxic texts, least log-ratio, and the number of
# features that may seem toxic by chance alone.
LEAST_TEXTS = 4
LEAST_LOG_RATIO = 3.0
BY_CHANCE = 0.05
L1 = 2e-4
ROUNDS = 12
# Labelled texts with a certain vote that each class may have besides those seen, and how
# many times all documents together the labelled rows weigh.
DOUBT = 5.0
KNOWN_WEIGHT = 10.0
COPY_VALUES = 4  # texts that agree in so many least values of MinHash count once
FILTER_BITS = 22
FEATURES_HELD = 200_000  # entries that a task counts before it hands them on


def _copy_key(text: str | None) -> int:
    """Equal for copies, and mostly for near copies; never, but by chance, for unlike texts."""
    least = least_values(shingles(utf8(text or "")), COPY_VALUES)
    return xxhash.xxh64_intdigest(least.tobytes()) - (1 << 63)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, copy, words, patterns) of texts: the different words in order."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        words = [words_of(t) for t in texts]
        distinct = list(map(set, words))
        yield pa.record_batch(
            [
                batch.column(0), pa.array(map(_copy_key, texts), pa.int64()),
                pa.array([" ".join(sorted(d)) for d in distinct], pa.string()),
                pa.array(map(patterns_of, texts, words, distinct), pa.int32()),
            ],
            names=["doc_id", "copy", "words", "patterns"],
        )


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, copy, words, patterns) of all labelled rows outside the held-out fold, one row
    for each group of near copies: that of the first words."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(id_crc() % FOLDS != HELD_OUT_FOLD)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("long").alias("toxic"))
    )
    return (
        docs.where(id_crc() % FOLDS != HELD_OUT_FOLD)
        .select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(_described, "doc_id long, copy long, words string, patterns int")
        # Labels of a small table would be sent to all; the plan is to be the same at every size.
        .join(known.hint("merge"), "doc_id")
        .groupBy("toxic", "copy").agg(F.min(F.struct("words", "patterns")).alias("text"))
        .select("toxic", "copy", "text.words", "text.patterns")
    )


def _totals(rows: DataFrame) -> tuple[int, int]:
    """Groups of toxic and of clean texts."""
    found = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    return found.get(1, 0), found.get(0, 0)


def _feature_counts(rows: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """(feature, n): the rows that have it, summed within the task as long as there is room;
    with ``bits`` only of features that pass this filter."""
    shared = bits is not None and rows.sparkSession.sparkContext.broadcast(bits)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        passes: dict[str, bool] = {}

        def rows_of() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())]
            counts.clear()
            passes.clear()
            return pa.record_batch(arrays, names=["feature", "n"])

        def wanted(feature: str) -> bool:
            found = passes.get(feature)
            if found is None:
                place = xxhash.xxh64_intdigest(utf8(feature), 42) >> (64 - FILTER_BITS)
                found = passes[feature] = bool(shared.value[place >> 3] >> (place & 7) & 1)
            return found

        for batch in batches:
            for words in batch.column(0).to_pylist():
                found = features_of(set(words.split(" ")))
                counts.update(filter(wanted, found) if shared else found)
                if len(counts) + len(passes) // 4 > FEATURES_HELD:
                    yield rows_of()
        yield rows_of()

    return (
        rows.select("words").mapInArrow(counted, "feature string, n long")
        .groupBy("feature").agg(F.sum("n").alias("n"))
    )


def _filter_of(features: DataFrame) -> np.ndarray:
    """A filter of 2**FILTER_BITS bits, of which at most a 64th as many numbers come to the
    driver. A fuller filter only lets more features through to the join."""
    bit = F.shiftrightunsigned(F.xxhash64("feature"), 64 - FILTER_BITS)
    found = (
        features.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).collect()
    )
    numbers = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in found:
        numbers[row.word] = row.bits
    return numbers.view(np.uint8)


def _counted(rows: DataFrame) -> DataFrame:
    """(feature, a, b): the toxic and clean groups of all features of LEAST_TEXTS toxic ones."""
    candidates = stage(
        _feature_counts(rows.where("toxic = 1")).where(F.col("n") >= LEAST_TEXTS)
        .select("feature", F.col("n").alias("a")),
        "toxicity-candidates",
    )
    others = _feature_counts(rows.where("toxic = 0"), _filter_of(candidates))
    counted = candidates.join(others, "feature", "left")
    return stage(counted.select("feature", "a", F.coalesce("n", F.lit(0)).alias("b")), "toxicity-counted")


def _typical(counted: DataFrame, toxic: int, clean: int) -> DataFrame:
    """The features that are typical of toxic groups.

    By Chernoff's bound, a feature without relation to the label has its share of toxic
    groups with a chance of at most exp(-n * divergence); over all candidates BY_CHANCE of
    them may pass.
    """
    number = counted.count()
    n, share = F.col("a") + F.col("b"), toxic / (toxic + clean)
    own = F.col("a") / n
    rest = F.when(F.col("b") > 0, (1 - own) * F.log((1 - own) / F.lit(1 - share))).otherwise(0.0)
    divergence = own * F.log(own / F.lit(share)) + rest
    ratio = F.log((F.col("a") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("b") + 0.5) / F.lit(clean + 1.0))
    surprise = math.log(max(number, 1) / BY_CHANCE)
    return counted.where((ratio >= LEAST_LOG_RATIO) & (own > share) & (n * divergence >= surprise))


def _sample(rows: DataFrame) -> DataFrame:
    """At most SAMPLE_TOXIC + SAMPLE_CLEAN of the labelled texts, by the hash of their words."""
    def least(value: int, most: int) -> DataFrame:
        of_label = rows.where(F.col("toxic") == value)
        return of_label.orderBy(F.xxhash64("words"), "words", "copy").limit(most)

    return stage(least(1, SAMPLE_TOXIC).union(least(0, SAMPLE_CLEAN)), "toxicity-sample")


def _features(counted: DataFrame, sample: DataFrame, totals: tuple[int, int]) -> list[str]:
    """The mined features, of those that the sample's toxic texts have, which bounds them."""
    spark = counted.sparkSession
    seen = _feature_counts(sample.where("toxic = 1")).select("feature")
    counts = {
        r.feature: (r.a, r.b)
        for r in _typical(counted, *totals).join(seen, "feature", "left_semi").collect()
    }
    wide = spark.createDataFrame([(w,) for w in sorted({w for f in counts for w in wider(f)})], "feature string")
    stems = F.array_distinct(F.transform(
        F.array(*map(F.lit, BEGINNINGS)), lambda n: F.substring(F.substring_index("feature", "~", 1), F.lit(1), n)
    ))
    # How many candidates begin alike.
    crowds = counted.select(F.explode(stems).alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("candidates"))
    around = {
        r.feature: (r.a, r.b, r.candidates)
        for r in counted.join(wide, "feature")
        .withColumn("stem", F.substring_index("feature", "~", 1)).join(crowds, "stem").collect()
    }
    kept = distinct_features(counts, around, BY_CHANCE)
    return without_blurred({f: counts[f] for f in kept})


def _vote_kinds(docs: DataFrame, cues: Cues) -> DataFrame:
    """(votes, n): kinds of votes on all documents, and how many documents have each."""
    shared = docs.sparkSession.sparkContext.broadcast(cues)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())]
            counts.clear()
            return pa.record_batch(arrays, names=["votes", "n"])

        for batch in batches:
            found = [shared.value.of(t) for t in batch.column(0).to_pylist()]
            counts.update(vote.tobytes() for vote in shared.value.votes(found))
            if len(counts) > FEATURES_HELD:
                yield rows()
        yield rows()

    return (
        docs.select(F.col("text").cast("string")).mapInArrow(counted, "votes binary, n long")
        .groupBy("votes").agg(F.sum("n").alias("n"))
    )


class LabelModel:
    """P(toxic | votes) from a naive model of the voters, with correlated voters sharing
    their weight.

    What the labelled training rows show of the voters is its start and stays in the sums of
    every round; a voter that votes alone could not be told from a wrong one otherwise. Every
    round of EM is one pass over the kinds of votes, which brings the sums and products of
    the voters in each class to the driver, voters x voters numbers.
    """

    def __init__(self, known: np.ndarray, prior: float, built_in: np.ndarray):
        self.known, self.prior, self.built_in = known, prior, built_in
        self.update(known, DOUBT)

    def fit(self, kinds: DataFrame, rounds: int = ROUNDS) -> LabelModel:
        """``kinds`` has votes and n, the number of documents with these votes."""
        for _ in range(rounds):
            guessed = vote_sums(kinds, self.sums, len(self.built_in))
            scale = KNOWN_WEIGHT * guessed[:, 0, 0].sum() / max(self.known[:, 0, 0].sum(), 1)
            self.update(self.known * scale + guessed, DOUBT * scale)
        return self

    def sums(self, votes: np.ndarray, size: np.ndarray) -> np.ndarray:
        chance = self.posterior(votes)
        return np.stack([_products(votes, share * size) for share in (1 - chance, chance)])

    def update(self, total: np.ndarray, doubt: float) -> None:
        """Accuracies and weights from the sums of the two classes; ``doubt`` is added to how
        often each vote was seen in each class."""
        self.accuracy = []
        residual = np.zeros([len(self.built_in)] * 2)
        for sums in total:
            mass, first, second = sums[0, 0], sums[0, 1:], sums[1:, 1:]
            square = np.diag(second)
            votes = np.stack(((square - first) / 2, mass - square, (square + first) / 2), axis=1)
            votes = np.maximum(votes, 0) + doubt
            self.accuracy.append(votes / votes.sum(axis=1, keepdims=True))
            residual += second - np.outer(first, first) / max(mass, 1e-9)
        self.log_ratio = np.log(self.accuracy[1]) - np.log(self.accuracy[0])
        self.log_ratio[:, 1] = 0  # no vote says nothing
        scale = np.sqrt(np.maximum(np.diag(residual), 1e-9))
        self.correlation = residual / np.outer(scale, scale)
        # Voters that exclude each other, as those of two languages do, repeat nothing.
        beyond = np.where(self.built_in, 0, self.correlation)
        self.repeats = np.where(beyond > 0.1, beyond, 0).clip(0, 1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) of texts x voters."""
        said = np.take_along_axis(self.log_ratio, votes.T.astype(np.int64) + 1, axis=1).T
        # A vote is shared with the votes that it goes together with.
        shared = 1 + (votes != 0) @ self.repeats
        score = math.log(self.prior / (1 - self.prior)) + (said / shared).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def _products(votes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Weighted sums of products of the voters, and of one more that always votes 1."""
    wide = np.concatenate((np.ones((len(votes), 1)), votes), axis=1)
    return (wide * size[:, None]).T @ wide


def vote_sums(votes: DataFrame, sums, voters: int) -> np.ndarray:
    """class x (1 + voters) x (1 + voters): ``sums`` of all rows (votes, n).

    Tasks hand on whole numbers, in units of 2**-20, so their order changes nothing.
    """
    width = 1 + voters

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width, width))
        for batch in batches:
            rows = np.array([np.frombuffer(v, np.int8) for v in batch.column(0).to_pylist()], np.int8)
            total += sums(rows.reshape(len(rows), voters), batch.column(1).to_numpy())
        at = np.flatnonzero(total.ravel())
        values = np.round(total.ravel()[at] * (1 << 20)).astype(np.int64)
        yield pa.record_batch([pa.array(at), pa.array(values)], names=["at", "value"])

    found = (
        votes.select("votes", "n").mapInArrow(summed, "at long, value long")
        .groupBy("at").agg(F.sum("value").alias("value")).collect()
    )
    total = np.zeros(2 * width * width)
    for row in found:
        total[row["at"]] = row["value"] / (1 << 20)
    return total.reshape(2, width, width)


def _by_label(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    return np.stack([_products(votes, toxic == value) for value in (0, 1)])


def _labelled_votes(rows: DataFrame, cues: Cues) -> DataFrame:
    """(votes, n) of the labelled groups; n is the label."""
    shared = rows.sparkSession.sparkContext.broadcast(cues)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(*(batch.column(i).to_pylist() for i in range(2)))
            votes = shared.value.votes([shared.value.of_words(set(w.split(" ")), p) for w, p in texts])
            yield pa.record_batch(
                [pa.array([v.tobytes() for v in votes], pa.binary()), batch.column(2)], names=["votes", "n"]
            )

    return rows.select("words", "patterns", "toxic").mapInArrow(voted, "votes binary, n long")


def _logistic(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, width: int):
    """L1-penalised logistic regression on 0/1 features, by accelerated proximal steps."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((f for r in rows for f in r), np.int64, len(at))
    weight = weight / weight.sum()
    most = np.bincount(at, minlength=len(rows)).max(initial=0) + 1
    step = 4.0 / min(most, 50)
    w, b = np.zeros(width), 0.0
    wy, by, t = w, b, 1.0
    for _ in range(1500):
        score = np.bincount(at, wy[col], len(rows)) + by
        gap = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target)
        moved = wy - step * np.bincount(col, gap[at], width)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
        new_b = by - step * gap.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wy = new_w + (t - 1) / new_t * (new_w - w)
        by = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b


@dataclass
class ToxicityModel:
    cues: Cues
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> list[float]:
        rows = self.cues.columns([self.cues.of(t) for t in texts])
        score = np.array([self.bias + sum(self.weights[f] for f in row) for row in rows], float)
        return np.round(1 / (1 + np.exp(-np.clip(score, -30, 30))), 9).tolist()


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the labelled rows outside the held-out fold, and on the votes on all documents.
    Without rows of both labels the word lists and patterns alone decide: one is not enough,
    two are."""
    rows = stage(_labelled(docs, labels), "toxicity-labelled")
    totals = _totals(rows)
    if not all(totals):
        return ToxicityModel(Cues({}), np.full(len(LEXICONS) + len(PATTERNS), 3.0), -4.0)
    sample = _sample(rows)
    cues = Cues({f: i for i, f in enumerate(_features(_counted(rows), sample, totals))})
    known = vote_sums(_labelled_votes(rows, cues), _by_label, cues.voters)
    model = LabelModel(known, totals[0] / sum(totals), cues.built_in())
    model.fit(stage(_vote_kinds(docs, cues), "toxicity-votes"))
    taken = sample.select("toxic", "words", "patterns").toArrow()
    toxic = taken.column("toxic").to_numpy()
    found = [
        cues.of_words(set(w.split(" ")), p)
        for w, p in zip(*(taken.column(c).to_pylist() for c in ("words", "patterns")), strict=True)
    ]
    weights, bias = _logistic(
        cues.columns(found), model.posterior(cues.votes(found)), _sample_weights(toxic, totals), cues.width
    )
    return ToxicityModel(cues, weights, bias)


def _sample_weights(toxic: np.ndarray, totals: tuple[int, int]) -> np.ndarray:
    """Each side weighs as all its groups."""
    weight = np.ones(len(toxic))
    for value, total in zip((1, 0), totals, strict=True):
        side = toxic == value
        weight[side] = total / max(side.sum(), 1)
    return weight


def toxicity_of(model: ToxicityModel, text: Column, docs: DataFrame) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts.to_pylist()), pa.float64())

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are not read.
    Null and empty texts get the score of a text without features. A null doc_id is not
    held out and has no label. Of several labels of a document the largest counts. Repeated
    rows are scored alike. Empty tables give no rows, empty labels the word lists' score.
    """
    prepare(docs.sparkSession)
    scored = docs.select(
        "doc_id", toxicity_of(fit(docs, labels), F.col("text"), docs).alias("score")
    )
    return scored.select(
        "doc_id",
        F.coalesce(id_crc() % FOLDS == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    prepare(docs.sparkSession)
    return docs.where(toxicity_of(fit(docs, labels), docs["text"], docs) < THRESHOLD)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
