"""MinHash document fingerprints.

A text's shingles are runs of five words. Each of PERMUTATIONS universal hash functions
``a * x + b`` modulo 2**64, with odd ``a``, permutes the 64-bit hashes of the shingles, and
the least value of a text under each makes its signature. Two texts agree in a place with
the probability of their Jaccard likeness, so the share of equal places estimates it. Of
each least value 16 bits are kept; they agree by chance once in 65,536.

``near_duplicates`` joins bands of the signature in Spark and verifies each candidate pair by
the exact Jaccard likeness of the whole shingle sets. ``fingerprint_documents`` compares
each document with an edited text and with the next document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import LOWER_BYTES, WHITE_SPACE, partitions, prepare, table, utf8
from jobloom.llm.components import components
from jobloom.session import stage

SHINGLE_WORDS = 5
PERMUTATIONS = 128
LEAST_LIKENESS = 0.8
# Two texts of likeness 0.8 share one of the bands at least in 99.995 % of cases.
BANDS, BAND_ROWS = 25, 5
EDITED_PART = 4  # the last 1/4 of a text is replaced

_SEED = 42
_PIECE = 512  # shingles that are permuted at one time
_BLOCK = 1 << 18  # bytes whose words are hashed at one time, or one word
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_EMPTY = np.full(PERMUTATIONS, np.iinfo(np.uint64).max)

_random = np.random.default_rng(_SEED)
_A = _random.integers(0, 1 << 64, (PERMUTATIONS, 1), np.uint64) | np.uint64(1)
_B = _random.integers(0, 1 << 64, (PERMUTATIONS, 1), np.uint64)
# A number for each byte of a word; white space has none.
_BYTE = _random.integers(1, 1 << 64, 256, np.uint64)
_IS_WORD = np.array([chr(b) not in WHITE_SPACE for b in range(256)])
_BYTE[~_IS_WORD] = 0
_BASE = 0xD1B54A32D192ED03
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """The first powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(1 << (size - 1).bit_length(), base, np.uint64)
            factors[0] = 1
            _POWERS[i] = np.multiply.accumulate(factors)
    return _POWERS


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word: a polynomial in its bytes."""
    points = np.frombuffer(data.translate(LOWER_BYTES), np.uint8)
    inside = np.concatenate(([False], _IS_WORD[points], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    found, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        begin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + _BLOCK, "right")))
        size = int(ends[last - 1] - begin)
        power, inverse = _powers(size)
        at = starts[first:last] - begin
        values = np.add.reduceat(_BYTE[points[begin : begin + size]] * power[:size], at)
        found[first:last] = values * inverse[at]
        first = last
    found = (found ^ (found >> np.uint64(31))) * _MIX
    return found ^ (found >> np.uint64(29))


def _runs(hashes: np.ndarray) -> np.ndarray:
    """A hash of each run of SHINGLE_WORDS words; of all words where there are fewer."""
    if not len(hashes):
        return hashes
    size = min(SHINGLE_WORDS, len(hashes))
    count = len(hashes) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = total * _FACTOR + hashes[i : i + count]
        total ^= total >> np.uint64(29)
    total *= _MIX
    return total ^ (total >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the shingles of a text in UTF-8, repeats included."""
    return _runs(_word_hashes(text))


def least_values(hashes: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """The least value of the hashes under each permutation; of no hashes, the largest number."""
    least = _EMPTY[:permutations].copy()
    room = np.empty((permutations, min(_PIECE, len(hashes))), np.uint64)
    for i in range(0, len(hashes), _PIECE):
        piece = hashes[i : i + _PIECE]
        values = room[:, : len(piece)]
        np.multiply(_A[:permutations], piece, out=values)
        np.add(values, _B[:permutations], out=values)
        np.minimum(least, values.min(axis=1), out=least)
    return least


def signature(least: np.ndarray) -> np.ndarray:
    return (least >> np.uint64(16)).astype("<u2")


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of equal places of two signatures. Two texts without words are alike."""
    return float((one == other).mean())


def text_signature(text: str | None) -> np.ndarray:
    return signature(least_values(shingles(utf8(text or ""))))


def edited_signature(kept: bytes, head: bytes, tail: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of ``kept + tail`` and ``kept + head``: what they share is worked out once.

    The words of ``kept`` but the last, which may go on, begin both texts.
    """
    plain = kept.rstrip(WHITE_SPACE.encode())
    cut = max((plain.rfind(c.encode()) for c in WHITE_SPACE), default=-1) + 1
    before, rest = _word_hashes(kept[:cut]), kept[cut:]
    whole = least_values(_runs(before)) if len(before) >= SHINGLE_WORDS else _EMPTY
    found = []
    for end in (tail, head):
        words = np.concatenate((before[max(0, len(before) - SHINGLE_WORDS + 1) :], _word_hashes(rest + end)))
        # With few words before, these are all of the text's; else runs that end in the rest.
        some = least_values(_runs(words)) if len(words) >= SHINGLE_WORDS or len(before) < SHINGLE_WORDS else _EMPTY
        found.append(signature(np.minimum(whole, some)))
    return found[0], found[1]


# --- documents beside their edited text and the next document ---------------------------------

_SHAPE = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_ARROW_SHAPE = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
_LEAST_ID = -(1 << 63)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, place, text, sent) in descending order of place: each with the text of
    the place after it, which is that of the last row of another place before it."""
    place, text, sign = None, None, None  # of the row before
    next_text, next_sign = None, None
    for batch in batches:
        rows = []
        for doc_id, at, own, sent in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if sent:  # it begins a range
                place, text, sign = None, own, None
                continue
            if at != place:
                next_text, next_sign = text, sign
            place, text, sign = at, own, None
            if next_sign is None:
                next_sign = text_signature(next_text)
            kept = len(own) - len(own) // EDITED_PART
            head, tail = next_text[: len(own) - kept].encode(), own[kept:].encode()
            begin = own[:kept].encode()
            sign, edited = edited_signature(begin, head, tail)
            rows.append(
                (
                    doc_id, len(own), hashlib.sha256(begin + head).hexdigest(), sign.tobytes().hex(),
                    edited.tobytes().hex(), likeness(sign, edited), likeness(sign, next_sign),
                )
            )
        if rows:
            arrays = map(pa.array, zip(*rows), _ARROW_SHAPE.types)
            yield pa.record_batch(list(arrays), schema=_ARROW_SHAPE)


class _Ranges:
    """Ranges of places with about equal numbers of rows, and what each needs from others.

    A place so frequent that whole ranges lie within it is dealt over those. What comes to
    the driver is bounded by the number of ranges.
    """

    def __init__(self, keyed: DataFrame, number: int):
        parts = [i / number for i in range(1, number)] or [0.5]
        accuracy = max(10_000, 20 * number)
        bounds = keyed.agg(F.percentile_approx("place", parts, accuracy).alias("at")).first().at or []
        self.bounds = np.array(bounds[: number - 1], np.int64)
        values, first, times = np.unique(self.bounds, return_index=True, return_counts=True)
        # Of a place that is k bounds, the k - 1 ranges between them.
        self.dealt = {
            v: (f + 1, f + k) for v, f, k in zip(values.tolist(), first.tolist(), times.tolist()) if k > 1
        }
        usual = keyed.where(~F.col("place").isin(list(self.dealt)))
        ends = (
            usual.groupBy(self.of(F.col("place"), F.lit(0.0)).alias("range"))
            .agg(F.min("place").alias("low"), F.max("place").alias("high")).collect()
        )
        starts = sorted({*(r.low for r in ends), *self.dealt})
        highs = {r.range: r.high for r in ends}
        highs |= {r: v for v, (a, b) in self.dealt.items() for r in range(a, b)}
        #: (place, range): where the least text of this place is needed besides its own range.
        self.sent = [(next((s for s in starts if s > high), starts[0]), r) for r, high in highs.items()]

    def of(self, place: Column, chance: Column) -> Column:
        bounds = self.bounds

        @F.arrow_udf(T.IntegerType())
        def found(places: pa.Array, chances: pa.Array) -> pa.Array:
            at = places.to_numpy(zero_copy_only=False)
            low, high = (np.searchsorted(bounds, at, side) for side in ("left", "right"))
            between = np.maximum(high - low - 1, 1)
            dealt = low + 1 + (chances.to_numpy(zero_copy_only=False) * between).astype(np.int64)
            return pa.array(np.where(high - low > 1, dealt, high), pa.int32())

        return found(place, chance)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    The edited text has the last quarter of the code points replaced by the first as many of
    the next document; what that has not stays away. The next document is the one of the
    next greater doc_id, after the last the first; of rows that share a doc_id, the one of the
    least text. A table with one doc_id only has it as its own next one.

    ``docs`` needs doc_id and text; other columns, whatever their names, are not read. A null
    text counts as empty, a null doc_id as the least one. Texts without a word have a
    fingerprint of their own and are alike. Repeated rows give equal rows, empty tables none.

    Whole texts are shuffled once, by ranges of doc_id, and come sorted downwards, so a task
    holds one text besides its own. Each range gets the one text that follows it.
    """
    spark = docs.sparkSession
    prepare(spark)
    keyed = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST_ID)).alias("place"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    number = partitions(spark)
    ranges = _Ranges(keyed, number)
    firsts = keyed.where(F.col("place").isin([p for p, _ in ranges.sent])).groupBy("place").agg(
        F.min("text").alias("text")
    )
    wanted = spark.createDataFrame(ranges.sent, "place long, range int")
    own = keyed.withColumns({"range": ranges.of(F.col("place"), F.rand(_SEED)), "sent": F.lit(False)})
    sent = firsts.join(wanted, "place").withColumns({"doc_id": F.lit(None).cast("long"), "sent": F.lit(True)})
    return (
        own.unionByName(sent)
        .repartitionById(number, "range")
        .sortWithinPartitions("range", F.desc("sent"), F.desc("place"), F.desc("text"))
        .select("doc_id", "place", "text", "sent")
        .mapInArrow(_compared, _SHAPE)
    )


# --- near duplicates ------------------------------------------------------------------------


@F.arrow_udf(
    T.StructType([T.StructField("signature", T.BinaryType()), T.StructField("content", T.BinaryType())])
)
def _marks(texts: pa.Array) -> pa.Array:
    """The signature of each text, and a digest of its set of shingles."""
    signatures, contents = [], []
    for text in texts.to_pylist():
        hashes = np.unique(shingles(utf8(text or "")))
        signatures.append(signature(least_values(hashes)).tobytes())
        contents.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
    return pa.StructArray.from_arrays(
        [pa.array(signatures, pa.binary()), pa.array(contents, pa.binary())], ["signature", "content"]
    )


@F.arrow_udf(T.ArrayType(T.LongType()))
def _shingle_set(texts: pa.Array) -> pa.Array:
    found = [np.unique(shingles(utf8(t or ""))).view(np.int64) for t in texts.to_pylist()]
    return pa.array(found, pa.list_(pa.int64()))


@F.arrow_udf(T.DoubleType())
def jaccard(one: pa.Array, other: pa.Array) -> pa.Array:
    """Jaccard likeness of sets of shingle hashes. Two empty sets are alike."""
    found = []
    for i in range(len(one)):
        a, b = (side[i].values.to_numpy(zero_copy_only=False) for side in (one, other))
        both = len(np.intersect1d(a, b, assume_unique=True))
        found.append(both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0)
    return pa.array(found, pa.float64())


def _bands(signature: Column) -> Column:
    size = 2 * BAND_ROWS
    return F.array(*(
        F.struct(F.lit(i).alias("band"), F.substring(signature, i * size + 1, size).alias("value"))
        for i in range(BANDS)
    ))


def candidates(sets: DataFrame) -> DataFrame:
    """(high, low) of distinct nodes that share a band, from (node, signature).

    A crowd on one band is not expanded into pairs: sorted by signature, each member is
    compared with the first and with the member before it. Members alike beyond this band
    meet on others, in other company.
    """
    met = sets.select("node", "signature", F.explode(_bands(F.col("signature"))).alias("at"))
    order = Window.partitionBy("at").orderBy("signature", "node")
    lined = met.select(
        "node", F.first("node").over(order).alias("first"), F.lag("node").over(order).alias("before")
    )
    pairs = lined.select("node", F.explode(F.array_distinct(F.array("first", "before"))).alias("other"))
    return (
        pairs.where(F.col("node") != F.col("other"))
        .select(F.greatest("node", "other").alias("high"), F.least("node", "other").alias("low"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, least: float = LEAST_LIKENESS) -> DataFrame:
    """One row per row of ``docs``: doc_id, component_id, the least doc_id of its class.

    Documents are linked if the Jaccard likeness of their sets of five-word shingles is
    ``least`` or more; each link is verified on the whole sets. Texts of equal sets are
    linked without bands. ``docs`` needs doc_id and text; other columns are not read. Null
    and empty texts have the empty set. A null doc_id keeps its row and names no class,
    unless the class has no other. Empty tables give no rows.
    """
    prepare(docs.sparkSession)
    marked = stage(docs.select("doc_id", F.col("text").cast("string"), _marks("text").alias("mark")), "marks")
    sets = stage(
        marked.groupBy(F.col("mark.content").alias("node")).agg(
            F.first("mark.signature").alias("signature"), F.min("doc_id").alias("least_id")
        ),
        "shingle-sets",
    )
    pairs = stage(candidates(sets), "candidates")
    needed = pairs.select(F.explode(F.array("high", "low")).alias("node")).distinct()
    whole = stage(
        marked.select(F.col("mark.content").alias("node"), "text")
        .join(needed, "node")
        .groupBy("node").agg(F.min("text").alias("text"))
        .select("node", _shingle_set("text").alias("shingles")),
        "candidate-sets",
    )
    sides = [
        whole.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_shingles"))
        for side in ("high", "low")
    ]
    compared = pairs.join(sides[0], "high").join(sides[1], "low")
    links = compared.where(jaccard("high_shingles", "low_shingles") >= least).select("high", "low")
    rooted = stage(
        sets.select("node", "least_id").join(components(stage(links, "links")), "node", "left")
        .select("node", "least_id", F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(named, "root").select("node", "component_id")
    ids = marked.select("doc_id", F.col("mark.content").alias("node"))
    return ids.join(classes, "node").select("doc_id", "component_id")


def op13_minhash_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
