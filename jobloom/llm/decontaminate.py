"""Benchmark decontamination by winnowed word k-grams.

Both sides keep, of every ``WINDOW`` consecutive k-gram hashes, the least (the last of equal
ones). A shared run of ``K + WINDOW - 1`` words holds one such window whole, so both sides
keep the same k-gram of it: no shared run of ten words is missed. Kept k-grams are joined,
and each hit is extended word by word to both sides; ten equal words or more are a match.

An item of fewer than ten words is matched whole: its single n-gram is looked for at every
place of a document.

Most documents share nothing with any item. A filter of fixed size over the item
fingerprints, two bits each, drops their k-grams before the shuffle; what it lets through
by chance falls in the join. A fuller filter only lets more through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import LOWER, LOWER_BYTES, prepare, table, utf8
from jobloom.session import stage

K = 5
WINDOW = 6
SPAN = K + WINDOW - 1  # words that a match needs
SIDE = SPAN - K  # words that decide a match, on each side of a kept k-gram
FILTER_BITS = 22

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
SEEDS = (
    "array<struct<print:bigint,place:int,size:int,gram:string,"
    "before:array<string>,after:array<string>>>"
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


_IS_WORD = np.array([WORD.fullmatch(chr(b)) is not None or b >= 0x80 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> list[np.ndarray]:
    """The first powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(1 << (size - 1).bit_length(), base, np.uint64)
            factors[0] = 1
            _POWERS[i] = np.multiply.accumulate(factors)
    return _POWERS


class Words:
    """The words of a text as places in its lower-cased UTF-8 bytes, with their hashes.

    The hash of a word is a polynomial in its bytes, so one running sum over the text serves
    all words.
    """

    def __init__(self, text: str | None):
        self.data = utf8(text or "").translate(LOWER_BYTES)
        points = np.frombuffer(self.data, np.uint8)
        inside = np.concatenate(([False], _IS_WORD[points], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        power, inverse = _powers(len(points) + 1)
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * power[: len(points)], out=total[1:])
        value = (total[self.ends] - total[self.starts]) * inverse[self.starts]
        self.hashes = (value ^ (value >> np.uint64(31))) * _MIX

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, part: slice) -> list[str]:
        return [
            self.data[a:b].decode("utf-8", "surrogatepass")
            for a, b in zip(self.starts[part].tolist(), self.ends[part].tolist(), strict=True)
        ]


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.empty(0, np.uint64)
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = total * _FACTOR + hashes[i : i + count]
        total ^= total >> np.uint64(29)
    total *= _MIX
    return total ^ (total >> np.uint64(32))


def winnowed(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the k-grams that winnowing keeps: the last least one of every window."""
    if len(grams) == 0:
        return np.empty(0, np.int64)
    window = min(window, len(grams))
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    latest = window - 1 - np.argmin(views[:, ::-1], axis=1)
    return np.unique(latest + np.arange(len(views)))


def _filter_places(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.uint64(64 - FILTER_BITS)
    return prints >> bits, (prints << np.uint64(FILTER_BITS)) >> bits


def _rows(words: Words, size: int, grams: np.ndarray, places: np.ndarray, sides: bool):
    for p in places.tolist():
        yield {
            "print": int(grams[p].view(np.int64)),
            "place": p,
            "size": size,
            "gram": " ".join(words[p : p + size]),
            # Nearest word first.
            "before": words[max(0, p - SIDE) : p][::-1] if sides else [],
            "after": words[p + size : p + size + SIDE] if sides else [],
        }


def _item_seeds(text: str | None) -> list[dict]:
    words = Words(text)
    if not len(words):
        return []
    hashes = words.hashes
    if len(words) < SPAN:
        # Sizes of whole short items are told apart from k-grams by their sign.
        grams = _grams(hashes, len(words))
        rows = list(_rows(words, len(words), grams, np.zeros(1, np.int64), False))
        return [row | {"size": -len(words)} for row in rows]
    grams = _grams(hashes, K)
    return list(_rows(words, K, grams, winnowed(grams), True))


def _doc_seeds(words: Words, short_sizes: list[int], bits: np.ndarray) -> list[dict]:
    hashes = words.hashes

    def hit(prints: np.ndarray) -> np.ndarray:
        a, b = _filter_places(prints)
        return (bits[a >> 3] >> (a & 7) & bits[b >> 3] >> (b & 7) & 1).astype(bool)

    found = []
    grams = _grams(hashes, K)
    if hit(grams).any():
        places = winnowed(grams)
        found += _rows(words, K, grams, places[hit(grams[places])], True)
    for size in short_sizes:
        grams = _grams(hashes, size)
        rows = _rows(words, size, grams, np.flatnonzero(hit(grams)), False)
        found += [row | {"size": -size} for row in rows]
    return found


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = _seed_type()
    for batch in batches:
        seeds = [_item_seeds(t) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(seeds, kind)], names=["item_id", "seeds"])


def _seed_type() -> pa.DataType:
    return pa.list_(
        pa.struct(
            [
                ("print", pa.int64()), ("place", pa.int32()), ("size", pa.int32()),
                ("gram", pa.string()), ("before", pa.list_(pa.string())),
                ("after", pa.list_(pa.string())),
            ]
        )
    )


def _filter_of(seeds: DataFrame) -> np.ndarray:
    """The filter's bytes. At most 2**FILTER_BITS / 64 numbers come to the driver."""
    high, low = F.shiftrightunsigned("print", 64 - FILTER_BITS), F.shiftrightunsigned(
        F.shiftleft("print", FILTER_BITS), 64 - FILTER_BITS
    )
    words = (
        seeds.select(F.explode(F.array(high, low)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
        .collect()
    )
    numbers = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in words:
        numbers[row.word] = row.bits
    return numbers.view(np.uint8)


def _equal_run(a: str, b: str) -> Column:
    """How many words two lists have in common from their beginning."""
    return F.expr(
        f"size(filter(sequence(1, {SIDE}), n -> n <= size({a}) and n <= size({b})"
        f" and slice({a}, 1, n) = slice({b}, 1, n)))"
    )


def matches(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, spans). Documents: doc_id, text_hash, n_words, one row per row of ``docs``.
    Spans: doc_id, text_hash, item_id, first, last (word places, last not included)."""
    spark = docs.sparkSession
    prepare(spark)
    item_seeds = stage(
        items.select("item_id", "text")
        .mapInArrow(_item_batches, f"item_id {dict(items.dtypes)['item_id']}, seeds {SEEDS}")
        .select("item_id", F.inline("seeds")),
        "item_seeds",
    )
    bits = spark.sparkContext.broadcast(_filter_of(item_seeds))
    short = sorted(-r[0] for r in item_seeds.where("size < 0").select("size").distinct().collect())

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _seed_type()
        for batch in batches:
            counts, seeds = [], []
            for text in batch.column(2).to_pylist():
                words = Words(text)
                counts.append(len(words))
                seeds.append(_doc_seeds(words, short, bits.value))
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1),
                    pa.array(counts, pa.int64()), pa.array(seeds, kind),
                ],
                names=["doc_id", "text_hash", "n_words", "seeds"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    counted = stage(
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            marked, f"doc_id {kind}, text_hash long, n_words long, seeds {SEEDS}"
        ),
        "doc_seeds",
    )
    doc_side = (
        counted.where("size(seeds) > 0")
        .select("doc_id", "text_hash", F.inline("seeds"))
        .alias("d")
    )
    joined = doc_side.join(
        item_seeds.alias("i"),
        F.expr("d.print = i.print and d.size = i.size and d.gram = i.gram"),
    ).select(
        "d.doc_id", "d.text_hash", "i.item_id", "d.place", "d.size",
        _equal_run("d.before", "i.before").alias("left"),
        _equal_run("d.after", "i.after").alias("right"),
    )
    spans = joined.where(f"size < 0 or left + size + right >= {SPAN}").select(
        "doc_id", "text_hash", "item_id",
        (F.col("place") - F.col("left")).alias("first"),
        (F.col("place") + F.abs("size") + F.col("right")).alias("last"),
    )
    return counted.select("doc_id", "text_hash", "n_words"), spans


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are not read.
    A null text has no words and no hits. Repeated documents get a row each, repeated items
    count once, a null item_id takes part in hits and not in the item count. Empty tables
    give no rows, or rows without hits.
    """
    counted, spans = matches(docs, items)
    key = ["doc_id", "text_hash"]
    spans = stage(spans.distinct(), "spans")
    order = Window.partitionBy(*key).orderBy("first", "last")
    covered_to = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hit = (
        spans.select(*key, "first", "last")
        .distinct()
        .withColumn("from", F.greatest("first", F.coalesce(covered_to, F.lit(0))))
        .groupBy(*key)
        .agg(F.sum(F.greatest(F.col("last") - F.col("from"), F.lit(0))).alias("n_hit"))
    )
    named = (
        spans.select(*key, "item_id")
        .distinct()
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("ids"))
        .select(
            *key, F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
        )
    )
    found = hit.join(named, _same(hit, named)).select(
        hit.doc_id.alias("hit_id"), hit.text_hash.alias("hit_hash"),
        "n_hit", "n_items", "items_sha256",
    )
    none = F.sha2(F.lit("").cast("binary"), 256)
    return counted.join(
        found,
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")),
        "left",
    ).select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a.doc_id.eqNullSafe(b.doc_id) & (a.text_hash == b.text_hash)


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text shares a match with an item; all columns stay."""
    _, spans = matches(docs, items)
    hit = spans.select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")
    ).distinct()
    hit = stage(hit, "hit")
    same = docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_hash"])
    return docs.join(hit, same, "left_anti")


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
