"""SimHash near-duplicates, linked by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most three bits have a value between them, one bit from
the one and two bits from the other. So every distinct fingerprint emits the values around
it, rows are shuffled on those values, and fingerprints that meet on a value are verified.

The balls are no larger than they must be. Three differing bits change the parity, and of
any three bits two lie in the same half of the word. So it is enough that

* a fingerprint of even parity emits its 64 one-bit variants, and
* one of odd parity emits itself, its 64 one-bit variants and its 992 two-bit variants
  whose bits lie in one half.

Pairs at distance 1 meet on the odd one of the two, pairs at distance 2 on a one-bit variant
of both, pairs at distance 3 on a two-bit variant of the odd one.

A crowd on one value costs a row each, not a row a pair: all are linked to the nearest of
them, which is at most one bit from the value whenever the meeting counts, so every such
link is a true one and no connection is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import LOWER_BYTES, WHITE_SPACE, partitions, prepare, table, utf8
from jobloom.llm.components import components
from jobloom.session import stage

RADIUS = 3
SHINGLE_WORDS = 3
HASH_SEED = 42
# Shingles whose bits are counted at one time, so that a long text needs no more memory.
_PIECE = 1 << 16

_TO_PLAIN = LOWER_BYTES.translate(bytes.maketrans(WHITE_SPACE.encode(), b" " * len(WHITE_SPACE)))


def text_fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text as a signed number; 0 for null or no words."""
    words = utf8(text or "").translate(_TO_PLAIN).split()
    if not words:
        return 0
    size = min(SHINGLE_WORDS, len(words))
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), _PIECE):
        hashes = np.array(
            [
                digest(plain[a:b], HASH_SEED)
                for a, b in zip(starts[i : i + _PIECE], ends[i : i + _PIECE], strict=True)
            ],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(set_bits.view("<i8")[0])


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """SimHash of each text of a column."""
    return pa.array([text_fingerprint(t) for t in texts.to_pylist()], pa.int64())


def fingerprint_text(value: Column) -> Column:
    """The fingerprint as 16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _masks() -> tuple[list[int], list[int]]:
    one = [1 << i for i in range(64)]
    halves = (range(32), range(32, 64))
    two = [1 << i | 1 << j for half in halves for i, j in combinations(half, 2)]
    return one, [0, *one, *two]


def _array(masks: list[int]) -> str:
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    # The least number has no literal of its own.
    text = [f"{m}L" if m != -(1 << 63) else "shiftleft(1L, 63)" for m in signed]
    return f"array({', '.join(text)})"


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by variant: each later row of a variant to its first one."""
    last, centre = None, 0
    for batch in batches:
        variants = batch.column(0).to_numpy()
        prints = batch.column(1).to_numpy()
        if not len(variants):
            continue
        first = np.empty(len(variants), bool)
        first[1:] = variants[1:] != variants[:-1]
        first[0] = last is None or variants[0] != last
        begins = np.flatnonzero(first)
        # Rows before the first beginning go on with the centre of the batch before.
        places = np.cumsum(first) - 1
        centres = np.where(places < 0, centre, prints[begins[np.maximum(places, 0)]] if len(begins) else centre)
        last, centre = variants[-1], centres[-1]
        linked = ~first
        if linked.any():
            a, b = prints[linked], centres[linked]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS
            pairs = np.unique(np.stack((np.maximum(a, b)[near], np.minimum(a, b)[near])), axis=1)
            pairs = pairs[:, pairs[0] != pairs[1]]
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["high", "low"])


def links(prints: DataFrame) -> DataFrame:
    """Verified links (high, low) that connect distinct fingerprints (column ``print``)."""
    even, odd = map(_array, _masks())
    spark = prints.sparkSession
    variants = (
        prints.repartition(partitions(spark), "print")
        .withColumn(
            "mask", F.explode(F.expr(f"if(bit_count(print) % 2 = 0, {even}, {odd})"))
        )
        .select(F.col("print").bitwiseXOR(F.col("mask")).alias("variant"), "print")
    )
    return (
        variants.repartition("variant")
        .sortWithinPartitions(
            "variant", F.bit_count(F.col("variant").bitwiseXOR(F.col("print"))), "print"
        )
        .mapInArrow(_meetings, "high long, low long")
    )


def _classes(marked: DataFrame) -> DataFrame:
    """(print, component_id) of a staged table (doc_id, print)."""
    prints = stage(marked.groupBy("print").agg(F.min("doc_id").alias("least_id")), "prints")
    found = components(stage(links(prints.select("print")).distinct(), "links"))
    rooted = stage(
        prints.join(found.withColumnRenamed("node", "print"), "print", "left").select(
            "print", "least_id", F.coalesce("root", "print").alias("root")
        ),
        "rooted",
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("print", "component_id", "root")


def print_groups(prints: DataFrame) -> DataFrame:
    """(print, root) of the fingerprints in the column ``print``, which is read once."""
    unnamed = prints.withColumn("doc_id", F.lit(None).cast("long"))
    return _classes(unnamed).select("print", "root")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint and component_id.

    ``docs`` needs doc_id and text; other columns are not read. Null texts and texts
    without a word have fingerprint zero and are linked like any other. Repeated rows give
    repeated rows. A null doc_id keeps its row and never names a component, unless the
    component has no other: then component_id is null. Empty tables give empty results.
    """
    prepare(docs.sparkSession)
    marked = stage(docs.select("doc_id", fingerprint("text").alias("print")), "fingerprints")
    return marked.join(_classes(marked), "print").select(
        "doc_id", fingerprint_text(F.col("print")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of its least doc_id.

    All columns stay, whatever their names. Of several rows with that doc_id the one with
    the least fingerprint stays, of rows equal in both the one with the least text. A
    component without any doc_id keeps one row.
    """
    prepare(docs.sparkSession)
    marked = stage(
        docs.select(F.struct("*").alias("row"), fingerprint("text").alias("print")), "marked"
    )
    ids = marked.select(F.col("row.doc_id").alias("doc_id"), "print")
    classes = _classes(ids)
    kept = (
        ids.distinct()
        .join(classes, "print")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print")).alias("kept"))
        .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.print").alias("kept_print"))
    )
    ids_and_print = Window.partitionBy(F.col("row.doc_id"), "print").orderBy(F.col("row.text"))
    firsts = marked.withColumn("place", F.row_number().over(ids_and_print)).where("place = 1")
    same = F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (
        F.col("print") == F.col("kept_print")
    )
    return firsts.join(kept, same, "left_semi").select("row.*")


def op1_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
