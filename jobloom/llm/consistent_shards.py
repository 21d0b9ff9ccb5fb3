"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has virtual nodes on a ring of 64-bit points, every key a point of its own. A key
belongs to the next node clockwise; if that node's shard is full it goes on clockwise to the
next shard with room. Keys of one arc (between two nodes) all look for room along the same
shards, so it is enough to know how many keys each arc holds: keys go round by round, in
round r those left over try the r-th different shard from their arc, arcs in ring order, keys
of an arc in the order of their points. That pours shards x nodes counters on the driver,
whatever the number of keys; each key then finds its shard and slot from its rank on the ring.

With ``slack`` 0 the capacities are the fair shares, so shard sizes differ by one key at most.
With more slack fewer keys move on, and adding a shard moves fewer keys.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import prepare, table
from jobloom.operators.ranks import ranked
from jobloom.session import stage

SHARDS = 8
NODES = 128


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """(points, shards) of the virtual nodes in ring order, points as signed numbers."""
    points = [
        (xxhash.xxh64_intdigest(f"shard {s} node {n}") - (1 << 63), s)
        for s in range(shards)
        for n in range(nodes)
    ]
    points.sort()
    return np.array([p for p, _ in points]), np.array([s for _, s in points])


def capacities(keys: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most keys of each shard: the fair share, larger by the slack, in all at least ``keys``."""
    if slack:
        return [int(np.ceil(keys / shards * (1 + slack)))] * shards
    return [keys // shards + (s < keys % shards) for s in range(shards)]


@dataclass
class Pouring:
    """Runs of ranks that go to one shard: first rank, shard, slot of the first rank."""

    first: np.ndarray
    shard: np.ndarray
    slot: np.ndarray

    def of(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.first, ranks, side="right") - 1
        return self.shard[run], self.slot[run] + ranks - self.first[run]


def pour(arc_keys: np.ndarray, owners: np.ndarray, room: list[int]) -> Pouring:
    """Fill the shards from the arcs. ``arc_keys`` counts the keys of each arc in ring order,
    ``owners`` names the shard of the node that ends it."""
    shards = len(room)
    paths = []
    for arc in range(len(owners)):
        turned = np.concatenate((owners[arc:], owners[:arc]))
        _, first = np.unique(turned, return_index=True)
        paths.append(turned[np.sort(first)])
    left = np.array(arc_keys, np.int64)
    begin = np.concatenate(([0], np.cumsum(left)[:-1]))
    free, filled = list(room), [0] * shards
    runs: list[tuple[int, int, int]] = []
    for step in range(shards):
        for arc in np.flatnonzero(left):
            if step < len(paths[arc]):
                shard = int(paths[arc][step])
                taken = min(int(left[arc]), free[shard])
                if taken:
                    runs.append((int(begin[arc]), shard, filled[shard]))
                    free[shard] -= taken
                    filled[shard] += taken
                    begin[arc] += taken
                    left[arc] -= taken
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 3)
    return Pouring(columns[:, 0], columns[:, 1], columns[:, 2])


def place(
    keys: DataFrame, key: str, shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0
) -> DataFrame:
    """``keys`` with the columns shard and slot (gapless from 0 in each shard).

    The point of a key is the hash of ``key``; null has a point like any other value, and
    rows of one key lie side by side. An empty table gives no rows.
    """
    spark = keys.sparkSession
    prepare(spark)
    columns = [F.col(c) for c in keys.columns]
    ranks = ranked(
        keys.select(F.struct(*columns).alias("row"), F.xxhash64(key).alias("point")),
        "point", "row", name="ring",
    )
    points, owners = ring(shards, nodes)
    # Arc i ends at node i; keys behind the last node belong to the first one.
    arc = _arc(points)
    counted = ranks.groupBy(arc("point").alias("arc")).agg(F.count(F.lit(1)).alias("n")).collect()
    arc_keys = np.zeros(len(points) + 1, np.int64)
    for row in counted:
        arc_keys[row.arc] = row.n
    total = int(arc_keys.sum())
    runs = pour(arc_keys, np.append(owners, owners[0]), capacities(total, shards, slack))
    shared = spark.sparkContext.broadcast(runs)

    @F.arrow_udf(
        T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    )
    def found(rank: pa.Array) -> pa.Array:
        shard, slot = shared.value.of(rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays(
            [pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], names=["shard", "slot"]
        )

    return ranks.select("row", found("rank").alias("found")).select("row.*", "found.*")


def _arc(points: np.ndarray):
    @F.arrow_udf(T.IntegerType())
    def arc(values: pa.Array) -> pa.Array:
        at = np.searchsorted(points, values.to_numpy(zero_copy_only=False))
        return pa.array(at, pa.int32())

    return arc


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``docs`` needs doc_id and text; other columns are not read. The law is ``rows``: shards
    differ by one row at most. size is the text's UTF-8 bytes and 1; a null text has size 1
    and the checksum of no bytes. Null and repeated doc_ids are keys like others.
    """
    prepare(docs.sparkSession)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    small = stage(
        docs.select(
            "doc_id",
            (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
        ),
        "sizes",
    )
    return place(small, "doc_id", shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_consistent_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
