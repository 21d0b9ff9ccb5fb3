"""Global ranks by range partitions: one shuffle, no one-task window over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.session import stage

# monotonically_increasing_id holds the partition in the bits above these.
_PLACE_BITS = 33


def ranked(df: DataFrame, *order: Column | str, rank: str = "rank", name: str = "ranked") -> DataFrame:
    """``df`` in the given order with its 0-based position, as a table in the shared folder.

    Rows are sorted by range partitions and written with their place in the partition. The
    offsets come from one count per partition, so the only one-task step reads as many rows
    as there are partitions. Rows equal in ``order`` are numbered in any order, but once.
    """
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_place": F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1),
            }
        ),
        name,
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # Left joins only: an inner one would filter one reading of the table and not the other.
    return placed.join(F.broadcast(offsets), "_part", "left").select(
        *df.columns, (F.col("_offset") + F.col("_place")).alias(rank)
    )
