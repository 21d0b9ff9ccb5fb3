"""Dense numbering and running values over input order, without one-task windows.

Numbers come from range partitions (``ranks``). For running values, rows are cut into buckets
by the high bits of a unique BIGINT order column, so a bucket holds at most 2**12 rows whatever
the data look like, and a group of buckets at most 2**20 of them; each window runs over one
bucket or one group of buckets, also when a single key holds most of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.operators.ranks import ranked

BUCKET_BITS = 12
GROUP_BITS = 20


def _earlier(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(
    df: DataFrame, *, order: str = "ord", within: Sequence[str] = (), name: str = "seq"
) -> DataFrame:
    """Add the 1-based position in ``order``, over all rows or within each key.

    Rows are sorted once by range partitions, whatever the order values and however many rows
    a key has; null is a key like any other.
    """
    keys = list(within)
    placed = ranked(df, *keys, order, rank="_rank")
    if not keys:
        return placed.select(*df.columns, (F.col("_rank") + 1).alias(name))
    firsts = (
        placed.groupBy(*keys).agg(F.min("_rank").alias("_first"))
        .withColumnsRenamed({k: f"_key_{k}" for k in keys})
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return placed.join(firsts, same, "left").select(
        *df.columns, (F.col("_rank") - F.col("_first") + 1).alias(name)
    )


def carry_down(
    df: DataFrame, *, within: Sequence[str], values: dict[str, Column], order: str = "ord"
) -> DataFrame:
    """For each named value, its last non-null at or before the row, within the keys."""
    keys = list(within)
    names = list(values)
    rows = df.withColumns(
        {**values, "_bucket": F.shiftright(order, BUCKET_BITS)}
    ).withColumn("_group", F.shiftright("_bucket", GROUP_BITS))
    per_bucket = rows.groupBy(*keys, "_group", "_bucket").agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(order))).alias(n) for n in names]
    )
    per_group = per_bucket.groupBy(*keys, "_group").agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_bucket"))).alias(n) for n in names]
    )
    group_window = _earlier(keys, "_group")
    bucket_window = _earlier([*keys, "_group"], "_bucket")
    before_group = per_group.select(
        *keys, "_group",
        *[F.last(n, ignorenulls=True).over(group_window).alias(f"_g_{n}") for n in names],
    )
    before = per_bucket.select(
        *keys, "_group", "_bucket",
        *[F.last(n, ignorenulls=True).over(bucket_window).alias(f"_b_{n}") for n in names],
    ).join(before_group, [*keys, "_group"], "left")
    here = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    kept = [c for c in df.columns if c not in names]
    return (
        rows.withColumns({n: F.last(n, ignorenulls=True).over(here) for n in names})
        .join(before.drop("_group"), [*keys, "_bucket"], "left")
        .select(*kept, *[F.coalesce(n, f"_b_{n}", f"_g_{n}").alias(n) for n in names])
    )


def record_id(position: Column, prefix: str = fv.RECORD_ID_PREFIX) -> Column:
    """Prefix and number, padded with zeros to four digits, never cut."""
    return F.format_string(f"{prefix}%0{fv.RECORD_ID_DIGITS}d", position)
