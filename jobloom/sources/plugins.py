"""Posting sources as plain functions, and their union."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.schemas import as_postings

# Anything that gives a frame with posting columns and a unique BIGINT order.
PostingSource = Callable[[SparkSession], DataFrame]

_SOURCE_BITS = 56


def union_sources(spark: SparkSession, sources: Sequence[PostingSource]) -> DataFrame:
    """All postings of all sources: the first source's rows come first in order."""
    if len(sources) > 2 ** (63 - _SOURCE_BITS):
        raise ValueError("too many sources for one order column")
    frames = []
    for rank, source in enumerate(sources):
        postings = as_postings(source(spark))
        fits = (F.col("ord") >= 0) & (F.col("ord") < 2**_SOURCE_BITS)
        placed = F.when(fits, F.col("ord") + rank * 2**_SOURCE_BITS).otherwise(
            F.raise_error(F.lit("order value out of range for a union")).cast("bigint")
        )
        frames.append(postings.withColumn("ord", placed))
    return reduce(DataFrame.unionByName, frames)


def or_fallback(postings: DataFrame, fallback: DataFrame) -> DataFrame:
    """The fallback source if the first one has no rows. The caller asks for this."""
    return fallback if postings.isEmpty() else postings
