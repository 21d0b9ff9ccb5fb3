"""Keep the first posting or record of each key, in input order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions.text import normalized, posting_key


def keep_first(df: DataFrame, key: Column, order: str = "ord") -> DataFrame:
    """The first row of each key.

    Spark limits each key to one row per task before the shuffle, so a key that holds
    most of the rows sends one row per task to its reducer. Keys begin alike, which makes
    them slow to sort, so rows are sorted by a hash of the key before the key itself.
    """
    first = F.row_number().over(Window.partitionBy("_hash", "_key").orderBy(order))
    return (
        df.withColumn("_key", key)
        .withColumn("_hash", F.xxhash64("_key"))
        .withColumn("_row", first)
        .where(F.col("_row") == 1)
        .drop("_key", "_hash", "_row")
    )


def _keep_first_of(df: DataFrame, names: tuple[str, str, str], url: str, order: str) -> DataFrame:
    key = posting_key(*[F.col(name) for name in names], F.col("_url"))
    return keep_first(df.withColumn("_url", normalized(F.col(url))), key, order).drop("_url")


def first_postings(postings: DataFrame, order: str = "ord") -> DataFrame:
    return _keep_first_of(postings, ("job_title", "company", "location"), "url", order)


def first_records(records: DataFrame, order: str = "ord") -> DataFrame:
    """The same on record columns. After :func:`first_postings` it removes nothing."""
    return _keep_first_of(records, ("job_title", "employer", "location"), "source_url", order)
