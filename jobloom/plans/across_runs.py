"""What earlier runs had: an archive of keys that new runs are compared with in place.

The archive lies in buckets by posting key. A new run is shuffled into the same buckets and
anti-joined; the archive itself is read bucket by bucket and never shuffled, however long it
has grown. The folder outlives the application; a catalog that does not is told of it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SHAPE = "posting_key STRING, ord BIGINT, run STRING"


def open_archive(spark: SparkSession, folder: str, name: str, buckets: int = 200) -> str:
    """Make the archive in this folder known as a table; one that has data keeps its buckets."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_SHAPE}) USING parquet "
        f"CLUSTERED BY (posting_key) SORTED BY (posting_key) INTO {int(buckets)} BUCKETS "
        "LOCATION :folder",
        args={"folder": folder},
    )
    return name


def unseen(postings: DataFrame, archive: str) -> DataFrame:
    """Postings (with ``posting_key``) whose key no archived run had."""
    known = postings.sparkSession.table(archive).select("posting_key")
    return postings.join(known.hint("merge"), "posting_key", "left_anti").select(*postings.columns)


def remember(postings: DataFrame, archive: str, run: str) -> None:
    """Add the keys of a run. A run that is repeated finds its own keys; use a new folder for
    it, or take what :func:`unseen` gave."""
    rows = postings.selectExpr("posting_key", "ord", f"'{run}' AS run")
    rows.write.insertInto(archive)
