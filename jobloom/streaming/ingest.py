"""Coding of pages as they arrive. The batch operators do the work in each micro-batch.

Which keys were seen before is keyed state, kept by Spark in RocksDB beside the checkpoint: a
micro-batch looks up the keys it has itself, so its cost does not grow with what came before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from jobloom.functions.text import normalized, posting_key
from jobloom.operators.decide import PostingFilter, accepted
from jobloom.operators.normalize import normalize
from jobloom.sources.saved_pages import page_postings

PAGE_SCHEMA = "page_id bigint, file_name string, html string"
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_key(postings: DataFrame) -> DataFrame:
    linked = postings.withColumn("_url", normalized(F.col("url")))
    key = posting_key(*[F.col(c) for c in ("job_title", "company", "location", "_url")])
    return linked.select(*postings.columns, key.alias("posting_key"))


class FirstSeen(StatefulProcessor):
    """The first row of a key, in ``ord``, if the key was never seen before.

    Rows of a key come in pieces of bounded size, of which one row is held.
    """

    def __init__(self, columns: list[str], forget_after: int | None = None) -> None:
        self.columns, self.forget_after = columns, forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "ord bigint", self.forget_after)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        first = None
        for piece in rows:
            best = piece.nsmallest(1, "ord")
            if first is None or best["ord"].iloc[0] < first["ord"].iloc[0]:
                first = best
        if first is None or self.seen.exists():
            return
        self.seen.update((int(first["ord"].iloc[0]),))
        yield first[self.columns]

    def close(self) -> None:
        pass


def first_seen(postings: DataFrame, forget_after: int | None = None) -> DataFrame:
    """A stream of postings with ``posting_key``, each key once for all time, or again after
    ``forget_after`` milliseconds, which bounds the state."""
    conf = postings.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    shape = T.StructType([f for f in postings.schema])
    return postings.groupBy("posting_key").transformWithStateInPandas(
        FirstSeen(postings.columns, forget_after), shape, "Append",
        "ProcessingTime" if forget_after else "None",
    )


def code_new_pages(
    spark: SparkSession,
    pages_folder: str,
    out: str,
    posting_filter: PostingFilter,
    *,
    as_of: str | None = None,
    forget_after: int | None = None,
) -> StreamingQuery:
    """Code all pages (parquet) not seen before, then stop.

    Each micro-batch keeps the first posting of each key that no earlier batch had. Its
    output folders carry the batch number and are overwritten when a batch runs again, so
    a failed batch leaves nothing behind.
    """

    def code(fresh: DataFrame, batch: int) -> None:
        kept = f"{out}/postings/batch={batch}"
        fresh.write.mode("overwrite").parquet(kept)
        postings = spark.read.schema(fresh.schema).parquet(kept)
        records = normalize(accepted(posting_filter.decide(postings)), as_of=as_of)
        records.write.mode("overwrite").parquet(f"{out}/records/batch={batch}")

    pages = spark.readStream.schema(PAGE_SCHEMA).parquet(pages_folder)
    postings = with_key(page_postings(pages, as_of=as_of))
    return (
        first_seen(postings, forget_after).writeStream.foreachBatch(code)
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
