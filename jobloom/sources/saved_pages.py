"""A folder of saved result pages as a Spark data source."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from jobloom.operators.pages import (
    cards_to_postings,
    first_of_page,
    provenance,
    read_cards,
)

PARTITION_BYTES = 128 * 1024 * 1024
# A page is a string of at most 2**31 bytes, so it holds fewer than 2**28 cards.
CARD_BITS = 28
_SCHEMA = pa.schema([("page_id", pa.int64()), ("file_name", pa.string()), ("html", pa.string())])


@dataclass
class _Files(InputPartition):
    first: int
    paths: list[str]


class SavedPages(DataSource):
    """``page_id`` in reading order (html files, then htm files, by name), name, text.

    Spark's file sources skip names that start with an underscore, which saved pages may
    have, and give files no order; so the folder is listed here. Only names and sizes
    reach the driver. Executors read the files.
    """

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return "page_id bigint, file_name string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _SavedPagesReader(self.options["path"])


class _SavedPagesReader(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        system, root = fs.FileSystem.from_uri(self.folder)
        listed = system.get_file_info(fs.FileSelector(root))
        files = [
            info
            for ending in (".html", ".htm")
            for info in sorted(listed, key=lambda info: info.base_name)
            if info.is_file and info.base_name.endswith(ending)
        ]
        parts, size = [], 0
        for rank, info in enumerate(files):
            if not parts or size + info.size > PARTITION_BYTES:
                parts.append(_Files(rank, []))
                size = 0
            parts[-1].paths.append(info.path)
            size += info.size
        return parts or [_Files(0, [])]

    def read(self, partition: _Files):
        system, _ = fs.FileSystem.from_uri(self.folder)
        for rank, path in enumerate(partition.paths, start=partition.first):
            with system.open_input_stream(path) as stream:
                text = stream.read().decode("utf-8", errors="ignore")
            text = re.sub("\r\n?", "\n", text)
            row = [[rank], [path.rsplit("/", 1)[-1]], [text]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(value, field.type) for value, field in zip(row, _SCHEMA)],
                schema=_SCHEMA,
            )


def scan_saved_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of a folder; an error if it is missing, no rows if it is empty."""
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    spark.dataSource.register(SavedPages)
    return spark.read.format("saved_pages").option("path", uri).load()


def page_postings(
    pages: DataFrame,
    *,
    default_keyword: str = "",
    default_location: str = "",
    as_of: str | None = None,
) -> DataFrame:
    """Postings of result pages (``page_id``, ``file_name``, ``html``)."""
    keyword, location = provenance(F.col("file_name"), default_keyword, default_location)
    named = pages.select(
        "page_id", "html", keyword.alias("search_keyword"), location.alias("search_location")
    )
    cards = first_of_page(read_cards(named))
    fits = (F.col("page_id") >= 0) & (F.col("page_id") < 1 << (63 - CARD_BITS))
    order = F.when(fits, F.shiftleft("page_id", CARD_BITS) + F.col("card_ord")).otherwise(
        F.raise_error(F.lit("page_id out of range for an order column")).cast("bigint")
    )
    return cards_to_postings(cards, order=order, as_of=as_of)
