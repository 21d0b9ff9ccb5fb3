"""What the operators of this folder share: tables, the session, and UTF-8 word helpers."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.session import configure

# White space of the contracts: space and 0x09-0x0D.
WHITE_SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LOWER_BYTES = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
# Rows of one Arrow batch: documents may be long, so batches are short.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the package, and short Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions, for steps whose rows multiply after the shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of an id written as text; null stays null."""
    return F.crc32(F.col(name).cast("string").cast("binary"))


def utf8(text: str) -> bytes:
    """UTF-8 bytes; a lone surrogate, which no Parquet file holds, is kept as three bytes."""
    return text.encode("utf-8", "surrogatepass")
