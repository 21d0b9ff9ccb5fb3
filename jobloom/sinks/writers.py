"""Writers. Each writes a folder of part files; ordered ones keep order across parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def write_csv(rows: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Text as it is, blank for blank, booleans as True and False."""
    columns = [
        F.initcap(F.col(name).cast("string")).alias(name) if kind == "boolean" else F.col(name)
        for name, kind in rows.dtypes
    ]
    rows.select(*columns).write.mode(mode).options(**_CSV).csv(folder)


def write_json(rows: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """One object per line, columns in order."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(folder)


def archive(
    rows: DataFrame, folder: str, ingest_date: Column | None = None, run: str | None = None
) -> None:
    """Add raw pages or postings under the date they came in.

    With a ``run`` name its rows lie in partitions of their own, so repeating the run replaces
    them and nothing else. Without one every call adds rows. Use one way in one folder.
    """
    date = F.date_format(F.current_date(), "yyyy-MM-dd") if ingest_date is None else ingest_date
    dated = rows.withColumn("ingest_date", date)
    if run is None:
        dated.write.mode("append").partitionBy("ingest_date").parquet(folder)
    else:
        dated.withColumn("run", F.lit(run)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("ingest_date", "run").parquet(folder)


def read_csv(spark, folder: str) -> DataFrame:
    """Read such a CSV folder back as text, blank for missing."""
    raw = spark.read.options(**{k: v for k, v in _CSV.items() if k != "emptyValue"}).option(
        "multiLine", True
    ).csv(folder)
    return raw.select(*[F.coalesce(name, F.lit("")).alias(name) for name in raw.columns])
