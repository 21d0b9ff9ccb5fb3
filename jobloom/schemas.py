"""Table shapes and the contract that every posting source meets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom import fixed_values as fv

DECISION_TYPE = "struct<included:boolean,stage:string,reasons:array<string>>"
RECORD_FIELDS = tuple(fv.RECORD_DEFAULTS)


def as_postings(df: DataFrame, order: str = "ord") -> DataFrame:
    """Bring any frame to the posting columns.

    Missing columns and nulls become blank text. Columns outside the contract are kept
    in the ``extras`` map. ``order`` must be a unique BIGINT giving the input order.
    """
    known = set(fv.POSTING_FIELDS) | {order, "extras"}
    fields = [
        F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
        if name in df.columns
        else F.lit("").alias(name)
        for name in fv.POSTING_FIELDS
    ]
    others = [name for name in df.columns if name not in known]
    pairs = [x for name in others for x in (F.lit(name), F.col(name).cast("string"))]
    extras = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")
    if "extras" in df.columns:
        given = F.coalesce(F.col("extras"), F.create_map().cast("map<string,string>"))
        extras = F.map_concat(given, extras) if pairs else given
    return df.select(F.col(order).cast("bigint").alias("ord"), *fields, extras.alias("extras"))
