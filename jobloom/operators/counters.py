"""Counts taken while a stage is written, without a job of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counting_decisions(decided: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation("decisions")
    counted = decided.observe(
        seen,
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("decision.included")).alias("included"),
    )
    return counted, seen


def counting_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
