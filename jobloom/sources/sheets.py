"""Rule and dictionary sheets.

A sheet is a set of rows ``(sheet_id, ord, c0..cN)``; the operators work on many sheets
at once. ``ord`` is a unique BIGINT. Rules come out as long tables. Loading them for a
run collects one sheet's rules, after a check of their number.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.text import (
    WS,
    ascii_digits,
    blank_to_null,
    java_pattern,
    section_of,
    split_list,
    split_keyword_text,
    strip,
    word_count,
)
from jobloom.operators.decide import ExclusionRules, InclusionRules
from jobloom.operators.ordering import carry_down
from jobloom.operators.validate import Dictionary

# Rules of one sheet that a run takes to the driver, unless it says otherwise.
MAX_SHEET_RULES = 1_000_000
_THRESHOLDS = ("experience_rules", "salary_rules")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column(0).to_pylist():
            rows = [r for r in csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")) if r]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.string()))], names=["cells"])


def read_sheet(spark: SparkSession, path: str, sheet_id: str | None = None) -> DataFrame:
    """A sheet without header, every cell as trimmed text, missing cells blank.

    The sheet is as wide as its widest line. Empty lines are left out.
    """
    files = spark.read.option("wholetext", True).text(path)
    lines = files.mapInArrow(_lines, "cells array<string>").select(
        F.monotonically_increasing_id().alias("ord"), "cells"
    )
    width = lines.agg(F.max(F.size("cells"))).first()[0] or 0
    cells = [
        F.coalesce(strip(F.get("cells", F.lit(i))), F.lit("")).alias(f"c{i}") for i in range(width)
    ]
    return lines.select(F.lit(sheet_id or path).alias("sheet_id"), "ord", *cells)


def inclusion_rules(sheets: DataFrame) -> DataFrame:
    """``(sheet_id, bucket, ord, value)`` of sectioned first-column lists.

    A heading opens a section, a row with a blank first cell closes it, and a marker row
    ends the sheet. Values outside a section are kept as ``other_rules``.
    """
    value = strip(F.col("c0"))
    lowered = F.lower(value)
    ends = lowered.isin(*fv.SHEET_END_MARKERS) | F.startswith(
        lowered, F.lit(fv.SHEET_END_PREFIX)
    )
    rows = sheets.select("sheet_id", "ord", value.alias("value"), ends.alias("_ends"))
    section = section_of(F.col("value"))
    carried = carry_down(
        rows,
        within=["sheet_id"],
        values={
            "_section": F.when(F.col("value") == "", "").otherwise(section),
            "_ended": F.when(F.col("_ends"), True),
        },
    )
    bucket = F.coalesce(blank_to_null(F.col("_section")), F.lit("other_rules"))
    return carried.where(
        F.col("_ended").isNull() & (F.col("value") != "") & section.isNull()
    ).select("sheet_id", bucket.alias("bucket"), "ord", "value")


def _number_in(text: Column, pattern: str) -> Column:
    digits = F.regexp_extract(text, java_pattern(pattern), 1)
    return F.replace(ascii_digits(digits), F.lit(","), F.lit("")).try_cast("bigint")


def exclusion_kind(text: Column) -> tuple[Column, Column]:
    """Which bucket an exclusion line belongs to, and its number if it is a threshold."""
    experience = F.regexp_like(text, F.lit(java_pattern(fv.EXPERIENCE_RULE_PATTERN)))
    salary = F.regexp_like(text, F.lit(java_pattern(fv.SALARY_RULE_PATTERN)))
    lowered = F.lower(text)
    career = lowered.isin(*fv.CAREER_LEVEL_WORDS) | F.contains(
        lowered, F.lit(fv.CAREER_LEVEL_PHRASE)
    )
    bucket = (
        F.when(experience, "experience_rules")
        .when(salary, "salary_rules")
        .when(career, "career_level_keywords")
        .when(word_count(text) <= 2, "title_keywords")
        .otherwise("description_keywords")
    )
    number = F.when(experience, _number_in(text, fv.EXPERIENCE_RULE_PATTERN)).when(
        salary, _number_in(text, fv.SALARY_RULE_PATTERN)
    )
    return bucket, number


def exclusion_rules(sheets: DataFrame) -> DataFrame:
    """``(sheet_id, bucket, ord, value, num_value)`` of classified first cells.

    Every line is also kept under ``raw_rules``. Keywords stand once, at their first
    place; of the thresholds of a kind the last line counts.
    """
    lines = sheets.select("sheet_id", "ord", strip(F.col("c0")).alias("value")).where(
        F.col("value") != ""
    )
    bucket, number = exclusion_kind(F.col("value"))
    none = F.lit(None).cast("bigint")
    entries = lines.select(
        "sheet_id",
        "ord",
        "value",
        F.explode(
            F.array(
                F.struct(F.lit("raw_rules").alias("bucket"), none.alias("num_value")),
                F.struct(bucket.alias("bucket"), number.alias("num_value")),
            )
        ).alias("_entry"),
    ).select("sheet_id", "ord", "value", "_entry.*")
    threshold = F.col("bucket").isin(*_THRESHOLDS)
    same = (
        F.when(F.col("bucket") == "raw_rules", F.col("ord").cast("string"))
        .when(threshold, "")
        .otherwise(F.col("value"))
    )
    usable = entries.where(~threshold | F.col("num_value").isNotNull())
    return (
        usable.groupBy("sheet_id", "bucket", same.alias("_same"))
        .agg(
            F.min("ord").alias("_first"),
            F.max(F.struct("ord", "value", "num_value")).alias("_last"),
        )
        .select(
            "sheet_id",
            "bucket",
            F.when(threshold, F.col("_last.ord")).otherwise(F.col("_first")).alias("ord"),
            "_last.value",
            "_last.num_value",
        )
    )


def dictionary_fields(sheets: DataFrame) -> DataFrame:
    """One row per dictionary field: ``sheet_id, ord, variable_name`` and its metadata.

    The header is the first row whose first filled cell is "variable name". A repeated
    field keeps its place; its later row gives the metadata, and allowed values stay if
    the later row has none.
    """
    cells = sorted((c for c in sheets.columns if c[1:].isdigit()), key=lambda c: int(c[1:]))
    rows = sheets.select("sheet_id", "ord", *[strip(F.col(c)).alias(c) for c in cells])
    filled = F.lower(F.coalesce(*[blank_to_null(F.col(c)) for c in cells]))
    headings = F.array(*[F.lower(c) for c in cells])
    header = (
        rows.where(filled == "variable name")
        .groupBy("sheet_id")
        .agg(F.min(F.struct("ord", headings.alias("headings"))).alias("_header"))
    )

    def meta(key: str) -> Column:
        headings_of_key = [h for h, k in fv.DICTIONARY_HEADINGS.items() if k == key]
        # Of several columns with the same meaning the last one counts.
        values = [
            F.when(F.col("_header.headings")[i].isin(*headings_of_key), F.col(c))
            for i, c in reversed(list(enumerate(cells)))
        ]
        return F.coalesce(*values, F.lit("")).alias(key)

    keys = list(dict.fromkeys(fv.DICTIONARY_HEADINGS.values()))
    fields = (
        rows.join(header, "sheet_id")
        .where(F.col("ord") > F.col("_header.ord"))
        .select("sheet_id", "ord", *[meta(key) for key in keys])
        .where(~F.lower("variable_name").isin("", "variable name"))
    )
    others = [key for key in keys if key not in ("variable_name", "allowed_values_raw")]
    has_values = F.regexp_replace("allowed_values_raw", f"(?:;|{WS})+", "") != ""
    return (
        fields.groupBy("sheet_id", "variable_name")
        .agg(
            F.min("ord").alias("ord"),
            F.max(F.struct("ord", "allowed_values_raw", *others)).alias("_last"),
            F.max(F.when(has_values, F.struct("ord", "allowed_values_raw"))).alias("_values"),
        )
        .select(
            "sheet_id",
            "ord",
            "variable_name",
            *[F.col(f"_last.{key}").alias(key) for key in others],
            F.col("_last.allowed_values_raw").alias("allowed_values_raw"),
            F.coalesce("_values.allowed_values_raw", F.lit("")).alias("allowed_values_kept"),
        )
    )


def allowed_values(fields: DataFrame) -> DataFrame:
    """``(sheet_id, variable_name, pos, value)`` from the separated lists."""
    values = split_list(F.col("allowed_values_kept"), ";")
    return fields.select("sheet_id", "variable_name", F.posexplode(values).alias("pos", "value"))


def _collect_checked(table: DataFrame) -> list:
    rows = table.limit(MAX_SHEET_RULES + 1).collect()
    if len(rows) > MAX_SHEET_RULES:
        raise ValueError(f"a sheet may hold {MAX_SHEET_RULES} rules to run with")
    return sorted(rows, key=lambda row: row["ord"])


def load_inclusion_rules(sheet: DataFrame) -> InclusionRules:
    lists: dict[str, list[str]] = {}
    for row in _collect_checked(inclusion_rules(sheet)):
        lists.setdefault(row["bucket"], []).append(row["value"])
    return InclusionRules(**{name: tuple(values) for name, values in lists.items()})


def load_exclusion_rules(sheet: DataFrame) -> ExclusionRules:
    lists: dict[str, list[str]] = {}
    limits: dict[str, int] = {}
    for row in _collect_checked(exclusion_rules(sheet)):
        if row["bucket"] in _THRESHOLDS:
            limits[row["bucket"]] = row["num_value"]
        else:
            lists.setdefault(row["bucket"], []).append(row["value"])
    return ExclusionRules(
        **{name: tuple(values) for name, values in lists.items()},
        maximum_years=limits.get("experience_rules"),
        maximum_annual=limits.get("salary_rules"),
    )


def load_dictionary(sheet: DataFrame) -> Dictionary:
    fields = _collect_checked(dictionary_fields(sheet))
    if not fields:
        raise ValueError("the sheet has no 'Variable Name' header or no fields below it")
    allowed = {
        row["variable_name"]: tuple(split_keyword_text(row["allowed_values_kept"], ";"))
        for row in fields
    }
    return Dictionary(
        {row["variable_name"]: row["data_type"] for row in fields},
        {name: values for name, values in allowed.items() if values},
        {row["variable_name"]: {key: row[key] for key in fv.DICTIONARY_DESCRIPTIONS} for row in fields},
    )
