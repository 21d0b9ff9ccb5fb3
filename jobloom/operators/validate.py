"""Check records against a data dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.text import java_pattern, strip
from jobloom.operators.ordering import number_rows, record_id


@dataclass(frozen=True)
class Dictionary:
    """Field names in output order with their data types, the allowed values, and what else
    the sheet says of a field, by column."""

    data_types: Mapping[str, str]
    allowed_values: Mapping[str, Sequence[str]] = field(default_factory=dict)
    descriptions: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(self.data_types)

    @property
    def missing_from_records(self) -> tuple[str, ...]:
        return tuple(f for f in self.fields if f not in fv.RECORD_DEFAULTS)


@dataclass(frozen=True)
class _Check:
    fails: Column
    field: str
    message: Column
    severity: str


def _date_like(value: Column) -> Column:
    any_form = "|".join(fv.DATE_PATTERNS)
    return F.regexp_like(
        strip(value), F.lit(java_pattern(rf"^(?:{any_form})\z", ignore_case=False))
    )


def _checks(
    dictionary: Dictionary, enforce_allowed_values: bool, value_length: int = fv.ALLOWED_VALUE_LENGTH
) -> list[_Check]:
    checks = [
        _Check(strip(F.col(name)) == "", name, F.lit(fv.ISSUE_REQUIRED), "error")
        for name in fv.REQUIRED_FIELDS
        if name in dictionary.fields
    ]
    for name, data_type in dictionary.data_types.items():
        value = F.col(name)
        if name not in fv.RECORD_DEFAULTS:
            text = F.lit(fv.ISSUE_COVERAGE)
            checks.append(_Check(F.lit(True), name, text, "warning"))
            continue
        if "date" in data_type.lower():
            text = F.concat(F.lit(fv.ISSUE_DATE), value)
            checks.append(_Check((value != "") & ~_date_like(value), name, text, "warning"))
        allowed = dictionary.allowed_values.get(name, ())
        short = all(len(item) <= value_length for item in allowed)
        if enforce_allowed_values and allowed and short:
            soft = F.lower(strip(value)).isin(*fv.SOFT_DEFAULTS)
            text = F.concat(F.lit(fv.ISSUE_ALLOWED[0]), value, F.lit(fv.ISSUE_ALLOWED[1]))
            checks.append(_Check(~soft & ~value.isin(*allowed), name, text, "warning"))
    return checks


def validation_issues(
    records: DataFrame,
    dictionary: Dictionary,
    *,
    enforce_allowed_values: bool = False,
    value_length: int = fv.ALLOWED_VALUE_LENGTH,
) -> DataFrame:
    """One row per finding: ``ord``, ``issue_pos``, record id, field, message, severity.

    Required fields come first in their fixed order, then dictionary order. A field with an
    allowed value longer than ``value_length`` is described rather than listed, and not checked.
    """
    checks = _checks(dictionary, enforce_allowed_values, value_length)
    if not checks:
        return _flat_issues(records.limit(0).withColumn("_issues", _issue_array([])))
    found = records.where(reduce(or_, [check.fails for check in checks]))
    return _flat_issues(found.withColumn("_issues", _issue_array(checks)))


def _issue_array(checks: list[_Check]) -> Column:
    findings = [
        F.when(
            check.fails,
            F.struct(
                F.lit(check.field).alias("field"),
                check.message.alias("message"),
                F.lit(check.severity).alias("severity"),
            ),
        )
        for check in checks
    ]
    shape = "array<struct<field:string,message:string,severity:string>>"
    return F.array_compact(F.array(*findings).cast(shape))


def _flat_issues(found: DataFrame) -> DataFrame:
    return found.select(
        "ord", "record_id", F.posexplode("_issues").alias("issue_pos", "_issue")
    ).select(
        "ord", "issue_pos", "record_id", "_issue.field", "_issue.message", "_issue.severity"
    )


def without_errors(records: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Records that have every required field; warnings do not count."""
    errors = [c.fails for c in _checks(dictionary, False) if c.severity == "error"]
    return records.where(~reduce(or_, errors)) if errors else records


def not_allowed_values(
    records: DataFrame,
    allowed: DataFrame,
    fields: Sequence[str] | None = None,
    *,
    value_length: int = fv.ALLOWED_VALUE_LENGTH,
) -> DataFrame:
    """Values outside the allowed ones, with the allowed values as a table.

    ``allowed`` has ``variable_name`` and ``value``. This is the form for dictionaries
    too long to unroll; it gives the rows of the opt-in check in
    :func:`validation_issues`. Name the ``fields`` that the table has values for, and no other
    column of the records is read.
    """
    listed = F.max(F.length("value")) <= value_length
    short = allowed.groupBy("variable_name").agg(listed.alias("_short")).where("_short")
    checked = allowed.join(short, "variable_name", "left_semi")
    wanted = fv.RECORD_DEFAULTS if fields is None else fields
    names = [name for name in wanted if name in records.columns]
    melted = records.unpivot(["ord", "record_id"], names, "field", "value").where(
        ~F.lower(strip(F.col("value"))).isin(*fv.SOFT_DEFAULTS)
    )
    enforced = melted.join(
        checked.select(F.col("variable_name").alias("field")).distinct(), "field", "left_semi"
    )
    values = checked.select(F.col("variable_name").alias("field"), "value").distinct()
    return enforced.join(values, ["field", "value"], "left_anti").select(
        "ord", "record_id", "field", "value"
    )


def renumber(records: DataFrame, prefix: str = fv.RECORD_ID_PREFIX) -> DataFrame:
    """Fresh ids 1..n in input order for the rows that are left."""
    numbered = number_rows(records)
    return numbered.withColumn("record_id", record_id(F.col("seq"), prefix)).drop("seq")


def in_dictionary_order(records: DataFrame, dictionary: Dictionary) -> DataFrame:
    """The dictionary columns in their order; fields no record has are blank."""
    return records.select(
        *[
            F.col(name) if name in fv.RECORD_DEFAULTS else F.lit("").alias(name)
            for name in dictionary.fields
        ]
    )
