"""The whole run: postings in, coded and numbered records, audit and issues out."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.operators.counters import counting_decisions, counting_rows
from jobloom.operators.decide import (
    ExclusionRules,
    InclusionRules,
    PostingFilter,
    accepted,
    audit_rows,
)
from jobloom.operators.dedupe import first_postings
from jobloom.operators.normalize import normalize
from jobloom.operators.ordering import number_rows
from jobloom.operators.validate import (
    Dictionary,
    in_dictionary_order,
    renumber,
    validation_issues,
    without_errors,
)
from jobloom.sinks.writers import archive, write_csv, write_json
from jobloom.sources.saved_pages import page_postings, scan_saved_pages


def _stage(df: DataFrame, folder: str) -> DataFrame:
    """Write a stage and go on from the table, so lost executors cost only this stage."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def numbered_records(decided: DataFrame, **options) -> DataFrame:
    """Accepted rows as records, numbered by their place among all decided rows.

    Numbers are worked out on order and outcome alone. Only accepted rows are moved whole.
    """
    outcome = decided.select("ord", F.col("decision.included").alias("included"))
    places = number_rows(outcome).where("included").select("ord", "seq")
    return normalize(accepted(decided).join(places, "ord"), position="seq", **options)


def run_coding(
    postings: DataFrame,
    inclusion: InclusionRules,
    exclusion: ExclusionRules,
    dictionary: Dictionary,
    out: str,
    *,
    as_of: str | None = None,
    posting_filter: PostingFilter | None = None,
) -> dict[str, int]:
    """De-duplicate, decide, code, validate, number and write; return the counts.

    ``out`` is a folder all executors reach. Stage tables are kept there as the record of
    the run. Records are not de-duplicated again: their keys are those of the postings.
    """
    spark = postings.sparkSession
    write_json(rule_rows(spark, inclusion, exclusion), f"{out}/rules", "overwrite")
    write_json(dictionary_rows(spark, dictionary), f"{out}/dictionary", "overwrite")

    unique, unique_seen = counting_rows(first_postings(postings), "unique")
    unique = _stage(unique, f"{out}/postings_deduped")

    posting_filter = posting_filter or PostingFilter(inclusion, exclusion)
    decided, decided_seen = counting_decisions(posting_filter.decide(unique))
    decided = _stage(decided, f"{out}/decisions")
    write_csv(audit_rows(decided.orderBy("ord")), f"{out}/filter_audit_trail", "overwrite")

    records = _stage(numbered_records(decided, as_of=as_of), f"{out}/records")
    issues = validation_issues(records, dictionary)
    issue_count = issues.count()
    if issue_count:
        listed = issues.orderBy("ord", "issue_pos").drop("ord", "issue_pos")
        write_csv(listed, f"{out}/validation_issues", "overwrite")

    final, final_seen = counting_rows(renumber(without_errors(records, dictionary)), "final")
    final = _stage(final, f"{out}/records_final")
    ordered = in_dictionary_order(final.orderBy("ord"), dictionary)
    write_csv(ordered, f"{out}/jobs_csv", "overwrite")
    write_json(ordered, f"{out}/jobs_json", "overwrite")
    return {
        "unique": unique_seen.get["rows"],
        "included": decided_seen.get["included"],
        "issues": issue_count,
        "final": final_seen.get["rows"],
    }


def postings_of_folder(
    spark: SparkSession,
    folder: str,
    *,
    keywords: tuple[str, ...] = fv.DEFAULT_SEARCH_KEYWORDS,
    locations: tuple[str, ...] = (),
    archive_folder: str | None = None,
    archive_run: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Postings of a folder of saved pages; the pages are archived if a place is named, under
    the name of the run if there is one.

    File names without provenance take the first keyword and the first location.
    """
    pages = scan_saved_pages(spark, folder)
    if archive_folder:
        archive(pages, archive_folder, run=archive_run)
    return page_postings(
        pages,
        default_keyword=keywords[0] if keywords else "",
        default_location=locations[0] if locations else "",
        as_of=as_of,
    )


def filter_and_code(postings: DataFrame, posting_filter: PostingFilter, **options) -> DataFrame:
    """Decide and code in one stage without a shuffle; ids are left blank."""
    return normalize(accepted(posting_filter.decide(postings)), **options)


def rule_rows(
    spark: SparkSession, inclusion: InclusionRules, exclusion: ExclusionRules
) -> DataFrame:
    """The rules of a run as a long table, for the record."""
    rows = []
    for rule_set, rules in (("inclusion", inclusion), ("exclusion", exclusion)):
        for bucket, values in asdict(rules).items():
            if isinstance(values, tuple):
                rows += [(rule_set, bucket, i, v, None) for i, v in enumerate(values)]
            elif values is not None:
                rows.append((rule_set, bucket, 0, "", values))
    shape = "rule_set string, bucket string, ord bigint, value string, num_value bigint"
    return spark.createDataFrame(rows, shape).coalesce(1)


def dictionary_rows(spark: SparkSession, dictionary: Dictionary) -> DataFrame:
    """The fields of a run's dictionary with all that its sheet says of them, for the record."""
    rows = []
    for pos, (name, kind) in enumerate(dictionary.data_types.items()):
        said = dictionary.descriptions.get(name, {})
        described = [said.get(key, "") for key in fv.DICTIONARY_DESCRIPTIONS]
        rows.append((pos, name, kind, list(dictionary.allowed_values.get(name, ())), *described))
    described = ", ".join(f"{key} string" for key in fv.DICTIONARY_DESCRIPTIONS)
    shape = f"pos int, variable_name string, data_type string, allowed_values array<string>, {described}"
    return spark.createDataFrame(rows, shape).coalesce(1)
