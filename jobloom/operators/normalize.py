"""Turn postings into coded records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions import extract as ex
from jobloom.functions.text import blank_to_null, strip
from jobloom.operators.ordering import number_rows, record_id


def today() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def notes(*, with_decision: bool) -> Column:
    """Provenance of the row; parts that do not apply are left out."""

    def labelled(name: str, text: Column) -> Column:
        return F.concat(F.lit(fv.NOTE_LABELS[name]), text)

    parts = [
        F.when(F.col(name) != "", labelled(name, F.col(name)))
        for name in ("posting_date", "search_keyword", "search_location")
    ]
    if with_decision:
        reasons = F.array_join("decision.reasons", fv.REASON_JOINER)
        parts += [labelled("stage", F.col("decision.stage")), labelled("reasons", reasons)]
    return F.concat_ws(fv.REASON_JOINER, *parts, F.when(is_demo(), fv.DEMO_NOTE))


def is_demo() -> Column:
    word = F.lit(fv.DEMO_WORD)
    return F.contains(F.lower("url"), word) | F.startswith(F.lower("posting_date"), word)


def normalize(
    postings: DataFrame,
    *,
    position: str | None = None,
    as_of: str | None = None,
    dataset_source: str = fv.SITE_NAME,
    default_platform: str = fv.SITE_NAME,
    id_prefix: str = fv.RECORD_ID_PREFIX,
    text_length: int | None = fv.TEXT_LENGTH,
    long_text_length: int | None = fv.LONG_TEXT_LENGTH,
) -> DataFrame:
    """The record columns, after ``ord``; and ``decision`` when the rows carry one.

    ``position`` names the column the record id is made from. ``as_of`` is the date for
    rows that carry none; it defaults to today. ``text_length`` and ``long_text_length``
    cut the text columns and the long description; None keeps them whole.
    """
    decided = "decision" in postings.columns
    # Steps that later columns share are projected first, so each is computed once.
    text = postings.withColumn("_text", strip(F.col("description")))
    marked = text.withColumns(
        {
            "_lower": F.lower("_text"),
            "_preferred": ex.from_marker(F.col("_text"), fv.PREFERRED_MARKER),
            "_required": ex.from_marker(F.col("_text"), fv.REQUIRED_MARKER),
        }
    )
    parts = marked.withColumns(
        {
            "_required": ex.required_block(
                F.col("_text"), F.col("_required"), F.col("_preferred")
            ),
            "_preferred": ex.preferred_block(F.col("_preferred")),
        }
    )
    body, lowered = F.col("_text"), F.col("_lower")
    required, preferred = F.col("_required"), F.col("_preferred")

    def or_else(value: Column, default: str) -> Column:
        return F.coalesce(blank_to_null(value), F.lit(default))

    def cut(value: Column, length: int | None) -> Column:
        return value if length is None else F.substring(value, 1, length)

    collected = blank_to_null(F.col("collected_at"))
    filled = {
        "record_id": record_id(F.col(position), id_prefix) if position else F.lit(""),
        "dataset_source": F.lit(dataset_source),
        "collection_date": F.coalesce(collected, F.lit(as_of) if as_of else today()),
        "source_url": F.col("url"),
        "source_platform": or_else(F.col("source_platform"), default_platform),
        "job_title": strip(F.col("job_title")),
        "employer": strip(F.col("company")),
        "location": strip(F.col("location")),
        "work_setting": ex.work_setting(F.col("location"), body, lowered),
        "education_requirements": ex.education(body),
        "required_qualifications": cut(required, text_length),
        "preferred_qualifications": cut(preferred, text_length),
        "credential_required": or_else(ex.credentials(body), fv.NOT_SPECIFIED),
        "credential_preferred": or_else(
            ex.preferred_credentials(body, preferred), fv.NOT_SPECIFIED
        ),
        "experience_requirements": ex.experience_phrases(body),
        "long_description": cut(body, long_text_length),
        "primary_responsibilities": cut(body, text_length),
        # A required block is blank only when the whole text is.
        "qualifications": cut(required, text_length),
        "technical_skills": ex.skills(lowered, fv.TECHNICAL_SKILLS),
        "soft_skills": ex.skills(lowered, fv.SOFT_SKILLS),
        "ai_or_emerging_technology_skills": ex.skills(lowered, fv.AI_SKILLS),
        "salary_or_pay": or_else(strip(F.col("salary")), fv.NOT_LISTED),
        "employment_type": ex.employment_type(body, F.col("salary"), lowered),
        "notes": notes(with_decision=decided),
    }
    columns = [
        filled.get(name, F.lit(default)).alias(name)
        for name, default in fv.RECORD_DEFAULTS.items()
    ]
    return parts.select("ord", *columns, *(["decision"] if decided else []))


def normalize_all(
    postings: DataFrame, decisions: DataFrame | None = None, **options
) -> DataFrame:
    """Normalise every posting with ids from its position.

    ``decisions`` (``ord``, ``decision``) are matched by order; a posting without one
    gets notes without the filter parts.
    """
    if decisions is not None:
        postings = postings.join(decisions.select("ord", "decision"), "ord", "left")
    return normalize(number_rows(postings), position="seq", **options)
