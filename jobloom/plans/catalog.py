"""The registered queries: each operator over the driver's tables, whole."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom import fixed_values as fv
from jobloom.functions import extract as ex
from jobloom.functions import text as tx
from jobloom.operators import decide, normalize, pages, rule_tables, validate
from jobloom.operators.dedupe import first_postings, first_records, keep_first
from jobloom.operators.ordering import number_rows, record_id
from jobloom.plans import across_runs
from jobloom.plans import testdata as td
from jobloom.plans.coding_run import numbered_records
from jobloom.session import configure, new_run_folder, spread, stage
from jobloom.sinks.writers import archive, read_csv, write_csv, write_json
from jobloom.sources import sheets
from jobloom.sources.frontier import search_frontier
from jobloom.sources.plugins import or_fallback, union_sources
from jobloom.sources.saved_pages import page_postings, scan_saved_pages
from jobloom.streaming.ingest import with_key

AS_OF = "2026-08-03"
INCLUSION = decide.InclusionRules(
    locations=("Louisiana", "Arkansas", "Mississippi", "Texas", "Remote")
)
EXCLUSION = decide.ExclusionRules(
    title_keywords=("Nursing", "RN", "Nurse"),
    career_level_keywords=("VP", "Senior"),
    maximum_years=7,
    maximum_annual=150000,
)
# The same with lists for the two keyword rules that the rules above leave open.
RELEVANCE = decide.InclusionRules(
    locations=INCLUSION.locations,
    title_keywords=("Coding", "HIM"),
    keywords=("FHIR",),
    description_keywords=("SQL",),
)
WITH_DESCRIPTION = decide.ExclusionRules(
    title_keywords=EXCLUSION.title_keywords,
    description_keywords=("sign-on bonus", "BI"),
    career_level_keywords=EXCLUSION.career_level_keywords,
    maximum_years=7,
    maximum_annual=150000,
)
DICTIONARY = validate.Dictionary(
    {
        name: "Date" if name == "collection_date" else "String"
        for name in fv.RECORD_DEFAULTS
    },
    {
        "dataset_source": ("LinkedIn", "Indeed"),
        "source_platform": ("LinkedIn", "Indeed"),
        "work_setting": ("Remote", "Hybrid", "Not Specified"),
        "employment_type": ("Full Time", "Part Time", "Not Specified"),
        "notes": ("a value longer than sixty characters switches the check off here",),
    },
)
WIDER_DICTIONARY = validate.Dictionary(
    {**DICTIONARY.data_types, "shift_pattern": "String", "revised_date": "Date"}
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _unique(spark, sf):
    return first_postings(td.postings(spark, sf))


def _decided(spark, sf):
    return decide.PostingFilter(INCLUSION, EXCLUSION).decide(_unique(spark, sf))


def _records(spark, sf):
    # Numbering reads the decisions twice, so they are kept as a table, as a run does.
    return numbered_records(stage(_decided(spark, sf), "decisions"), as_of=AS_OF)


def _description(spark, sf):
    return td.texts(spark, sf).withColumn("text", tx.strip(F.col("description")))


# --- keys and first-seen rows ---


@_query
def dedupe_key(spark, sf):
    key = tx.posting_key(*[F.col(c) for c in ("job_title", "company", "location", "link")])
    linked = td.postings(spark, sf).withColumn("link", tx.normalized(F.col("url")))
    return linked.select("ord", key.alias("dedupe_key"))


@_query
def dedupe_first_seen(spark, sf):
    return _unique(spark, sf).select("ord", "job_title", "company", "location", "url")


@_query
def dedupe_documents(spark, sf):
    documents = td.table(spark, sf, "documents").select("doc_id", "text", "source")
    documents = spread(documents, "doc_id")
    # Whole documents as keys are compared by digest, so that the text is not moved.
    key = F.sha2(tx.normalized(F.col("text")), 256)
    keyed = documents.select("doc_id", "source", key.alias("digest"))
    return keep_first(keyed, F.col("digest"), "doc_id").select("doc_id", "source")


@_query
def record_dedupe(spark, sf):
    records = normalize.normalize(td.postings(spark, sf), as_of=AS_OF)
    return first_records(records).select("ord", "job_title", "employer", "source_url")


# --- search pages, result pages, cards ---


@_query
def frontier(spark, sf):
    keywords = td.table(spark, sf, "customer").select(F.col("c_name").alias("keyword"))
    return search_frontier(keywords, ("New Orleans, LA", "Remote*~", "a&b=C++"), 3)


@_query
def page_block_class(spark, sf):
    reason = pages.block_reason(F.col("html"), F.col("status_code"))
    return td.result_pages(spark, sf).select("page_id", reason.alias("block_reason"))


@_query
def page_block_class_unknown_status(spark, sf):
    web = td.table(spark, sf, "pages").select("page_id", "html")
    known = pages.block_reason(F.col("html"), F.lit(200)).alias("with_status")
    return web.select("page_id", pages.block_reason(F.col("html")).alias("without_status"), known)


@_query
def page_block_counts(spark, sf):
    return pages.block_counts(td.result_pages(spark, sf), "status_code")


_CARD_COLUMNS = ("page_id", "card_ord", *pages.CARD_FIELDS)


@_query
def page_cards(spark, sf):
    html = td.result_pages(spark, sf).select("page_id", "html")
    return pages.titled(pages.read_cards(html)).select(*_CARD_COLUMNS)


@_query
def page_cards_dedup(spark, sf):
    html = td.result_pages(spark, sf).select("page_id", "html")
    return pages.first_of_page(pages.read_cards(html)).select(*_CARD_COLUMNS)


@_query
def page_cards_dedup_table(spark, sf):
    cards = (
        td.postings(spark, sf)
        .withColumnRenamed("ord", "card_ord")
        .withColumn("page_id", F.floor(F.col("card_ord") / 10).cast("bigint"))
        .withColumn("job_key", tx.job_key_of_url(F.col("url")))
    )
    return pages.first_of_page_in_table(cards).select("page_id", "card_ord", "job_key")


@_query
def cards_as_postings(spark, sf):
    return page_postings(
        td.result_pages(spark, sf),
        default_keyword="Health Informatics",
        default_location="Texas",
        as_of=AS_OF,
    )


@_query
def card_detail_enrich(spark, sf):
    html = td.result_pages(spark, sf).select("page_id", "html")
    cards = pages.first_of_page(pages.read_cards(html))
    enriched = pages.with_details(cards, td.detail_pages(spark, sf), ("page_id", "card_ord"))
    return enriched.select("page_id", "card_ord", "url", "description")


@_query
def page_scan_order(spark, sf):
    folder = new_run_folder(spark, "saved-pages")
    named = td.result_pages(spark, sf).select(
        F.concat(F.lit("_p"), F.col("page_id").cast("string"), "file_name").alias("name"), "html"
    )
    local = folder.removeprefix("file://")
    named.foreachPartition(lambda rows: _save_pages(rows, local))
    scanned = scan_saved_pages(spark, local)
    return scanned.select(
        "page_id", "file_name", F.length("html").cast("bigint").alias("n_chars")
    )


def _save_pages(rows, folder):
    uri = folder if "://" in folder else f"file://{folder}"
    system, root = fs.FileSystem.from_uri(uri)
    system.create_dir(root)
    for row in rows:
        with system.open_output_stream(f"{root}/{row['name']}") as stream:
            stream.write(pa.py_buffer(row["html"].encode()))


@_query
def provenance_from_name(spark, sf):
    keyword, location = pages.provenance(F.col("file_name"), "Health Informatics", "Texas")
    return td.result_pages(spark, sf).select(
        "page_id", keyword.alias("search_keyword"), location.alias("search_location")
    )


# --- rules one by one ---


def _one_rule(spark, sf, handler, inclusion=None, exclusion=None, source=td.postings):
    alone = decide.PostingFilter(
        inclusion or decide.InclusionRules(),
        exclusion or decide.ExclusionRules(),
        inclusion_handlers=[("rule", handler)] if inclusion else None,
        exclusion_handlers=None if inclusion else [("rule", handler)],
    )
    alone.stages = [stage for stage in alone.stages if stage[0].endswith(":rule")]
    decided = alone.decide(source(spark, sf))
    reasons = F.when(
        F.col("decision.included"), F.slice("decision.reasons", 1, F.size("decision.reasons") - 1)
    ).otherwise(F.col("decision.reasons"))
    return decided.select(
        "ord", F.col("decision.included").alias("passes"), F.array_join(reasons, "; ").alias("reasons")
    )


@_query
def loc_match(spark, sf):
    return _one_rule(spark, sf, decide.location_inclusion, inclusion=INCLUSION)


@_query
def loc_match_long_list(spark, sf):
    # A thousand places that never match come before the states.
    places = tuple(f"Parish {i}" for i in range(1_000)) + INCLUSION.locations
    rules = decide.InclusionRules(locations=places)
    return _one_rule(spark, sf, decide.location_inclusion, inclusion=rules)


@_query
def keyword_include(spark, sf):
    return _one_rule(spark, sf, decide.keyword_inclusion, inclusion=RELEVANCE)


@_query
def excl_title(spark, sf):
    return _one_rule(spark, sf, decide.title_exclusion, exclusion=EXCLUSION)


@_query
def excl_title_long_list(spark, sf):
    words = tuple(f"Surgeon {i}" for i in range(1_000))
    rules = decide.ExclusionRules(title_keywords=words + EXCLUSION.title_keywords)
    return _one_rule(spark, sf, decide.title_exclusion, exclusion=rules)


# --- rules as tables ---


def _searched(spark, sf):
    text = F.concat_ws(" ", "job_title", "company", "url")
    return td.postings(spark, sf).select("ord", text.alias("text"))


@_query
def keyword_table_hits(spark, sf):
    return rule_tables.keyword_hits(_searched(spark, sf), td.keywords(spark, sf))


@_query
def keyword_table_any(spark, sf):
    parts = td.keywords(spark, sf).where("startswith(keyword, 'D')")
    return rule_tables.having_any(_searched(spark, sf), parts).select("ord")


@_query
def keyword_table_none(spark, sf):
    parts = td.keywords(spark, sf).where("startswith(keyword, 'D')")
    return rule_tables.having_none(_searched(spark, sf), parts).select("ord")


@_query
def location_table_first(spark, sf):
    rules = spark.sql(td.PLACES_SQL, customer=td.table(spark, sf, "customer"))
    rules = rules.withColumn("sheet_id", F.lit("places"))
    placed = td.postings(spark, sf).select(
        "ord", F.lit("places").alias("sheet_id"), tx.normalized(F.col("location")).alias("location")
    )
    reasons = rule_tables.location_reasons(placed, rules)
    return placed.join(reasons, ["sheet_id", "location"], "left").select("ord", "location", "reason")


@_query
def decision_by_sheet(spark, sf):
    postings, inclusion, exclusion = td.own_sheets(spark, sf)
    decided = rule_tables.decide_by_sheet(
        postings, sheets.inclusion_rules(inclusion), sheets.exclusion_rules(exclusion)
    )
    return decided.select(
        "ord", "sheet_id", "decision.included", "decision.stage",
        F.array_join("decision.reasons", "; ").alias("reasons"),
    )


@_query
def excl_description(spark, sf):
    return _one_rule(
        spark, sf, decide.description_exclusion, exclusion=WITH_DESCRIPTION, source=td.texts
    )


@_query
def excl_career(spark, sf):
    return _one_rule(
        spark, sf, decide.career_level_exclusion, exclusion=EXCLUSION, source=td.texts
    )


@_query
def excl_experience(spark, sf):
    return _one_rule(
        spark, sf, decide.experience_exclusion, exclusion=EXCLUSION, source=td.texts
    )


@_query
def excl_salary(spark, sf):
    return _one_rule(
        spark, sf, decide.salary_exclusion, exclusion=EXCLUSION, source=td.texts
    )


@_query
def years_extract(spark, sf):
    text = F.concat_ws(" ", "job_title", "description")
    years = ex.years_mentioned(text).cast("array<string>")
    most = F.col("most")
    return td.texts(spark, sf).select(
        "ord", F.array_join(years, "; ").alias("years"), ex.most_years(text).alias("most")
    ).select("ord", "years", F.when(most >= 0, ex.whole(most)).alias("most_years"))


@_query
def pay_annual(spark, sf):
    text = F.concat_ws(" ", "salary", "description")
    amounts = ex.annual_amounts(text).cast("array<string>")
    least = F.col("least")
    return td.texts(spark, sf).select(
        "ord",
        F.array_join(amounts, "; ").alias("amounts"),
        ex.least_annual_amount(text).alias("least"),
    ).select(
        "ord", "amounts", F.when(least < ex.NO_AMOUNT, ex.whole(least)).alias("least_amount")
    )


# --- the rule chain ---


@_query
def filter_decision(spark, sf):
    rules = decide.PostingFilter(RELEVANCE, WITH_DESCRIPTION)
    decided = rules.decide(_unique(spark, sf))
    return decided.select(
        "ord",
        "decision.included",
        "decision.stage",
        F.array_join("decision.reasons", "; ").alias("reasons"),
    )


@_query
def filter_audit(spark, sf):
    return decide.audit_rows(_decided(spark, sf))


@_query
def filter_counts(spark, sf):
    return decide.included_counts(_decided(spark, sf))


@_query
def filter_stage_counts(spark, sf):
    decided = _decided(spark, sf)
    return decided.groupBy(F.col("decision.stage").alias("stage")).agg(
        F.count(F.lit(1)).alias("postings")
    )


def _has_platform(posting, rules):
    named = posting["source_platform"] != ""
    return named, F.array(F.when(named, "platform named").otherwise("platform missing"))


@_query
def custom_handler(spark, sf):
    rules = decide.PostingFilter(
        INCLUSION,
        EXCLUSION,
        inclusion_handlers=[("platform", _has_platform)],
        exclusion_handlers=[("title_keywords", decide.title_exclusion)],
    )
    decided = rules.decide(td.postings(spark, sf))
    return decided.select(
        "ord", "decision.stage", F.array_join("decision.reasons", "; ").alias("reasons")
    )


@F.arrow_udf(T.BooleanType())
def _is_long_winded(texts: pa.Array) -> pa.Array:
    """Whether more than two words of a text are said again, counted in Python."""
    found = []
    for text in texts.to_pylist():
        words = (text or "").lower().split()
        if "nurse" in words:
            raise ValueError("a row that does not reach this rule was shown to it")
        found.append(len(words) - len(set(words)) > 2)
    return pa.array(found, pa.bool_())


@decide.apart
def _not_long_winded(posting, rules):
    long_winded = _is_long_winded(posting["title_and_description"])
    return ~long_winded, F.when(long_winded, F.array(F.lit("says things again"))).otherwise(decide.no_reasons())


@_query
def python_handler(spark, sf):
    rules = decide.PostingFilter(
        INCLUSION, EXCLUSION,
        exclusion_handlers=[
            ("title_keywords", decide.title_exclusion), ("wording", _not_long_winded),
            ("career_level", decide.career_level_exclusion),
        ],
    )
    decided = rules.decide(td.postings(spark, sf))
    return decided.select("ord", "decision.stage", F.array_join("decision.reasons", "; ").alias("reasons"))


@_query
def source_plugin_union(spark, sf):
    def documents(session):
        return td.table(session, sf, "documents").select(
            F.col("doc_id").alias("ord"), F.col("text").alias("description"), "lang", "source"
        )

    both = union_sources(spark, [lambda session: td.postings(session, sf), documents])
    return both.select(
        "ord",
        "job_title",
        "url",
        F.length("description").cast("bigint").alias("n_chars"),
        F.coalesce(F.col("extras")["lang"], F.lit("")).alias("lang"),
        F.coalesce(F.col("extras")["source"], F.lit("")).alias("source"),
    )


@_query
def source_fallback(spark, sf):
    board = td.postings(spark, sf)
    none = board.where(F.col("source_platform") == "no such board")
    return or_fallback(none, board).select("ord", "job_title")


@_query
def run_counters(spark, sf):
    decided = stage(_decided(spark, sf), "decisions")
    records = stage(numbered_records(decided, as_of=AS_OF), "records")
    errors = validate.validation_issues(records, DICTIONARY)
    counts = [
        td.postings(spark, sf).agg(F.count(F.lit(1)).alias("value")).select(
            F.lit("postings").alias("counter"), "value"
        ),
        decide.included_counts(decided).select(
            F.stack(
                F.lit(2), F.lit("unique"), "total", F.lit("included"), "included"
            ).alias("counter", "value")
        ),
        errors.groupBy(F.concat(F.lit("issues: "), "severity").alias("counter")).agg(
            F.count(F.lit(1)).alias("value")
        ),
        errors.where("severity = 'error'").agg(
            F.count_distinct("ord").alias("value")
        ).select(F.lit("dropped").alias("counter"), "value"),
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


# --- coding of free text ---


@_query
def work_setting(spark, sf):
    label = ex.work_setting(F.col("location"), F.col("text"), F.lower("text"))
    return _description(spark, sf).select("ord", label.alias("work_setting"))


@_query
def employment_type(spark, sf):
    label = ex.employment_type(F.col("text"), F.col("salary"), F.lower("text"))
    return _description(spark, sf).select("ord", label.alias("employment_type"))


@_query
def credentials(spark, sf):
    return _description(spark, sf).select("ord", ex.credentials(F.col("text")).alias("credentials"))


@_query
def education(spark, sf):
    return _description(spark, sf).select("ord", ex.education(F.col("text")).alias("education"))


@_query
def cred_preferred(spark, sf):
    preferred = ex.preferred_block(ex.from_marker(F.col("text"), fv.PREFERRED_MARKER))
    return _description(spark, sf).withColumn("preferred", preferred).select(
        "ord",
        ex.preferred_credentials(F.col("text"), F.col("preferred")).alias("credentials"),
    )


def _skill_query(spark, sf, catalogue):
    postings = td.postings(spark, sf).select("ord", F.col("description").alias("text"))
    documents = spread(td.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    documents = documents.select((-F.col("doc_id") - 1).alias("ord"), "text")
    lowered = postings.unionByName(documents).select("ord", F.lower("text").alias("text"))
    return lowered.select("ord", ex.skills(F.col("text"), catalogue).alias("skills"))


@_query
def skills_technical(spark, sf):
    return _skill_query(spark, sf, fv.TECHNICAL_SKILLS)


@_query
def skills_soft(spark, sf):
    return _skill_query(spark, sf, fv.SOFT_SKILLS)


@_query
def skills_ai(spark, sf):
    return _skill_query(spark, sf, fv.AI_SKILLS)


@_query
def req_pref_split(spark, sf):
    text = F.col("text")
    return (
        _description(spark, sf)
        .withColumn("preferred", ex.from_marker(text, fv.PREFERRED_MARKER))
        .withColumn("required", ex.from_marker(text, fv.REQUIRED_MARKER))
        .select(
            "ord",
            ex.required_block(text, F.col("required"), F.col("preferred")).alias("required"),
            ex.preferred_block(F.col("preferred")).alias("preferred"),
        )
    )


@_query
def experience_phrases(spark, sf):
    phrases = ex.experience_phrases(F.col("text"))
    return _description(spark, sf).select("ord", phrases.alias("phrases"))


@_query
def notes(spark, sf):
    return _decided(spark, sf).select("ord", normalize.notes(with_decision=True).alias("notes"))


@_query
def normalize_records(spark, sf):
    decided = stage(_decided(spark, sf), "decisions")
    matched = decided.where(F.col("decision.stage") != "exclusion:salary")
    return normalize.normalize_all(
        decided.drop("decision"), matched.select("ord", "decision"), as_of=AS_OF
    ).drop("decision")


# --- validation, numbering, output ---


def _issues(spark, sf, dictionary, **options):
    issues = validate.validation_issues(_records(spark, sf), dictionary, **options)
    return issues.withColumn("issue_pos", F.col("issue_pos").cast("bigint"))


@_query
def validate_required(spark, sf):
    return _issues(spark, sf, DICTIONARY).where("severity = 'error'")


@_query
def validate_dates(spark, sf):
    return _issues(spark, sf, DICTIONARY).where("field = 'collection_date'")


@_query
def validate_allowed(spark, sf):
    return _issues(spark, sf, DICTIONARY, enforce_allowed_values=True)


@_query
def validate_allowed_table(spark, sf):
    # The allowed values as a table: every employer is one of the customers, no place a nation.
    employers = td.table(spark, sf, "customer").select(
        F.lit("employer").alias("variable_name"), F.col("c_name").alias("value")
    )
    places = td.table(spark, sf, "nation").select(
        F.lit("location").alias("variable_name"), F.col("n_name").alias("value")
    )
    allowed = employers.union(places)
    return validate.not_allowed_values(_records(spark, sf), allowed, ["employer", "location"])


@_query
def validate_coverage(spark, sf):
    return _issues(spark, sf, WIDER_DICTIONARY).where("field in ('shift_pattern', 'revised_date')")


@_query
def validate_split(spark, sf):
    return validate.without_errors(_records(spark, sf), DICTIONARY).select(
        "ord", "record_id", "source_url"
    )


@_query
def numbered_output(spark, sf):
    return _records(spark, sf).select("ord", "record_id")


@_query
def numbered_within_company(spark, sf):
    numbered = number_rows(td.postings(spark, sf).select("ord", "company"), within=["company"])
    return numbered.select("ord", record_id(F.col("seq"), "J").alias("record_id"))


def _final(spark, sf):
    records = stage(_records(spark, sf), "records")
    return validate.renumber(validate.without_errors(records, DICTIONARY))


@_query
def final_dataset(spark, sf):
    return validate.in_dictionary_order(_final(spark, sf), DICTIONARY)


@_query
def final_dataset_wider(spark, sf):
    return validate.in_dictionary_order(_final(spark, sf), WIDER_DICTIONARY).select(
        "record_id", "shift_pattern", "revised_date", "job_title"
    )


@_query
def sink_roundtrip_csv(spark, sf):
    folder = new_run_folder(spark, "records-csv")
    write_csv(validate.in_dictionary_order(_final(spark, sf).orderBy("ord"), DICTIONARY), folder)
    return read_csv(spark, folder)


@_query
def sink_roundtrip_json(spark, sf):
    folder = new_run_folder(spark, "records-json")
    records = validate.in_dictionary_order(_final(spark, sf).orderBy("ord"), DICTIONARY)
    write_json(records, folder)
    return spark.read.schema(records.schema).json(folder)


@_query
def sink_roundtrip_audit(spark, sf):
    folder = new_run_folder(spark, "audit-csv")
    write_csv(decide.audit_rows(_decided(spark, sf)), folder)
    return read_csv(spark, folder)


@_query
def raw_archive(spark, sf):
    # Written twice under one name: the second writing replaces the first.
    folder = new_run_folder(spark, "raw-postings")
    for _ in range(2):
        archive(td.postings(spark, sf), folder, F.col("collected_at").substr(1, 7), run="r1")
    return spark.read.parquet(folder).select(
        "ord", "job_title", "company", "location", "salary", "description", "url", "run",
        F.col("ingest_date").cast("string"),
    )


@_query
def unseen_by_archive(spark, sf):
    # Two runs: what was collected on the day of the first, and all the rest.
    folder = new_run_folder(spark, "archived-keys")
    keys = across_runs.open_archive(spark, folder, "archive_" + folder[-32:], 16)
    keyed = stage(with_key(td.postings(spark, sf)), "keyed-postings")
    first = keyed.where("collected_at = '2026-08-03'")
    across_runs.remember(keep_first(first, F.col("posting_key")), keys, "first")
    return across_runs.unseen(keyed.where("collected_at != '2026-08-03'"), keys).select("ord", "posting_key")


# --- sheets ---


@_query
def rules_inclusion(spark, sf):
    return sheets.inclusion_rules(td.sheets(spark, sf, td.INCLUSION_SHEETS_SQL))


@_query
def rules_exclusion(spark, sf):
    return sheets.exclusion_rules(td.sheets(spark, sf, td.EXCLUSION_SHEETS_SQL))


@_query
def dictionary_fields(spark, sf):
    return sheets.dictionary_fields(td.sheets(spark, sf, td.DICTIONARY_SHEETS_SQL)).select(
        "sheet_id", "ord", "variable_name", "label", "data_type", "allowed_values_kept"
    )


@_query
def allowed_values(spark, sf):
    fields = sheets.dictionary_fields(td.sheets(spark, sf, td.DICTIONARY_SHEETS_SQL))
    return sheets.allowed_values(fields).withColumn("pos", F.col("pos").cast("bigint"))
