import pytest
from pyspark.sql import functions as F

from examples import EXCLUSION, INCLUSION, posting
from jobloom import fixed_values as fv
from jobloom.operators import validate
from jobloom.operators.decide import PostingFilter
from jobloom.operators.dedupe import first_postings, first_records
from jobloom.operators.normalize import normalize, normalize_all
from jobloom.schemas import RECORD_FIELDS, as_postings

DICTIONARY = validate.Dictionary(
    {name: "Date" if name == "collection_date" else "String" for name in RECORD_FIELDS},
    {"work_setting": ("Remote", "Hybrid"), "employer": ("x" * 61,)},
)


def test_first_seen_postings(make_postings):
    df = make_postings(
        posting(url="https://x.com/viewjob?jk=1"),
        posting(url="https://x.com/viewjob?jk=1&from=search"),
        posting(job_title="Coder", company="B", location="TX", url=""),
        posting(job_title="coder ", company="b", location="tx", url=" "),
        posting(url="https://x.com/p#a"),
        posting(url="https://X.com/p#b"),
    )
    assert sorted(r.ord for r in first_postings(df).collect()) == [0, 2, 4]


def test_a_hot_key_shrinks_before_the_shuffle(make_postings):
    plan = first_postings(make_postings(posting()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_records_need_no_second_pass(make_postings):
    df = make_postings(*[posting(url=u) for u in ("", " ", "a#1", "A#2", "?jk=1", "&jk=1")])
    unique = normalize(first_postings(df))
    assert first_records(unique).count() == unique.count() == 3


def test_normalised_posting(make_postings):
    row = posting(
        job_title=" Data Governance  Analyst ",
        company="Delta Imaging",
        location="Tupelo, MS",
        salary="$77,000 a year",
        description=(
            "Build SQL and Tableau reports. Epic preferred. "
            "Master's degree required. CHDA preferred. 4 years experience."
        ),
        url="https://work.example.net/viewjob?jk=r9",
        source_platform="",
        collected_at="2026-08-03",
        search_keyword="Data Quality",
        posting_date="Demo dataset",
    )
    decided = PostingFilter(INCLUSION, EXCLUSION).decide(make_postings(row))
    record = normalize(decided.withColumn("n", F.lit(12345)), position="n").first()
    assert list(record.asDict())[1:-1] == list(RECORD_FIELDS)
    assert record.record_id == "IND12345"
    assert record.source_platform == "Indeed"
    assert record.job_title == "Data Governance  Analyst"
    assert record.technical_skills == "SQL; Tableau; Epic; R"
    assert record.ai_or_emerging_technology_skills == ""
    assert record.credential_required == record.credential_preferred == "CHDA"
    assert record.experience_requirements == "4 years experience"
    assert record.education_requirements == "Master's degree"
    assert record.required_qualifications == row["description"]
    assert record.preferred_qualifications.startswith(". Master's degree required")
    assert record.work_setting == record.employment_type == "Not Specified"
    assert record.notes == (
        "Posting date: Demo dataset; Search keyword: Data Quality; "
        "Filter stage: accepted; Filter reasons: matched location abbreviation for "
        "'Mississippi'; no keyword inclusion rules configured; passed all exclusion rules; "
        + fv.DEMO_NOTE
    )


def test_blank_posting_takes_defaults(make_postings):
    record = normalize(make_postings({}), as_of="2026-01-02").first()
    filled = {k: v for k, v in record.asDict().items() if v and k != "ord"}
    assert filled == {
        "dataset_source": "Indeed",
        "collection_date": "2026-01-02",
        "source_platform": "Indeed",
        "salary_or_pay": "Not Listed",
        **{k: v for k, v in fv.RECORD_DEFAULTS.items() if v == "Not Specified"},
    }


def test_long_text_is_cut_by_characters(make_postings):
    text = "é" * 9000
    record = normalize(make_postings(posting(description=text))).first()
    assert record.long_description == text[:8000]
    assert record.qualifications == record.required_qualifications == text[:4000]


def test_normalise_all_matches_decisions_by_order(spark, make_postings):
    df = make_postings(posting(), posting(), posting())
    decisions = PostingFilter(INCLUSION, EXCLUSION).decide(df).where("ord = 1")
    rows = normalize_all(df, decisions.select("ord", "decision")).orderBy("ord").collect()
    assert [r.record_id for r in rows] == ["IND0001", "IND0002", "IND0003"]
    assert ["Filter stage" in r.notes for r in rows] == [False, True, False]


def test_posting_contract_keeps_extra_columns(spark):
    df = spark.createDataFrame([(7, None, 3)], "ord bigint, job_title string, views int")
    row = as_postings(df).first()
    assert (row.job_title, row.url, row.extras) == ("", "", {"views": "3"})
    again = as_postings(as_postings(df).withColumn("lang", F.lit("en"))).first()
    assert again.extras == {"views": "3", "lang": "en"}


@pytest.fixture(scope="module")
def records(make_postings):
    rows = [
        posting(collected_at="2026-08-03"),
        posting(url=" ", company=" ", collected_at=" 2026-08 "),
        posting(collected_at="08/03/2026", description="hybrid"),
    ]
    return normalize(make_postings(*rows).withColumn("n", F.col("ord") + 1), position="n").cache()


def test_issues(records):
    wider = validate.Dictionary({**DICTIONARY.data_types, "shift": "String"})
    found = validate.validation_issues(records, wider).orderBy("ord", "issue_pos").collect()
    assert [(r.record_id, r.field, r.message, r.severity) for r in found] == [
        ("IND0001", "shift", "schema field missing from JobRecord model", "warning"),
        ("IND0002", "source_url", "required field is empty", "error"),
        ("IND0002", "employer", "required field is empty", "error"),
        ("IND0002", "shift", "schema field missing from JobRecord model", "warning"),
        ("IND0003", "collection_date", "date-like value may be nonstandard: 08/03/2026", "warning"),
        ("IND0003", "shift", "schema field missing from JobRecord model", "warning"),
    ]
    assert wider.missing_from_records == ("shift",)


def test_only_errors_drop_a_record_and_ids_close_up(records):
    valid = validate.without_errors(records, DICTIONARY)
    ids = [r.record_id for r in validate.renumber(valid).orderBy("ord").collect()]
    assert ids == ["IND0001", "IND0002"]


def test_allowed_values_are_opt_in(spark, records):
    assert validate.validation_issues(records, DICTIONARY).where("field = 'work_setting'").count() == 0
    found = validate.validation_issues(records, DICTIONARY, enforce_allowed_values=True)
    assert found.where("field in ('work_setting', 'employer') and severity = 'warning'").count() == 0
    narrow = validate.Dictionary(DICTIONARY.data_types, {"work_setting": ("Remote",)})
    found = validate.validation_issues(records, narrow, enforce_allowed_values=True)
    assert [r.message for r in found.where("field = 'work_setting'").collect()] == [
        "value 'Hybrid' not in allowed examples"
    ]
    table = spark.createDataFrame(
        [("work_setting", "Remote"), ("employer", "x" * 61)], "variable_name string, value string"
    )
    rows = validate.not_allowed_values(records, table).collect()
    assert [(r.field, r.value) for r in rows] == [("work_setting", "Hybrid")]


def test_dictionary_decides_columns_and_order(records):
    wanted = validate.Dictionary({"notes": "", "shift": "", "record_id": ""})
    out = validate.in_dictionary_order(records, wanted)
    assert out.columns == ["notes", "shift", "record_id"]
    assert out.first().shift == ""
