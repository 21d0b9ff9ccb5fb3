import pytest
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions import extract as ex
from jobloom.functions import text as tx
from jobloom.operators import decide


@pytest.fixture(scope="module")
def value(spark):
    def compute(make, *texts):
        shape = ", ".join(f"c{i} string" for i in range(len(texts)))
        df = spark.createDataFrame([texts], shape)
        return df.select(make(*[F.col(f"c{i}") for i in range(len(texts))]).alias("v")).first().v

    return compute


def key(value, title="", company="", location="", url=""):
    return value(lambda t, c, p, u: tx.posting_key(t, c, p, tx.normalized(u)), title, company, location, url)


def test_normalized_covers_unicode_spaces(value):
    assert value(tx.normalized, " \x1c A\t  B\n　") == "a b"
    assert tx.WHITESPACE == "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def test_posting_keys(value):
    assert key(value, url="https://x/viewjob?JK=Ab1&from=s") == "url::jk::ab1"
    assert key(value, url="https://X/p?jk=#top") == "url::https://x/p?jk="
    assert key(value, url=" #top ") == "url::"
    assert key(value, " Coder ", "B", "T  X", "\t") == "tcl::coder|b|t x"
    assert value(tx.job_key_of_url, "https://x/?a=1&jk=Ab1#z") == "Ab1"


@pytest.mark.parametrize(
    "text, keyword, found",
    [
        ("RN-2 Auditor", "RN", True),
        ("Registered Nurse", "RN", False),
        ("rn_1", "RN", True),
        ("Intern", "rn ", False),
        ("skill K9", "K9", True),
        ("ſql", "SQL", True),
        ("Nursing home", "Nurse", False),
        ("NURSE practitioner", "nurse", True),
        ("a.b", "a+b", False),
        ("anything", "  ", False),
        ("C++ dev", "C++", True),
    ],
)
def test_keywords(value, text, keyword, found):
    def hit(column):
        fields = {"text": column, "text_lower": F.lower(column)}
        return decide.keyword_hits(fields, "text", [keyword], "{}")[0]

    assert value(hit, text) is found


def test_url_and_list_helpers(value):
    assert value(tx.form_encoded, "a b~*-_.&C++") == "a+b~%2A-_.%26C%2B%2B"
    assert value(tx.slug, "New Orleans, LA" + "x" * 50) == "New_Orleans_LA" + "x" * 26
    assert value(lambda c: tx.split_list(c, ";"), " a ;; b; ") == ["a", "b"]
    assert tx.split_keyword_text(" RHIA | |HIM ") == ["RHIA", "HIM"]
    assert [value(tx.word_count, t) for t in ("", " a ", "a \t b")] == [0, 1, 2]
    assert value(tx.section_of, " TITLE ") == "title_keywords"
    assert value(tx.section_of, "Texas") is None


@pytest.mark.parametrize(
    "text, years, most",
    [
        ("2-4 years HIM. At least 3 yrs", [4, 3], 4),
        ("minimum of 12 YEARS", [12, 12], 12),
        ("5+ yrs; 10  +  year", [5, 10], 10),
        ("٣ years", [3], 3),
        ("none", [], -1),
    ],
)
def test_years(value, text, years, most):
    assert value(ex.years_mentioned, text) == years
    assert value(ex.most_years, text) == most


def test_years_beyond_bigint_still_count_as_large(value):
    assert value(ex.most_years, "9" * 25 + " years") > 1e18


@pytest.mark.parametrize(
    "text, amounts",
    [
        ("$70,000 - $85,000.75 a year", [70000, 85000]),
        ("$28 - $35 an hour", [58240, 72800]),
        ("$ 500 /hr and $499.99 per Hour", [500, 1039979]),
        ("$, and $ 5 bonus", [5]),
        ("no pay", []),
    ],
)
def test_pay(value, text, amounts):
    assert value(ex.annual_amounts, text) == amounts
    least = value(lambda c: F.floor(ex.least_annual_amount(c)), text)
    assert least == min(amounts) if amounts else least > 10**18


@pytest.mark.parametrize(
    "text, required, preferred",
    [
        ("Requirements: A, B.\nPreferred: C.", "Requirements: A, B.\nPreferred: C.", "C."),
        ("Preferred: C. Requirements: A.", "A.", "C. Requirements: A."),
        ("Requirements: A", "A", ""),
        ("text requirements", "text requirements", ""),
        ("nothing", "nothing", ""),
        ("RHIA preferred. X", "RHIA preferred. X", ". X"),
        ("Nice to have cloud", "Nice to have cloud", "cloud"),
        ("plus requirement", "plus requirement", "requirement"),
    ],
)
def test_required_and_preferred_blocks(value, text, required, preferred):
    p = lambda c: ex.from_marker(c, fv.PREFERRED_MARKER)
    r = lambda c: ex.from_marker(c, fv.REQUIRED_MARKER)
    assert value(lambda c: ex.required_block(c, r(c), p(c)), text) == required
    assert value(lambda c: ex.preferred_block(p(c)), text) == preferred


def test_text_coding(value):
    assert value(ex.credentials, "RHIA, rhia, CCS; RHIAx éCPC") == "RHIA; rhia; CCS"
    assert value(ex.education, "Bachelor's degree, Ph.D. or masters") == "Bachelor's degree; Ph.D.; master"
    assert value(ex.experience_phrases, "2 years x . 3+ years . 2 years x.") == "2 years x; 3+ years"
    skills = lambda c: ex.skills(F.lower(c), fv.TECHNICAL_SKILLS)
    assert value(skills, "excellent ICD-10-CM work") == "Excel; ICD-10-CM; ICD-10; R"
    ai = lambda c: ex.skills(F.lower(c), fv.AI_SKILLS)
    assert value(ai, "maintain html, NLP") == "NLP; AI; ML"


@pytest.mark.parametrize(
    "location, text, label",
    [
        ("Remote", "hybrid work", "Hybrid"),
        ("Remote", "", "Remote"),
        ("", "remotely", "Not Specified"),
        ("x", "work on site", "On Site"),
        ("in", "person", "On Site"),
        ("", "onſite", "On Site"),
    ],
)
def test_work_setting(value, location, text, label):
    make = lambda p, c: ex.work_setting(p, c, F.lower(c))
    assert value(make, location, text) == label


@pytest.mark.parametrize(
    "text, salary, label",
    [
        ("contract, full time", "", "Full Time"),
        ("", "Part-time $20", "Part Time"),
        ("internship", "", "Internship"),
        ("internal", "", "Not Specified"),
        ("temporary", "", "Temporary"),
    ],
)
def test_employment_type(value, text, salary, label):
    make = lambda c, s: ex.employment_type(c, s, F.lower(c))
    assert value(make, text, salary) == label


def test_first_letters_cover_every_alternative():
    assert tx._first_letters(fv.CREDENTIAL_PATTERN) == "(?=(?-iu:[bBcCrR]))"
    assert tx._first_letters(fv.YEARS_PATTERNS[0]) == ""
    assert tx._first_letters("a?b") == ""
