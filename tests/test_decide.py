import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from examples import EXCLUSION, INCLUSION, posting
from jobloom.operators import decide
from jobloom.functions.text import normalized
from jobloom.operators.decide import ExclusionRules, InclusionRules, PostingFilter


@pytest.fixture(scope="module")
def decisions(make_postings):
    def run(*rows, rules=None):
        chain = rules or PostingFilter(INCLUSION, EXCLUSION)
        decided = chain.decide(make_postings(*rows)).orderBy("ord")
        return [(r.decision.stage, r.decision.reasons) for r in decided.collect()]

    return run


BY_LA = "matched location abbreviation for 'Louisiana'"
NO_KEYWORDS = "no keyword inclusion rules configured"


def test_stages_and_reasons(decisions):
    rows = [
        (posting(), "accepted", "passed all exclusion rules"),
        (posting(location="Remote"), "accepted", "passed all exclusion rules"),
        (posting(location=""), "inclusion:location", "missing location"),
        (posting(location="Seattle, WA"), "inclusion:location", "location not in inclusion list"),
        (posting(location="La Jolla, CA"), "accepted", "passed all exclusion rules"),
        (posting(job_title="Nurse RN"), "exclusion:title_keywords", "excluded title keyword 'Nurse'"),
        (
            posting(job_title="Senior VP", description="Over 10 years"),
            "exclusion:career_level",
            "excluded career-level keyword 'Senior'",
        ),
        (
            posting(description="Over 10 years experience required in HIM leadership"),
            "exclusion:experience",
            "experience requirement 10 years exceeds maximum 7",
        ),
        (posting(description="7 years"), "accepted", "passed all exclusion rules"),
        (
            posting(salary="$150,001 - $180,000"),
            "exclusion:salary",
            "salary/pay 150001 exceeds maximum annual 150000",
        ),
        (posting(salary="$150,000.99"), "accepted", "passed all exclusion rules"),
        (posting(salary="$90/hr"), "exclusion:salary", "salary/pay 187200 exceeds maximum annual 150000"),
        (
            posting(salary="$180,000", description="Bonus $5,000"),
            "accepted",
            "passed all exclusion rules",
        ),
        (
            posting(description="9" * 30 + " years"),
            "exclusion:experience",
            "experience requirement 9200000000000000000 years exceeds maximum 7",
        ),
    ]
    found = decisions(*[row for row, _, _ in rows])
    assert [(stage, reasons[-1]) for stage, reasons in found] == [(s, r) for _, s, r in rows]
    assert found[0][1] == [BY_LA, NO_KEYWORDS, "passed all exclusion rules"]
    assert found[3][1] == ["location not in inclusion list"]
    assert found[5][1][2:] == ["excluded title keyword 'RN'", "excluded title keyword 'Nurse'"]


def test_keyword_relevance(decisions):
    inclusion = InclusionRules(
        title_keywords=("Manager",), description_keywords=("SQL",), keywords=("manager him", "HIM")
    )
    rules = PostingFilter(inclusion, ExclusionRules())
    rows = [posting(job_title="Floor Manager", description="HIM upkeep"), posting(job_title="Coder", description="Python")]
    assert decisions(*rows, rules=rules) == [
        (
            "accepted",
            [
                "no location inclusion rules configured",
                "title inclusion keyword 'Manager'",
                "inclusion keyword 'manager him'",
                "inclusion keyword 'HIM'",
                "passed all exclusion rules",
            ],
        ),
        (
            "inclusion:relevance",
            [
                "no location inclusion rules configured",
                "no inclusion keywords matched title/description",
            ],
        ),
    ]


def test_long_lists_give_the_same_decisions(decisions):
    filler = tuple(f"Nowhere {i}" for i in range(1_000))
    inclusion = replace(INCLUSION, locations=filler + INCLUSION.locations)
    exclusion = replace(EXCLUSION, title_keywords=filler + EXCLUSION.title_keywords)
    rows = [
        posting(), posting(location=""), posting(location="Paris"), posting(location="remote, TX"),
        posting(job_title="Nurse RN"), posting(job_title="Nowhere 3 nursing"),
    ]
    long = decisions(*rows, rules=PostingFilter(inclusion, exclusion))
    short = decisions(*rows)
    assert long[:5] == short[:5]
    assert long[5][1][2:] == ["excluded title keyword 'Nowhere 3'", "excluded title keyword 'Nursing'"]


def test_custom_handlers_replace_the_defaults(decisions):
    def long_title(row, rules):
        short = F.length(row["job_title"]) < rules
        return short, F.when(short, F.array()).otherwise(F.array(F.lit("title too long")))

    rules = PostingFilter(
        InclusionRules(), 10, inclusion_handlers=[("any", lambda row, _: (F.lit(True), F.array()))],
        exclusion_handlers=[("length", long_title)],
    )
    assert decisions(posting(job_title="Coder"), posting(), rules=rules) == [
        ("accepted", ["passed all inclusion and exclusion rules"]),
        ("exclusion:length", ["title too long"]),
    ]
    assert len(PostingFilter(INCLUSION, EXCLUSION, exclusion_handlers=[]).stages) == 7


def test_audit_keeps_rejected_rows_and_counts_add_up(make_postings):
    rows = [posting(), posting(location="Paris")]
    decided = PostingFilter(INCLUSION, EXCLUSION).decide(make_postings(*rows))
    audit = {r.location: r for r in decide.audit_rows(decided).collect()}
    assert audit["Paris"].reasons == "location not in inclusion list"
    assert audit["Shreveport, LA"].included is True
    assert decide.included_counts(decided).first().asDict() == {"included": 1, "total": 2}


def test_plan_has_no_shuffle_and_no_python(make_postings):
    decided = PostingFilter(INCLUSION, EXCLUSION).decide(make_postings(posting()))
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_long_list_is_not_tried_rule_by_rule(spark):
    rng = random.Random(3)
    words = ["RN", "C++", "é", "ſ", "a", "nurse", "语言学家", "\U0001f600\U0001f601x", "data entry", "İst", "KG"]
    words += ["".join(rng.choices("abcé ", k=rng.randint(1, 7))) for _ in range(150)] + [f"Surgeon {i}" for i in range(150)]
    texts = ["".join(rng.choices([*words, " ", "-", "K", "ı", "RN2"], k=rng.randint(0, 6))) for _ in range(300)] + [None, "", "x" * 3000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    lowered = rows.select("i", "t", F.lower("t").alias("t_lower"), normalized(F.col("t")).alias("place"))
    posting = {name: F.col(name) for name in lowered.columns}
    places = [w.lower() for w in words] + ["Texas", "louisiana"]

    def found(limit):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decide, "LONG_LIST", limit)
            hit, reasons = decide.keyword_hits(posting, "t", words, "{}")
            place = decide.match_location(F.col("place"), places)
            return lowered.select("i", hit.alias("hit"), reasons.alias("reasons"), place.alias("p")).orderBy("i").collect()

    few = found(64)
    assert few == found(10_000) and sum(len(r.reasons) for r in few) > 1000
    tried = decide._rules_to_try(F.lit("surgeon 77 nurse"), [
        {"pos": i, "reason": "", "needle": f"surgeon {i:03}", "pattern": None} for i in range(1000)
    ])
    assert spark.range(1).select(F.size(tried)).first()[0] < 60


def test_a_few_rules_are_plain_expressions_with_the_same_reasons(spark, monkeypatch):
    texts = ["RN", "rn-2 and KG", "a Kg", "nurse rn", "Senior VP", "", None, "ſql", "x", "LA, tx", "lake"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = rows.select("i", "t", F.lower("t").alias("t_lower"), normalized(F.col("t")).alias("place"))
    words, places = ["RN", "kg", " ", "senior", "RN", "SQL", "nurse"], ["", "Louisiana", "texas", "la"]

    def found():
        hit, reasons = decide.keyword_hits({name: F.col(name) for name in rows.columns}, "t", words, "{}")
        df = rows.select("i", hit.alias("hit"), reasons.alias("why"), decide.match_location(F.col("place"), places).alias("p"))
        return df._jdf.queryExecution().optimizedPlan().toString(), df.orderBy("i").collect()

    plan, few = found()
    assert "lambda" not in plan and [r.hit for r in few] == [True, True, True, True, True, False, False, True, False, False, False]
    monkeypatch.setattr(decide, "PLAIN_LIST", 0)
    assert found()[1] == few
