"""Rules as tables against rules one by one."""

import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom.operators import decide, rule_tables
from jobloom.operators.decide import ExclusionRules, InclusionRules, PostingFilter

KEYWORDS = [
    "RN", "rn", " HIM ", "C++", "R&D", "data entry", "Coding", "ing", "§", "1", "e", "é", "Été", "medical records",
    "++", "a.b", "x_y", "Ünit", "  ", "", None, "records,", "KG", "no such thing", "語", "full-time role", ".*", "\\d",
    "SQL", "kit", "ıs", "long ſtory",
]
PIECES = ["RN", "nurse", "him", "HIM", "C++", "c++", "R&D", "data", "entry", "encoding", "1", "12", "été", "é", "ÉTÉ",
          "medical", "records", ",", " ", "\n", "x_y", "ünit", "kg", "5kg", "語語", "full-time", "role", ".", "a.b", "\\d", "§",
          "ſql", "sql", "\u212ait", "KIT", "ıs", "long ſtory", "LONG STORY"]


def _occurs(text, keyword):
    """By the rule's words: short ones apart from ASCII letters, others anywhere."""
    needle = (keyword or "").strip()
    if not needle or text is None:
        return False
    if len(needle) <= 3:
        return re.search(rf"(?i)(?<![A-Za-z]){re.escape(needle)}(?![A-Za-z])", text) is not None
    return needle.lower() in text.lower()


def _texts(spark, number=250):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choices(PIECES, k=rng.randint(0, 12)))) for i in range(number)]
    rows += [(number, None), (number + 1, ""), (number + 2, "medical records, " * 5_000)]
    return rows, spark.createDataFrame(rows, "ord bigint, text string").withColumn("run", F.lit("x"))


def test_hits_equal_every_keyword_with_every_text(spark):
    rows, texts = _texts(spark)
    rules = spark.createDataFrame([(k, "x") for k in KEYWORDS * 2], "keyword string, needle string")
    found = sorted(map(tuple, rule_tables.keyword_hits(texts, rules).collect()))
    expected = sorted((i, k) for i, t in rows for k in set(KEYWORDS) - {None} if _occurs(t, k))
    assert found == expected and len(found) > 300
    some = {i for i, _ in expected}
    assert {r.ord for r in rule_tables.having_any(texts, rules).collect()} == some
    assert {r.ord for r in rule_tables.having_none(texts, rules).collect()} == {i for i, _ in rows} - some


def test_no_rules_and_no_texts(spark):
    _, texts = _texts(spark, 5)
    none = spark.createDataFrame([], "keyword string")
    assert rule_tables.keyword_hits(texts, none).collect() == []
    assert rule_tables.having_none(texts, none).count() == texts.count()
    rules = spark.createDataFrame([("abc",)], "keyword string")
    assert rule_tables.keyword_hits(texts.limit(0), rules).collect() == []


def test_rules_are_joined_not_collected(spark):
    _, texts = _texts(spark, 5)
    rules = spark.range(20_000).select(F.concat(F.lit("word "), F.col("id").cast("string")).alias("keyword"))
    plan = rule_tables.keyword_hits(texts, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "Cartesian" not in plan and "word 19" not in plan


def test_places_are_tried_once_for_each_different_one(spark):
    places = ["Baton Rouge, LA", "la mesa, ca", "Remote (Texas)", "tx", "", "Arkansas City, KS", "éparish 7", "LA or TX"]
    rows = [(s, p.lower()) for s in ("a", "b", "c") for p in places] * 50
    rules = [("a", 0, "Nowhere"), ("a", 1, "Louisiana"), ("a", 2, "Texas"), ("b", 5, " REMOTE "), ("b", 3, "texas"),
             ("b", 4, "CA"), ("b", 9, ""), ("c", 1, "Arkansas")]
    table = spark.createDataFrame(rows, "sheet_id string, location string")
    listed = spark.createDataFrame(rules, "sheet_id string, ord bigint, value string")
    found = {(r.sheet_id, r.location): r.reason for r in rule_tables.location_reasons(table, listed).collect()}
    one = spark.createDataFrame([(p,) for p in {p for _, p in rows}], "p string")
    for sheet in "abc":
        allowed = [v for s, _, v in sorted(rules, key=lambda r: r[1]) if s == sheet]
        reason = decide.match_location(F.col("p"), allowed).alias("reason")
        for row in one.select("p", reason).collect():
            assert found.get((sheet, row.p)) == (row.reason if row.p else None)


@pytest.fixture(scope="module")
def sheet_rules(spark):
    including = [
        ("one", "locations", 1, "Texas"), ("one", "locations", 2, "Louisiana"), ("one", "title_keywords", 3, "HIM"),
        ("one", "title_keywords", 4, "HIM"), ("one", "keywords", 5, "sql"), ("two", "other_rules", 1, "x"),
        ("two", "description_keywords", 2, "Power BI"), ("three", "locations", 1, "Remote"),
    ]
    excluding = [
        ("one", "title_keywords", 1, "RN", None), ("one", "experience_rules", 2, "", 5), ("two", "salary_rules", 1, "", 90000),
        ("two", "career_level_keywords", 2, "Senior", None), ("four", "description_keywords", 1, "no such luck today", None),
    ]
    shape = "sheet_id string, bucket string, ord bigint, value string"
    return (
        including, excluding, spark.createDataFrame(including, shape),
        spark.createDataFrame(excluding, shape + ", num_value bigint"),
    )


def test_each_posting_is_decided_by_its_own_sheet(spark, make_postings, sheet_rules):
    including, excluding, inclusion, exclusion = sheet_rules
    rng = random.Random(1)
    rows = [
        {
            "job_title": rng.choice(["HIM Lead", "RN", "Senior Coder", ""]),
            "location": rng.choice(["Austin, TX", "Remote", "", "La Mesa"]),
            "description": rng.choice(["SQL and Power BI", "no such luck today, 7 years", "3 years", ""]),
            "salary": rng.choice(["$95,000", "$40/hr", ""]),
        }
        for _ in range(120)
    ]
    names = ["one", "two", "three", "four", "five", None]
    base = make_postings(*rows)
    sheet = F.element_at(F.array(*map(F.lit, names)), (F.col("ord") % len(names) + 1).cast("int"))
    postings = base.withColumn("sheet_id", sheet).withColumn("rank", F.lit("kept"))
    decided = rule_tables.decide_by_sheet(postings, inclusion, exclusion)
    assert decided.columns == [*postings.columns, "decision"]
    found = {r.ord: r.decision for r in decided.collect()}
    assert len(found) == len(rows)
    for i, name in enumerate(names):
        lists = lambda table: {
            b: tuple(r[3] for r in table if r[0] == name and r[1] == b) for b in {r[1] for r in table} if b.endswith("keywords") or b == "locations"
        }
        limit = lambda b: next((r[4] for r in excluding if r[0] == name and r[1] == b), None)
        chain = PostingFilter(
            InclusionRules(**lists(including)),
            ExclusionRules(**lists(excluding), maximum_years=limit("experience_rules"), maximum_annual=limit("salary_rules")),
        )
        for row in chain.decide(base.where(F.col("ord") % len(names) == i)).collect():
            assert found[row.ord] == row.decision, (name, row)


def test_pieces_without_a_keyword_are_dropped_before_the_shuffle(spark):
    rows = spark.range(3_000).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("piece"))
    few = rows.where("piece like 'd7%'")
    left = {r.piece for r in rule_tables._maybe_among(rows, "piece", few).collect()}
    known = {r.piece for r in few.collect()}
    assert known <= left and len(left) < len(known) + 10


def test_keywords_alike_in_every_piece_of_three_letters_are_told_apart(spark):
    # Filed under pieces of three digits, these hundred met every text, a hundred times each.
    rules = spark.createDataFrame([(f"1212{i:02}2121",) for i in range(100)], "keyword string")
    texts = spark.range(500).select(F.col("id").alias("ord"), F.format_string("x1212%02d2121y 1212", F.col("id") % 200).alias("text"))
    wanted = rule_tables._filed(rules, "keyword")
    assert rule_tables._cut(texts, "text", wanted).join(wanted, "piece").count() < 600
    found = sorted(map(tuple, rule_tables.keyword_hits(texts, rules).collect()))
    assert found == [(i, f"1212{i % 200:02}2121") for i in range(500) if i % 200 < 100]


def test_a_key_that_comes_twice_and_long_runs(spark):
    long = "ab" * 40
    texts = spark.createDataFrame(
        [(1, f"x{long}y"), (1, "data entry"), (1, f"{long} data entry"), (2, long[:60]), (None, "long runs, data entry")], "ord bigint, text string"
    )
    rules = spark.createDataFrame([(long,), (long[:50] + "c",), ("data entry",), ("entry",), ("runs",)], "keyword string")
    found = sorted((r.ord or 0, r.keyword) for r in rule_tables.keyword_hits(texts, rules).collect())
    assert found == [(0, "entry"), (0, "runs"), (1, long), (1, "data entry"), (1, "entry")]


def test_short_sheets_are_tried_on_their_postings_and_long_ones_matched(spark, make_postings, monkeypatch):
    titles = ["RN", "rn-2 him", "HIM C++", "", "no such thing", "ſql lead", "him", "Wing 7"]
    base = make_postings(*[{"job_title": t, "location": "Austin, TX", "description": d} for t in titles for d in ("SQL, R&D", "", "data entry 9 years")])
    postings = base.withColumn("sheet_id", F.when(F.col("ord") % 4 > 0, "hot").otherwise("b"))
    words = ["RN", "him", "SQL", "C++", "R&D", " data entry", "", "Wing 7", "such", "SQL"]
    including = [(s, b, i, w) for s in ("hot", "b") for b in ("title_keywords", "keywords", "description_keywords") for i, w in enumerate(words[::-1] if s == "b" else words)]
    excluding = [("hot", "title_keywords", 1, "Lead", None), ("b", "career_level_keywords", 2, "RN", None), ("hot", "experience_rules", 3, "", 5)]
    shape = "sheet_id string, bucket string, ord bigint, value string"
    inclusion = spark.createDataFrame(including, shape)
    exclusion = spark.createDataFrame(excluding, shape + ", num_value bigint")
    calls = []
    hits = rule_tables.keyword_hits
    monkeypatch.setattr(rule_tables, "keyword_hits", lambda texts, rules, key="ord": calls.append(key) or hits(texts, rules, key))

    def decided(short, share):
        monkeypatch.setattr(rule_tables, "SHORT_SHEET", short)
        monkeypatch.setattr(rule_tables, "SHARE", share)
        calls.clear()
        rows = rule_tables.decide_by_sheet(postings, inclusion, exclusion).orderBy("ord").collect()
        return {r.ord: r.decision for r in rows}, len(rows), "place" in calls

    # Every sheet short, in one share: only the places are matched as tables.
    few, number, matched = decided(500, 50_000)
    assert number == base.count() and not matched and len({str(d) for d in few.values()}) > 10
    # Both sheets long; one of them long; the hot one in shares.
    assert decided(3, 50_000) == (few, number, True)
    assert decided(25, 50_000) == (few, number, True)
    assert decided(500, 4) == (few, number, False)


def test_a_place_that_a_sheet_repeats_meets_it_once(spark):
    places = spark.createDataFrame([("a", "el paso, tx"), ("a", "tulsa")], "sheet_id string, location string")
    rules = spark.createDataFrame([("a", i, "El  Paso" if i % 2 else "el paso") for i in range(9, 0, -1)], "sheet_id string, ord bigint, value string")
    found = [tuple(r) for r in rule_tables.location_reasons(places, rules).collect()]
    assert found == [("a", "el paso, tx", "matched location 'El  Paso'")]


@pytest.mark.parametrize("near", [0, 9, 200_000])
def test_keywords_sent_to_the_texts_and_others_find_the_same(spark, monkeypatch, near):
    monkeypatch.setattr(rule_tables, "NEAR", near)
    rows, texts = _texts(spark, 80)
    rows += [(90, "KİT ſQL x1y 1"), (90, "kit 1 RN"), (91, "anrn rnx")]
    twice = spark.createDataFrame([*rows, *rows[:40], (None, "rn 1 a.b"), (None, "1 coding")], "ord bigint, text string")
    rules = spark.createDataFrame([(k,) for k in KEYWORDS], "keyword string")
    found = sorted((r.ord if r.ord is not None else -1, r.keyword) for r in rule_tables.keyword_hits(twice, rules).collect())
    keyed = {(i, k) for i, t in rows for k in set(KEYWORDS) - {None} if _occurs(t, k)}
    assert [x for x in found if x[0] >= 0] == sorted(keyed)
    assert [k for i, k in found if i < 0] == ["1", "Coding", "RN", "rn"]


def test_what_short_keywords_meet_is_not_shuffled(spark, monkeypatch):
    tables, staged = [], rule_tables.stage
    monkeypatch.setattr(rule_tables, "stage", lambda df, name: tables.append((name, staged(df, name))) or tables[-1][1])
    texts = spark.range(300).select(F.col("id").alias("ord"), F.format_string("No%05d x%dy", "id", "id").alias("text"))
    numbers = spark.range(300).select(F.col("id").cast("string").alias("keyword"))
    word = spark.createDataFrame([("no such word at all",)], "keyword string")
    found = sorted(map(tuple, rule_tables.keyword_hits(texts, numbers.unionByName(word)).collect()))
    assert found == sorted((i, str(k)) for i in range(300) for k in range(300) if str(k) in f"{i:05}" or _occurs(f"x{i}y", str(k)))
    assert not any(row._met for name, df in tables if name == "met-runs" for row in df.collect())
