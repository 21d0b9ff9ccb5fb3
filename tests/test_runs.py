import json

import pandas as pd
import pytest

from examples import EXCLUSION, INCLUSION, RESULTS_PAGE, posting
from jobloom import fixed_values as fv
from jobloom.operators.decide import PostingFilter
from jobloom.operators.validate import Dictionary
from jobloom.plans import across_runs
from jobloom.plans.coding_run import filter_and_code, postings_of_folder, run_coding
from jobloom.schemas import RECORD_FIELDS
from jobloom.sinks.writers import read_csv, write_csv
from jobloom.streaming.ingest import FirstSeen, code_new_pages, with_key

DICTIONARY = Dictionary(
    {name: "Date" if name == "collection_date" else "String" for name in RECORD_FIELDS},
    {"work_setting": ("Remote",)},
)


def demo_rows():
    places = [
        ("Chart Audit Specialist", "Shreveport, LA", "$61,000 - $72,500 a year", "1-3 years audit."),
        ("Coding Quality Director", "El Paso, TX", "$98,000", "CCS preferred."),
        ("Cancer Registrar", "Fayetteville, AR", "$58,250", "4 years experience preferred."),
        ("Data Governance Analyst", "Tupelo, MS", "$77,000", "SQL."),
        ("Home Based Coder", "Remote", "$31 - $39 an hour", "CPT."),
        ("Nurse Planner", "Lafayette, LA", "$83,000", "Ward planning."),
        ("Senior VP, Revenue", "Plano, TX", "$210,000", "Over 12 years."),
        ("HIM Data Steward", "Remote", "$52,000", "2+ years."),
    ]
    return [
        posting(job_title=t, location=p, salary=s, description=d, url=f"https://x/v?jk=run{i}")
        for i, (t, p, s, d) in enumerate(places, 1)
    ]


def test_whole_run(spark, make_postings, tmp_path):
    rows = demo_rows()
    df = make_postings(*rows[:3], rows[0], *rows[3:], posting(url=" ", description='a "b",\n c '))
    out = str(tmp_path / "out")
    counts = run_coding(df, INCLUSION, EXCLUSION, DICTIONARY, out, as_of="2026-08-03")
    assert counts == {"unique": 9, "included": 7, "issues": 1, "final": 6}
    final = read_csv(spark, f"{out}/jobs_csv")
    assert final.columns == list(RECORD_FIELDS)
    found = final.orderBy("record_id").collect()
    assert [r.record_id for r in found] == [f"IND000{i}" for i in range(1, 7)]
    assert found[5].job_title == "HIM Data Steward" and found[0].beebe_domain == ""
    stage = {r.ord: r.record_id for r in spark.read.parquet(f"{out}/records").collect()}
    assert list(sorted(stage.values()))[5:] == ["IND0008", "IND0009"]
    audit = read_csv(spark, f"{out}/filter_audit_trail")
    assert audit.count() == 9 and {r.included for r in audit.collect()} == {"True", "False"}
    issues = read_csv(spark, f"{out}/validation_issues").collect()
    assert [(r.record_id, r.field) for r in issues] == [("IND0009", "source_url")]
    lines = [
        json.loads(line)
        for part in sorted((tmp_path / "out" / "jobs_json").glob("part-*"))
        for line in part.read_text().splitlines()
    ]
    assert [line["record_id"] for line in lines] == [f"IND000{i}" for i in range(1, 7)]
    assert list(lines[0]) == list(RECORD_FIELDS)
    rules = spark.read.json(f"{out}/rules")
    assert rules.where("bucket = 'maximum_years'").first().num_value == 7


def test_issue_file_only_when_there_are_issues(make_postings, tmp_path):
    out = tmp_path / "out"
    df = make_postings(posting(collected_at="2026-08"))
    assert run_coding(df, INCLUSION, EXCLUSION, DICTIONARY, str(out))["issues"] == 0
    assert not (out / "validation_issues").exists()


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    text = ['  a "quoted", b\\"', "two\nlines", "", "é; ü ", "\\"]
    df = spark.createDataFrame([(i, t, i % 2 == 0) for i, t in enumerate(text)], "i int, t string, b boolean")
    write_csv(df, str(tmp_path / "csv"))
    rows = read_csv(spark, str(tmp_path / "csv")).orderBy("i").collect()
    assert [r.t for r in rows] == text
    assert [r.b for r in rows] == ["True", "False", "True", "False", "True"]


def test_folder_of_pages_to_records(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "louisiana__him.html").write_text(RESULTS_PAGE)
    (folder / "more.htm").write_text(RESULTS_PAGE)
    archive = str(tmp_path / "raw")
    df = postings_of_folder(spark, str(folder), locations=("Texas",), archive_folder=archive)
    assert [r.search_location for r in df.orderBy("ord").collect()] == ["louisiana"] * 2 + ["Texas"] * 2
    assert spark.read.parquet(archive).count() == 2
    coded = filter_and_code(df, PostingFilter(INCLUSION, EXCLUSION))
    assert [r.job_title for r in coded.collect()] == ["Records Integrity Lead"] * 2
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_default_search_words_and_order():
    assert fv.DEFAULT_SEARCH_KEYWORDS[0] == "Health Information Management"
    assert len(RECORD_FIELDS) == 32 and RECORD_FIELDS[-1] == "notes"


def test_pages_as_they_arrive(spark, tmp_path):
    pages, out = str(tmp_path / "pages"), str(tmp_path / "out")
    chain = PostingFilter(INCLUSION, EXCLUSION)
    scans = []

    def arrive(page_id, html):
        spark.createDataFrame([(page_id, "louisiana__him.html", html)], "page_id bigint, file_name string, html string").write.mode("append").parquet(pages)
        query = code_new_pages(spark, pages, out, chain, as_of="2026-08-03")
        query.awaitTermination()
        assert query.exception() is None
        state = query.lastProgress["stateOperators"][0]
        scans.append((state["numRowsTotal"], state["numRowsUpdated"]))
        # One page is read, whatever came before.
        assert query.lastProgress["numInputRows"] == 1

    arrive(1, RESULTS_PAGE)
    arrive(2, RESULTS_PAGE + RESULTS_PAGE.replace("k71f", "new789"))
    arrive(3, RESULTS_PAGE + RESULTS_PAGE.replace("k71f", "other5"))
    records = spark.read.parquet(f"{out}/records")
    assert sorted(r.source_url[-6:] for r in records.collect()) == ["k=k71f", "new789", "other5"]
    new = [after - before for (before, _), (after, _) in zip(scans, scans[1:])]
    assert new == [updated for _, updated in scans[1:]] and scans[0][0] == scans[0][1]


def test_first_seen_is_the_first_in_order(spark):
    rows = [("a", 5, "x"), ("a", 3, "y"), ("b", 9, "z"), ("a", 4, "x")]
    processor = FirstSeen(["posting_key", "ord", "title"])

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

    frame = pd.DataFrame(rows, columns=["posting_key", "ord", "title"])
    processor.seen = State()
    pieces = [frame[frame.posting_key == "a"].iloc[i : i + 1] for i in range(3)]
    [found] = processor.handleInputRows(("a",), iter(pieces), None)
    assert found.values.tolist() == [["a", 3, "y"]] and processor.seen.value == (3,)
    assert list(processor.handleInputRows(("a",), iter(pieces), None)) == []


def test_archive_is_not_shuffled(spark, make_postings, tmp_path):
    folder = str(tmp_path / "keys")
    archive = across_runs.open_archive(spark, folder, "keys_of_runs", 4)
    one = with_key(make_postings(posting(url="https://a/1"), posting(url="https://a/2")))
    across_runs.remember(across_runs.unseen(one, archive), archive, "r1")
    two = with_key(make_postings(posting(url="https://a/2"), posting(url="https://a/3")))
    fresh = across_runs.unseen(two, archive)
    assert [r.url for r in fresh.collect()] == ["https://a/3"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    sides = plan.split("SortMergeJoin")[1].split("Final Plan")[0]
    scan = sides.index("Bucketed: true")
    assert "Exchange" not in sides[sides.rindex("Sort [", 0, scan):scan]
    across_runs.remember(fresh, archive, "r2")
    # Another application, with an empty catalog, finds the same archive.
    spark.sql("DROP TABLE keys_of_runs")
    again = across_runs.open_archive(spark, folder, "keys_again", 4)
    assert spark.table(again).count() == 3 and across_runs.unseen(two, again).count() == 0


@pytest.mark.parametrize("folder", ["jobloom", "tests"])
def test_nothing_is_pinned_to_one_machine(folder):
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / folder
    word = "local" + "Checkpoint"
    assert not [p for p in root.rglob("*.py") if word in p.read_text()]
