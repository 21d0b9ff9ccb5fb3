import pytest

from jobloom.sources import sheets
from jobloom.sources.plugins import or_fallback, union_sources


@pytest.fixture()
def sheet(spark, tmp_path):
    def write(text):
        path = tmp_path / "sheet.csv"
        path.write_bytes(text.encode())
        return sheets.read_sheet(spark, str(path))

    return write


INCLUSION = (
    "stray,,\r\nLocation,,\r\n Texas ,,\r\nRemote,,\r\n,x,\r\nlost,,\r\n\r\nKeywords,,\r\nhim,,\r\nhim,,\r\n"
    "TITLE,,\r\ncoder,,\r\nDescription Keywords,,\r\n\"a, b\",,\r\n"
    "\"Created from uploaded, x\",,\r\nLocation,,\r\nOhio,,\r\n"
)


def test_inclusion_sheet(sheet):
    rules = sheets.load_inclusion_rules(sheet(INCLUSION))
    assert rules.locations == ("Texas", "Remote")
    assert rules.keywords == ("him", "him")
    assert rules.title_keywords == ("coder",)
    assert rules.description_keywords == ("a, b",)
    assert rules.other_rules == ("stray", "lost")


def test_exclusion_sheet(sheet):
    rules = sheets.load_exclusion_rules(
        sheet(
            "Nursing\nVP\nOver 7 years experience required\n\"Salary over $150,000 annually\"\n"
            "Senior\nRN\nRN\nSenior Manager\nmust hold active clearance\nCareer level: Expert\n"
            "> 12 years\n\"salary over 90,000\"\nmore than 3 years\n\"salary over ,\"\n"
        )
    )
    assert rules.title_keywords == ("Nursing", "RN", "Senior Manager")
    assert rules.career_level_keywords == ("VP", "Senior", "Career level: Expert")
    assert rules.description_keywords == ("must hold active clearance",)
    assert (rules.maximum_years, rules.maximum_annual) == (3, 90000)
    assert len(rules.raw_rules) == 14 and rules.raw_rules[0] == "Nursing"


def test_dictionary_sheet(sheet):
    dictionary = sheets.load_dictionary(
        sheet(
            "A title,,,,\nearly,String,a,,\nVariable Name,Data Type,Allowed Values / Examples,Other,Label\n"
            "job_title,String,Coder; ;Auditor,skip,Job\n,String,lost,,\nVariable Name,Data Type,x,,\n"
            "seen,Date,2026-01; 2026,,Seen\njob_title,Long Text,;,,Job again\n"
        )
    )
    assert dictionary.data_types == {"job_title": "Long Text", "seen": "Date"}
    assert dictionary.allowed_values == {
        "job_title": ("Coder", "Auditor"), "seen": ("2026-01", "2026"),
    }
    assert {name: said["label"] for name, said in dictionary.descriptions.items()} == {
        "job_title": "Job again", "seen": "Seen",
    }


def test_dictionary_without_header_is_an_error(sheet):
    with pytest.raises(ValueError, match="Variable Name"):
        sheets.load_dictionary(sheet("a,b\nc,d\n"))


def test_rules_to_run_with_are_counted_before_they_are_collected(sheet, monkeypatch):
    monkeypatch.setattr(sheets, "MAX_SHEET_RULES", 2)
    with pytest.raises(ValueError, match="2 rules"):
        sheets.load_exclusion_rules(sheet("a\nb\nc\n"))


def test_sources_are_put_one_after_the_other(spark):
    first = lambda s: s.createDataFrame([(9, "a")], "ord bigint, job_title string")
    second = lambda s: s.createDataFrame([(1, "b", "x")], "ord bigint, company string, lang string")
    rows = union_sources(spark, [first, second]).orderBy("ord").collect()
    assert [(r.job_title, r.company, r.extras) for r in rows] == [("a", "", {}), ("", "b", {"lang": "x"})]
    bad = lambda s: s.createDataFrame([(-1, "a")], "ord bigint, job_title string")
    with pytest.raises(Exception, match="out of range"):
        union_sources(spark, [bad]).collect()


def test_fallback_source(spark):
    some = spark.range(2)
    assert or_fallback(some.limit(0), some) is some
    assert or_fallback(some, some.limit(0)) is some
