import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from examples import RESULTS_PAGE
from jobloom.operators import pages
from jobloom.sources import card_parser
from jobloom.sources.card_parser import parse_cards, parse_detail
from jobloom.sources.frontier import search_frontier
from jobloom.sources.saved_pages import SavedPages, page_postings, scan_saved_pages


def reason(spark, html, status=None):
    df = spark.createDataFrame([(html, status)], "html string, status int")
    with_status = F.col("status") if status is not None else None
    return df.select(pages.block_reason(F.col("html"), with_status).alias("r")).first().r


def test_block_reasons_in_order(spark):
    blocked = "<html>Permission Denied. Please verify you are a human.</html>"
    assert reason(spark, blocked, 403) == "HTTP 403 from Indeed (likely anti-bot / rate limit)"
    assert reason(spark, blocked) == "anti-bot challenge detected (permission denied)"
    assert reason(spark, " \n ") == reason(spark, None, 200) == "empty response body"
    assert reason(spark, "<p>CAPTCHA akamai</p>") == "anti-bot challenge detected (captcha)"
    short = "suspiciously short non-results page (possible soft block)"
    assert reason(spark, "<p>none</p>", 200) == short
    assert reason(spark, "<p class=jobtitle>none</p>", 200) == short
    assert reason(spark, "<p class=jobTitle>none</p>", 200) is None
    assert reason(spark, "<p>none</p>", 500) is None and reason(spark, "<p>none</p>") is None
    assert reason(spark, "x" * 1500, 200) is None
    assert reason(spark, RESULTS_PAGE, 200) is None


def test_card_fields():
    first, second, inner, untitled = parse_cards(RESULTS_PAGE)
    assert first == {
        "job_title": "Records Integrity Lead",
        "company": "Reed & Sons Imaging",
        "location": "Shreveport, LA",
        "salary": "$66,000 - $81,000 a year",
        "description": "First point",
        "url": "https://www.indeed.com/viewjob?jk=k71f",
        "posting_date": "",
        "job_key": "k71f",
        "repeated": False,
    }
    assert second["job_title"] == "Charge Nurse"
    assert second["url"] == "https://other.example/x?a=1&jk=m82g"
    assert second["description"] == "RN license required."
    assert (second["location"], second["salary"]) == ("Lafayette, LA", "")
    # The block inside the second card counts as a card too, and repeats its job.
    assert (inner["job_key"], inner["repeated"], inner["company"]) == ("m82g", True, "")
    assert (untitled["job_title"], untitled["url"]) == ("", "https://www.indeed.com/viewjob?jk=none")


def test_fallback_cards():
    page = '<div data-jk="a1"><a data-jk="a1" href="/x">Coder</a></div><a data-jk="b2">Auditor</a>'
    cards = parse_cards(page)
    assert [(c["job_title"], c["job_key"]) for c in cards] == [("Coder", "a1"), ("", "a1"), ("", "b2")]


def test_title_is_the_first_match_in_document_order():
    page = (
        '<div class="job_seen_beacon"><h2 class="jobTitle"><a href="/x"><span title="Long title">'
        "Short</span></a></h2></div>"
    )
    assert parse_cards(page)[0]["job_title"] == "Short"


def test_odd_markup():
    assert parse_cards("") == []
    page = "<div class='job_seen_beacon'><h2><span title=''>T &lt;1&gt; < 2</span><p>x"
    [card] = parse_cards(page)
    assert (card["job_title"], card["job_key"], card["url"]) == ("T <1> < 2", "", "")
    page = '<div class="resultContent x"><a class="jcs-JobTitle y" href="?jk=Q1&b">One<br>Two</a></div>'
    [card] = parse_cards(page)
    assert (card["job_title"], card["job_key"]) == ("One Two", "Q1")


def test_detail_text():
    page = "<p>x</p><div id='a-jobDescription-b'> One <ul><li>Two<li> Three </ul></div><p>y"
    assert parse_detail(page) == "One\nTwo\nThree"
    assert parse_detail("<p>none</p>") == ""


def test_cards_table(spark):
    df = spark.createDataFrame(
        [(1, RESULTS_PAGE), (2, "captcha" + RESULTS_PAGE), (3, "<p>no cards</p>")],
        "page_id bigint, html string",
    )
    cards = pages.read_cards(df)
    assert cards.count() == 5  # four cards, and the page without any
    first = pages.first_of_page(cards)
    assert [r.job_key for r in first.orderBy("card_ord").collect()] == ["k71f", "m82g"]
    table = pages.first_of_page_in_table(cards.drop("repeated"))
    assert sorted(table.select(first.columns).collect()) == sorted(first.collect())
    assert cards.where("parse_error is not null").count() == 0


def test_details_replace_snippets(spark):
    cards = spark.createDataFrame(
        [(1, 0, "u1", "s1"), (1, 1, "u2", "s2"), (2, 0, "", "s3"), (2, 1, "u1", "s4"), (3, 0, "u3", "s5")],
        "page_id bigint, card_ord int, url string, description string",
    )
    text = "<div id='jobDescriptionText'>%s</div>"
    details = spark.createDataFrame(
        [
            (5, "u1", text % "later"), (4, "u1", text % "first"), (1, "u2", text % " "),
            (2, "", text % "nobody"), (3, "u3", "Access denied " + text % "blocked"),
        ],
        "ord bigint, url string, html string",
    )
    out = pages.with_details(cards, details, ("page_id", "card_ord"))
    rows = out.orderBy("page_id", "card_ord").collect()
    assert [r.description for r in rows] == ["first", "s2", "s3", "first", "s5"]
    assert out.columns == cards.columns


@pytest.mark.parametrize(
    "name, keyword, location",
    [
        ("louisiana__health_information_management.html", "health information management", "louisiana"),
        ("__rhia.htm", "rhia", "TX"),
        ("a___b.c.html", "b.c", "a"),
        ("results.html", "HIM", "TX"),
        ("x__.html", "HIM", "x"),
    ],
)
def test_provenance(spark, name, keyword, location):
    df = spark.createDataFrame([(name,)], "f string")
    k, p = pages.provenance(F.col("f"), "HIM", "TX")
    assert tuple(df.select(k.alias("k"), p.alias("p")).first()) == (keyword, location)


def test_saved_pages(spark, tmp_path):
    (tmp_path / "b.htm").write_text("<p>b</p>")
    (tmp_path / "louisiana__him.html").write_bytes(RESULTS_PAGE.encode() + b"\xff\xfe\r\n")
    (tmp_path / "_first.html").write_text("<p>under</p>")
    (tmp_path / "notes.txt").write_text("no page")
    rows = scan_saved_pages(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [(r.page_id, r.file_name) for r in rows] == [
        (0, "_first.html"), (1, "louisiana__him.html"), (2, "b.htm"),
    ]
    assert rows[1].html == RESULTS_PAGE + "\n"
    found = page_postings(scan_saved_pages(spark, str(tmp_path)), as_of="2026-01-01")
    found = found.orderBy("ord").collect()
    assert [(r.job_title, r.search_location, r.search_keyword) for r in found] == [
        ("Records Integrity Lead", "louisiana", "him"), ("Charge Nurse", "louisiana", "him"),
    ]


def test_saved_pages_folder_missing_or_empty(spark, tmp_path):
    assert scan_saved_pages(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="missing"):
        scan_saved_pages(spark, str(tmp_path / "missing")).count()


def test_saved_pages_are_split_by_size(tmp_path, monkeypatch):
    for i in range(5):
        (tmp_path / f"p{i}.html").write_text("x" * 10)
    monkeypatch.setattr("jobloom.sources.saved_pages.PARTITION_BYTES", 25)
    parts = SavedPages({"path": f"file://{tmp_path}"}).reader(None).partitions()
    assert [(p.first, len(p.paths)) for p in parts] == [(0, 2), (2, 2), (4, 1)]


def test_frontier(spark):
    keywords = spark.createDataFrame([("a&b",), ("RHIA",)], "keyword string")
    rows = search_frontier(keywords, ["New Orleans"], 2, site_url="https://x").orderBy("keyword", "start").collect()
    assert [r.url for r in rows] == [
        "https://x/jobs?q=RHIA&l=New+Orleans&start=0",
        "https://x/jobs?q=RHIA&l=New+Orleans&start=10",
        "https://x/jobs?q=a%26b&l=New+Orleans&start=0",
        "https://x/jobs?q=a%26b&l=New+Orleans&start=10",
    ]
    assert search_frontier(keywords, ["x"], 0).count() == search_frontier(keywords, [], 1).count() == 0


def test_a_hot_url_is_split_between_tasks(spark):
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 20000, 1, 8)
        url = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "").otherwise(
            F.concat(F.lit("u"), F.col("id").cast("string"))
        )
        cards = ids.select(
            F.col("id").alias("page_id"), F.lit(0).alias("card_ord"), url.alias("url"),
            F.sha2(F.col("id").cast("string"), 256).alias("description"),
        )
        detail = F.lit("<div id='jobDescriptionText'>full</div>")
        details = ids.select(F.col("id").alias("ord"), url.alias("url"), detail.alias("html"))
        out = pages.with_details(cards, details, ("page_id", "card_ord"))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert len(rows) == 20000
        assert sum(r.description == "full" for r in rows) == sum(r.url != "" for r in rows)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_plain_markup_is_read_as_the_standard_parser_reads_it(monkeypatch):
    pieces = [
        '<div class="job_seen_beacon" data-jk="a1">', "</div>", '<h2 class="jobTitle">', "</h2>", '<span title="T &amp; x">', "</span>",
        '<a href="/v?jk=b2" data-jk="b2">', "<A HREF='/q?'>", "</a >", "text ", "&am", "p; ", "<br/>", "<li>", "<ul>", "</ul>", "<!-- c -->",
        "<!--", "-->", "<script>", 'x="<div>";', "</script>", '<span class="companyName" class="x">', "<", ">", '"', "<div class=job-snippet>",
        '<div data-jk="q>r" href="a<b">', "<?pi>", "</>", "<é>", '<div\n class="companyLocation">', "<a data-jk>", "plain words " * 20,
    ]
    rng = random.Random(9)
    made = ["".join(rng.choices(pieces, k=rng.randint(1, 25))) for _ in range(3_000)]
    read = [(card_parser.parse_cards(page), card_parser.parse_detail(page)) for page in made]
    monkeypatch.setattr(card_parser, "_PLAIN", re.compile(r"(?!)"))
    monkeypatch.setattr(card_parser, "_PORTION", 1 << 30)
    assert read == [(card_parser.parse_cards(page), card_parser.parse_detail(page)) for page in made]
    assert sum(len(cards) for cards, _ in read) > 1_000


def test_plain_pages_do_not_reach_the_standard_parser(monkeypatch):
    page = "<html><body>" + '<div class="job_seen_beacon" data-jk="k1"><h2 class="jobTitle"><a href="/j?jk=k1">Coder</a></h2></div>' * 3
    monkeypatch.setattr(card_parser._FieldReader, "feed", lambda *_: pytest.fail("not plain"))
    assert [c["url"] for c in card_parser.parse_cards(page)] == ["https://www.indeed.com/j?jk=k1"] * 3


def test_pages_are_read_some_at_a_time():
    seen = []

    def read(some):
        seen.append(len(some))
        return pages._parse_some(some, "https://x.example")

    html = pa.array(['<div class="job_seen_beacon"><h2 class="jobTitle"><a>A</a></h2></div>', None, ""] * 100)
    found = pages._in_portions(html, read).to_pylist()
    assert max(seen) == pages.PAGES_AT_ONCE and sum(seen) == 300
    assert [len(row["cards"]) for row in found] == [1, 0, 0] * 100 and found[0]["cards"][0]["job_title"] == "A"
    assert pages._in_portions(html.slice(0, 0), read).to_pylist() == []
