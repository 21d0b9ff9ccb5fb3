"""Posting-shaped views over the driver's tables, as one SQL text for both engines.

Table names stand in braces: Spark fills in frames, the oracle the bare names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobloom.session import spread

POSTINGS_SQL = """
SELECT o_orderkey AS ord,
  CASE o_orderkey % 8
    WHEN 0 THEN 'Records Integrity Lead' WHEN 1 THEN 'Chart Audit Specialist'
    WHEN 2 THEN 'Coding Quality Director'   WHEN 3 THEN ' Home Based  Coder '
    WHEN 4 THEN 'Staff Nurse Planner' WHEN 5 THEN 'Senior VP, Revenue'
    WHEN 6 THEN 'RN-2 Reviewer' ELSE 'HIM Data Steward' END AS job_title,
  c_name AS company,
  CASE c_nationkey % 9
    WHEN 0 THEN 'Shreveport, LA' WHEN 1 THEN 'El Paso, TX' WHEN 2 THEN 'Fayetteville, AR'
    WHEN 3 THEN 'Tupelo, MS' WHEN 4 THEN 'Remote' WHEN 5 THEN 'Tacoma, WA'
    WHEN 6 THEN 'Lafayette, Louisiana' WHEN 7 THEN '' ELSE 'La Mesa, CA' END AS location,
  CASE o_orderkey % 5
    WHEN 0 THEN concat('$', CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), ' a year')
    WHEN 1 THEN '$28 - $35 an hour' WHEN 2 THEN ''
    WHEN 3 THEN concat('$', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',000 - $', CAST(CAST(floor(o_totalprice / 900) AS BIGINT) AS STRING), ',500.75 a year')
    ELSE '$90/hr' END AS salary,
  concat(
    CASE o_orderkey % 3 WHEN 0 THEN 'Manage HIM operations with SQL and Power BI. '
      WHEN 1 THEN 'Hybrid full-time role; maintain EHR and HIPAA compliance. '
      ELSE 'On-site contract work, communication and leadership. ' END,
    CASE o_custkey % 4 WHEN 0 THEN 'Requirements: RHIA or rhit, Bachelor''s degree. '
      WHEN 1 THEN 'Preferred: CCS, CPC and Master''s degree. '
      WHEN 2 THEN 'Nice to have cloud, FHIR. Minimum qualifications - CHDA. ' ELSE '' END,
    CASE o_orderkey % 7 WHEN 0 THEN 'Over 10 years experience required.'
      WHEN 1 THEN '2-4 years coding. At least 3 years HIM.' WHEN 2 THEN 'Minimum of 7 years.'
      WHEN 3 THEN 'RHIA preferred. 5+ yrs.' ELSE 'Sign-on bonus $5,000.' END) AS description,
  CASE WHEN o_orderkey % 10 = 0 THEN ''
    WHEN o_orderkey % 10 = 1 THEN concat('https://Jobs.example.com/p/', CAST(o_custkey AS STRING), '#top')
    ELSE concat('https://jobs.example.com/viewjob?jk=d', CAST(o_custkey AS STRING), 'x', CAST(o_orderkey % 7 AS STRING),
      CASE WHEN o_orderkey % 3 = 0 THEN '&from=search' ELSE '' END) END AS url,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Demo dataset' ELSE '3 days ago' END AS posting_date,
  CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'BoardA' END AS source_platform,
  'Health Informatics' AS search_keyword,
  CASE WHEN c_nationkey % 2 = 0 THEN 'Texas' ELSE '' END AS search_location,
  CASE o_orderkey % 6 WHEN 0 THEN '2026-08' WHEN 1 THEN '08/03/2026' ELSE '2026-08-03' END AS collected_at
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Postings, and every document as the description of one more.
TEXTS_SQL = """
SELECT ord, job_title, location, salary, description FROM {postings}
UNION ALL
SELECT -1 - doc_id AS ord, '' AS job_title, '' AS location, '' AS salary, coalesce(text, '') AS description
FROM {documents}
"""

CARDS_HTML_SQL = """
SELECT ord, CAST(floor(ord / 10) AS BIGINT) AS page_id,
  concat('<div class="', CASE WHEN CAST(floor(ord / 10) AS BIGINT) % 12 = 4 THEN 'x' ELSE 'job_seen_beacon' END,
    '" data-jk="k', CAST(ord - ord % 2 AS STRING), '"><h2 class="jobTitle"><a href="/viewjob?jk=k', CAST(ord - ord % 2 AS STRING), '">',
    CASE WHEN ord % 9 = 8 THEN '' ELSE job_title END, '</a></h2><span class="companyName">', company,
    '</span><div data-testid="text-location">', location, '</div><div class="salary-snippet-container">', salary,
    '</div><span class="date">', posting_date, '</span><div class="job-snippet">', description, '</div></div>') AS card
FROM {postings}
"""

# A page holds ten cards at most, so the lists are bounded.
PAGE_BODIES_SQL = """
SELECT page_id, array_join(transform(array_sort(collect_list(struct(ord, card))), x -> x.card), '') AS body
FROM {cards_html} GROUP BY page_id
"""

RESULT_PAGES_SQL = """
SELECT page_id,
  CASE WHEN page_id % 12 = 3 THEN 403 ELSE 200 END AS status_code,
  concat(CASE page_id % 3 WHEN 0 THEN 'louisiana__health_informatics' WHEN 1 THEN '__rhia' ELSE 'results' END,
    CASE WHEN page_id % 5 = 0 THEN '.htm' ELSE '.html' END) AS file_name,
  CASE page_id % 12 WHEN 0 THEN '<html><body>Please verify you are a human</body></html>'
    WHEN 1 THEN '  ' WHEN 2 THEN '<html><body>No results</body></html>'
    ELSE concat('<html><body>', body, '</body></html>') END AS html
FROM {page_bodies}
"""

DETAIL_PAGES_SQL = """
SELECT ord, concat('https://www.indeed.com/viewjob?jk=k', CAST(ord - ord % 2 AS STRING)) AS url,
  concat('<div id="jobDescriptionText">Full text. ', description, '</div>') AS html
FROM {postings} WHERE ord % 4 < 2
"""

# Sheets over customers and their orders. A third of all rows is in one sheet.
_SHEET_ID = "CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE concat('s', CAST(o_custkey AS STRING)) END"

INCLUSION_SHEETS_SQL = f"""
SELECT {_SHEET_ID} AS sheet_id, o_orderkey AS ord,
  CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 29 = 5 THEN 'Variable Name'
    WHEN o_orderkey % 3 <> 0 AND o_orderkey % 31 = 5 THEN 'Created from uploaded sheets'
    ELSE CASE o_orderkey % 13 WHEN 0 THEN 'Location' WHEN 1 THEN '' WHEN 2 THEN ' Keywords '
      WHEN 3 THEN 'TITLE' WHEN 4 THEN 'Description Keyword' WHEN 5 THEN 'Texas'
      ELSE concat(o_orderpriority, ' ') END END AS c0
FROM {{orders}}
"""

EXCLUSION_SHEETS_SQL = f"""
SELECT {_SHEET_ID} AS sheet_id, o_orderkey AS ord,
  CASE o_orderkey % 11 WHEN 0 THEN ' RN ' WHEN 1 THEN ''
    WHEN 2 THEN concat('Over ', CAST(o_custkey % 20 AS STRING), ' years experience required')
    WHEN 3 THEN concat('Salary over $', CAST(o_custkey % 200 AS STRING), ',000 annually')
    WHEN 4 THEN 'Senior' WHEN 5 THEN 'Senior Manager' WHEN 6 THEN 'must hold active clearance'
    WHEN 7 THEN 'Career level: Expert' WHEN 8 THEN concat('> ', CAST(o_custkey % 9 AS STRING), ' years')
    WHEN 9 THEN o_orderpriority ELSE 'more than 3 years' END AS c0
FROM {{orders}}
"""

DICTIONARY_SHEETS_SQL = f"""
SELECT {_SHEET_ID} AS sheet_id, o_orderkey AS ord,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'Variable Name' WHEN 2 THEN ''
    ELSE concat('field_', CAST(o_orderkey % 17 AS STRING)) END AS c0,
  CASE o_orderkey % 5 WHEN 1 THEN CASE o_custkey % 2 WHEN 0 THEN 'Data Type' ELSE 'Allowed Values / Examples' END
    WHEN 2 THEN 'note' ELSE concat('Date; ', o_orderstatus) END AS c1,
  CASE o_orderkey % 5 WHEN 1 THEN CASE o_custkey % 2 WHEN 0 THEN ' allowed values ' ELSE 'DATA TYPE' END
    ELSE CASE WHEN o_orderkey % 7 < 2 THEN ' ; ' ELSE concat(o_orderpriority, ' ;', o_orderstatus, '; ') END END AS c2,
  CASE o_orderkey % 5 WHEN 1 THEN 'Label' ELSE o_orderpriority END AS c3
FROM {{orders}}
"""


# Postings whose rules are those of their company. A third of all names one company's sheet.
OWN_SHEETS_SQL = """
SELECT *, CASE WHEN ord % 3 = 0 THEN 'Customer#000000001' ELSE company END AS sheet_id FROM {postings}
"""

_LINES = "(VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) AS lines(i)"

OWN_INCLUSION_SQL = f"""
SELECT c_name AS sheet_id, c_custkey * 10 + i AS ord,
  CASE i WHEN 0 THEN CASE WHEN c_custkey % 7 = 3 THEN '' ELSE 'Locations' END
    WHEN 1 THEN CASE c_custkey % 4 WHEN 0 THEN 'Louisiana' WHEN 1 THEN 'Texas' WHEN 2 THEN 'Remote' ELSE ' El  Paso' END
    WHEN 2 THEN CASE c_custkey % 3 WHEN 0 THEN 'Arkansas' WHEN 1 THEN 'LA' ELSE 'Mississippi' END
    WHEN 3 THEN CASE WHEN c_custkey % 11 = 5 THEN '' ELSE 'Title Keywords' END
    WHEN 4 THEN CASE c_custkey % 5 WHEN 0 THEN 'Coding' WHEN 1 THEN 'him' WHEN 2 THEN 'Nurse' WHEN 3 THEN 'rn' ELSE 'Lead' END
    WHEN 5 THEN CASE c_custkey % 2 WHEN 0 THEN 'Chart Audit' ELSE 'STEWARD' END
    WHEN 6 THEN CASE WHEN c_custkey % 5 = 2 THEN '' ELSE 'Keywords' END
    WHEN 7 THEN CASE c_custkey % 3 WHEN 0 THEN 'FHIR' WHEN 1 THEN 'sql' ELSE 'role; maintain' END
    WHEN 8 THEN 'Description Keyword' ELSE CASE c_custkey % 2 WHEN 0 THEN 'HIPAA' ELSE 'BI' END END AS c0
FROM {{customer}} CROSS JOIN {_LINES}
"""

OWN_EXCLUSION_SQL = f"""
SELECT c_name AS sheet_id, c_custkey * 10 + i AS ord,
  CASE i WHEN 0 THEN concat('Surgeon ', CAST(c_custkey AS STRING)) WHEN 1 THEN CASE c_custkey % 3 WHEN 0 THEN 'RN' WHEN 1 THEN 'Planner' ELSE 'rn-2' END
    WHEN 2 THEN CASE WHEN c_custkey % 2 = 0 THEN concat('Over ', CAST(c_custkey % 9 AS STRING), ' years experience required') ELSE '' END
    WHEN 3 THEN CASE WHEN c_custkey % 5 < 2 THEN concat('Salary over $', CAST(40 + c_custkey % 200 AS STRING), ',000 annually') ELSE '' END
    WHEN 4 THEN CASE WHEN c_custkey % 4 = 1 THEN 'Senior' ELSE 'Vice President' END
    WHEN 5 THEN CASE WHEN c_custkey % 6 = 1 THEN 'contract work, communication' ELSE 'must hold active clearance' END
    WHEN 6 THEN concat('Wing ', CAST(c_custkey AS STRING)) ELSE '' END AS c0
FROM {{customer}} CROSS JOIN {_LINES}
"""

# Companies by name, parts as pieces of job keys, and numbers that must stand apart.
KEYWORDS_SQL = """
SELECT c_name AS keyword FROM {customer}
UNION ALL SELECT concat('D', CAST(p_partkey AS STRING), 'X') AS keyword FROM {part}
UNION ALL SELECT CAST(s_suppkey AS STRING) AS keyword FROM {supplier}
UNION ALL SELECT concat('  ', p_name, ' ') AS keyword FROM {part}
"""

# Places, most of which nothing matches, in order.
PLACES_SQL = """
SELECT c_custkey AS ord, CASE c_custkey % 1000 WHEN 7 THEN 'Louisiana' WHEN 8 THEN 'Texas' WHEN 9 THEN 'remote'
  WHEN 11 THEN 'Mesa' ELSE concat('Parish ', CAST(c_custkey AS STRING)) END AS value FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )
    return spark.sql(
        POSTINGS_SQL,
        orders=spread(orders, "o_orderkey"),
        customer=table(spark, sf_dir, "customer"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return spark.sql(TEXTS_SQL, postings=postings(spark, sf_dir), documents=documents)


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = spark.sql(CARDS_HTML_SQL, postings=postings(spark, sf_dir))
    bodies = spark.sql(PAGE_BODIES_SQL, cards_html=cards)
    return spark.sql(RESULT_PAGES_SQL, page_bodies=bodies)


def own_sheets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings that name their sheet, and the two kinds of sheets."""
    # Ten lines come of each customer, so a file of one split is dealt out first.
    customer = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")
    return (
        spark.sql(OWN_SHEETS_SQL, postings=postings(spark, sf_dir)),
        spark.sql(OWN_INCLUSION_SQL, customer=customer), spark.sql(OWN_EXCLUSION_SQL, customer=customer),
    )


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("customer", "part", "supplier")
    return spark.sql(KEYWORDS_SQL, **{n: table(spark, sf_dir, n) for n in names})


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DETAIL_PAGES_SQL, postings=postings(spark, sf_dir))


def sheets(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, orders=table(spark, sf_dir, "orders"))
