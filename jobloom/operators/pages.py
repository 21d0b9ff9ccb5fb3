"""Result pages: quality, cards, details, and the postings they give."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.text import blank_to_null, strip
from jobloom.operators.dedupe import keep_first
from jobloom.operators.normalize import today
from jobloom.sources.card_parser import parse_cards, parse_detail

CARD_FIELDS = (
    "job_title", "company", "location", "salary", "description", "url", "posting_date",
    "job_key",
)
#: Pages of a batch that are Python objects at a time.
PAGES_AT_ONCE = 64
_CARD_TYPE = pa.struct([(name, pa.string()) for name in CARD_FIELDS] + [("repeated", pa.bool_())])
_PARSED_TYPE = pa.struct([("cards", pa.list_(_CARD_TYPE)), ("error", pa.string())])
_PARSED_DDL = (
    "struct<cards:array<struct<"
    + ",".join(f"{name}:string" for name in CARD_FIELDS)
    + ",repeated:boolean>>,error:string>"
)


def block_reason(
    html: Column,
    status: Column | None = None,
    site_name: str = fv.SITE_NAME,
    short_page_length: int = fv.SHORT_PAGE_LENGTH,
) -> Column:
    """Why a page holds no results, or null for a usable page. First reason wins.

    A page of status 200 below ``short_page_length`` characters must show a job.
    """

    def first_reason(lowered: Column) -> Column:
        reason = F
        if status is not None:
            for code in fv.BLOCK_STATUS_CODES:
                text = fv.BLOCKED_STATUS.format(status=code, site=site_name)
                reason = reason.when(status == code, text)
        reason = reason.when(lowered.isNull() | (strip(lowered) == ""), fv.BLOCKED_EMPTY)
        for marker in fv.BLOCK_MARKERS:
            reason = reason.when(
                F.contains(lowered, F.lit(marker)), fv.BLOCKED_MARKER.format(marker)
            )
        if status is not None:
            marked = F.lit(False)
            for marker in fv.JOB_MARKERS:
                marked = marked | F.contains(html, F.lit(marker))
            short = (status == 200) & (F.length(lowered) < short_page_length)
            reason = reason.when(short & ~marked, fv.BLOCKED_SHORT)
        return reason.otherwise(F.lit(None).cast("string"))

    # As the element of an array, the lower-cased page is made once for all tests.
    return F.get(F.transform(F.array(F.lower(html)), first_reason), F.lit(0))


def block_counts(pages: DataFrame, status: str | None = None) -> DataFrame:
    """Blocked pages per reason."""
    reason = block_reason(F.col("html"), F.col(status) if status else None)
    return (
        pages.select(reason.alias("block_reason"))
        .where(F.col("block_reason").isNotNull())
        .groupBy("block_reason")
        .agg(F.count(F.lit(1)).alias("pages"))
    )


def _parse_one(page: str, site_url: str) -> tuple[list[dict], str | None]:
    try:
        return parse_cards(page, site_url), None
    except (ValueError, AssertionError) as problem:
        return [], str(problem)


def _parse_some(html: pa.Array, site_url: str) -> pa.Array:
    read = [_parse_one(page or "", site_url) for page in html.to_pylist()]
    ends = accumulate((len(cards) for cards, _ in read), initial=0)
    cards = [card for of_page, _ in read for card in of_page]
    fields = [pa.array([card[field.name] for card in cards], field.type) for field in _CARD_TYPE]
    listed = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_CARD_TYPE))
    )
    errors = pa.array([error for _, error in read], pa.string())
    return pa.StructArray.from_arrays([listed, errors], fields=list(_PARSED_TYPE))


def _in_portions(html: pa.Array, read: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``read`` of some pages at a time, so that few are Python objects at once."""
    parts = [read(html.slice(at, PAGES_AT_ONCE)) for at in range(0, len(html), PAGES_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else read(html)


def read_cards(pages: DataFrame, site_url: str = fv.SITE_URL) -> DataFrame:
    """Every card of every usable page, with ``card_ord``; other columns are kept.

    ``pages`` has ``html``. Only that column goes to Python, in Arrow batches that Spark
    bounds by bytes; blocked pages never go.
    """

    @F.arrow_udf(_PARSED_DDL)
    def parsed(html: pa.Array) -> pa.Array:
        return _in_portions(html, lambda some: _parse_some(some, site_url))

    kept = [name for name in pages.columns if name != "html"]
    return (
        pages.where(block_reason(F.col("html")).isNull())
        .select(*kept, parsed("html").alias("_parsed"))
        .select(
            *kept,
            F.col("_parsed.error").alias("parse_error"),
            F.posexplode_outer("_parsed.cards").alias("card_ord", "_card"),
        )
        .select(*kept, "parse_error", "card_ord", "_card.*")
    )


def titled(cards: DataFrame) -> DataFrame:
    """Cards with a title; pages without any card fall away here too."""
    return cards.where(F.col("job_title") != "")


def first_of_page(cards: DataFrame) -> DataFrame:
    """Titled cards, the first of each job within its page, without a shuffle."""
    return titled(cards).where(~F.col("repeated")).drop("repeated")


def first_of_page_in_table(cards: DataFrame, page: str = "page_id") -> DataFrame:
    """The same for a table of cards read elsewhere."""
    key = F.coalesce(
        blank_to_null(F.col("job_key")), blank_to_null(F.col("url")), F.col("job_title")
    )
    return keep_first(titled(cards), F.struct(F.col(page), key), "card_ord")


def provenance(
    file_name: Column, default_keyword: str = "", default_location: str = ""
) -> tuple[Column, Column]:
    """Search keyword and location from ``<location>__<keyword>.html``."""
    stem = F.regexp_replace(file_name, r"(?s)(?<=.)\.[^.]*$", "")
    named = F.contains(stem, F.lit("__"))
    location, keyword = (
        blank_to_null(strip(F.translate(half, "_", " ")))
        for half in (
            F.substring_index(stem, "__", 1),
            F.regexp_extract(stem, "(?s)__(.*)$", 1),
        )
    )
    return (
        F.when(named, F.coalesce(keyword, F.lit(default_keyword))).otherwise(default_keyword),
        F.when(named, F.coalesce(location, F.lit(default_location))).otherwise(default_location),
    )


def with_details(cards: DataFrame, details: DataFrame, unique: tuple[str, ...]) -> DataFrame:
    """Replace the snippet by the detail page's text where there is any.

    ``details`` has ``url``, ``html`` and an ``ord`` that says which page of a url is
    first. ``unique`` names the columns that identify a card: cards without a url take
    no part, and are spread by them instead of meeting in one task.
    """
    texts = detail_texts(details).withColumnRenamed("url", "_link")
    apart = F.concat_ws("\u0000", F.lit(""), *[F.col(name).cast("string") for name in unique])
    link = F.when(F.col("url") != "", F.col("url")).otherwise(apart)
    return (
        cards.withColumn("_link", link)
        .join(texts, "_link", "left")
        .withColumn(
            "description",
            F.coalesce(blank_to_null(F.col("_detail")), F.col("description")),
        )
        .drop("_link", "_detail")
    )


def detail_texts(details: DataFrame) -> DataFrame:
    """``url`` and the description text of its first usable detail page."""

    @F.arrow_udf("string")
    def text(html: pa.Array) -> pa.Array:
        return _in_portions(
            html, lambda some: pa.array([parse_detail(page or "") for page in some.to_pylist()], pa.string())
        )

    usable = details.where((F.col("url") != "") & block_reason(F.col("html")).isNull())
    # Texts, not pages, go through the shuffle that finds the first page of a url.
    read = usable.select("url", text("html").alias("_detail"), "ord")
    return keep_first(read, F.col("url")).select("url", "_detail")


def cards_to_postings(
    cards: DataFrame, *, order: Column, as_of: str | None = None, platform: str = fv.SITE_NAME
) -> DataFrame:
    """Cards with ``search_keyword`` and ``search_location`` as postings.

    A card without a location takes the search location. The job key is not carried.
    """
    return cards.select(
        order.cast("bigint").alias("ord"),
        "job_title",
        "company",
        F.coalesce(blank_to_null(F.col("location")), F.col("search_location")).alias("location"),
        "salary",
        "description",
        "url",
        "posting_date",
        F.lit(platform).alias("source_platform"),
        "search_keyword",
        "search_location",
        (F.lit(as_of) if as_of else today()).alias("collected_at"),
    )
