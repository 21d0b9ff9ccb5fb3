"""The search pages to visit: every keyword at every location, page by page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.text import form_encoded, slug


def search_frontier(
    keywords: DataFrame,
    locations: Sequence[str],
    max_pages: int,
    *,
    site_url: str = fv.SITE_URL,
) -> DataFrame:
    """One row per keyword row (``keyword``), location of the rule sheet, and page."""
    if max_pages <= 0 or not locations:
        places, starts = F.array().cast("array<string>"), F.array().cast("array<int>")
    else:
        places = F.array(*[F.lit(place) for place in locations])
        starts = F.sequence(
            F.lit(0), F.lit((max_pages - 1) * fv.PAGE_STEP), F.lit(fv.PAGE_STEP)
        )
    address = fv.SEARCH_URL.format(
        site=site_url.replace("%", "%%"), keyword="%s", location="%s", start="%d"
    )
    visits = (
        keywords.select("keyword", F.explode(places).alias("location"))
        .select("*", F.explode(starts).alias("start"))
    )
    return visits.select(
        "keyword",
        "location",
        "start",
        F.format_string(
            address, form_encoded(F.col("keyword")), form_encoded(F.col("location")), "start"
        ).alias("url"),
        slug(F.col("keyword")).alias("keyword_slug"),
        slug(F.col("location")).alias("location_slug"),
    )
