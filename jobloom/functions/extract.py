"""Numbers, labels and phrases taken out of posting text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.text import (
    WS,
    ascii_digits,
    blank_to_null,
    java_pattern,
    must_contain,
    strip,
)

# Numbers are read as doubles so that none overflows, then held at the BIGINT end.
_LARGEST = 9.2e18
# Stand for "no number" next to the numbers found, which are never negative. They keep
# the arrays from being empty, since casting a blank token costs an exception per row.
NO_YEARS = -1.0
NO_AMOUNT = 1e300


def _all_matches(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(group))


def _to_doubles(none: float, tokens: Column) -> Column:
    """Digit tokens as numbers, after ``none``; null where a token has no digit."""
    joined = F.array_join(F.concat(F.array(F.lit(str(none))), tokens), " ")
    plain = F.replace(ascii_digits(joined), F.lit(","), F.lit(""))
    return F.split(plain, " ").try_cast("array<double>")


def whole(number: Column) -> Column:
    return F.least(F.floor(number).cast("double"), F.lit(_LARGEST)).cast("bigint")


def years_mentioned(text: Column) -> Column:
    """Every number of years that any of the patterns finds, pattern by pattern."""
    tokens = F.concat(*[_all_matches(text, p, 1) for p in fv.YEARS_PATTERNS])
    return F.transform(F.filter(_to_doubles(NO_YEARS, tokens), lambda n: n >= 0), whole)


def most_years(text: Column) -> Column:
    """The largest number of years mentioned, or ``NO_YEARS``.

    The first pattern finds each number that the others find.
    """
    return F.array_max(_to_doubles(NO_YEARS, _all_matches(text, fv.YEARS_PATTERNS[0], 1)))


def _hourly(text: Column) -> Column:
    lowered = F.lower(text)
    return reduce(or_, [F.contains(lowered, F.lit(word)) for word in fv.HOURLY_WORDS])


def _per_year(amounts: Column) -> Column:
    return F.transform(
        amounts,
        lambda n: F.when(n < fv.HOURLY_LIMIT, n * fv.HOURS_PER_YEAR).otherwise(n),
    )


def annual_amounts(text: Column) -> Column:
    """Every pay amount in the text per year, cut to a whole number.

    Small amounts count as hourly when the text speaks of hours anywhere. A token
    of commas alone is no amount.
    """
    found = _to_doubles(NO_AMOUNT, _all_matches(text, fv.MONEY_PATTERN, 1))
    amounts = F.filter(found, lambda n: n < NO_AMOUNT)
    return F.transform(F.when(_hourly(text), _per_year(amounts)).otherwise(amounts), whole)


def least_annual_amount(text: Column) -> Column:
    """The smallest of the annual amounts, not yet cut, or ``NO_AMOUNT``."""
    found = _to_doubles(NO_AMOUNT, _all_matches(text, fv.MONEY_PATTERN, 1))
    return F.array_min(F.when(_hourly(text), _per_year(found)).otherwise(found))


def first_label(
    text: Column, labels: Sequence[tuple[str, str]], lowered: Sequence[Column]
) -> Column:
    """The label of the first pattern, in list order, that occurs in the text.

    ``lowered`` are the parts of the text in lower case. A plain search in them for a
    piece of the pattern spares the pattern for most rows.
    """
    chain = F
    for pattern, label in labels:
        pieces = [F.contains(part, F.lit(p)) for p in must_contain(pattern) for part in lowered]
        found = F.regexp_like(text, F.lit(java_pattern(pattern)))
        chain = chain.when(reduce(or_, pieces) & found, label)
    return chain.otherwise(fv.NOT_SPECIFIED)


def work_setting(location: Column, description: Column, lowered: Column) -> Column:
    text = F.concat_ws(" ", location, description)
    return first_label(text, fv.WORK_SETTINGS, [lowered, F.lower(location)])


def employment_type(description: Column, salary: Column, lowered: Column) -> Column:
    text = F.concat_ws(" ", description, salary)
    return first_label(text, fv.EMPLOYMENT_TYPES, [lowered, F.lower(salary)])


def distinct_matches(text: Column, pattern: str) -> Column:
    """All matches as written, first seen first, each once, joined."""
    return F.array_join(F.array_distinct(_all_matches(text, pattern, 1)), "; ")


def credentials(text: Column) -> Column:
    return distinct_matches(text, fv.CREDENTIAL_PATTERN)


def education(text: Column) -> Column:
    return distinct_matches(text, fv.EDUCATION_PATTERN)


def preferred_credentials(description: Column, preferred: Column) -> Column:
    """Credentials in the preferred block, or anywhere when the block is blank."""
    mentioned = F.regexp_like(description, F.lit(java_pattern(fv.PREFERRED_WORD)))
    block = F.coalesce(blank_to_null(preferred), description)
    return F.when(mentioned, credentials(block)).otherwise("")


def skills(lowered_text: Column, catalogue: Sequence[str]) -> Column:
    """Catalogue labels whose text occurs, in catalogue order; text given in lower case."""
    labels = dict.fromkeys(entry.strip() for entry in catalogue)
    return F.concat_ws(
        "; ",
        *[
            F.when(F.contains(lowered_text, F.lit(label.lower())), label)
            for label in labels
        ],
    )


def from_marker(text: Column, marker: str) -> Column:
    """The text from the first marker to the end, or blank."""
    pattern = java_pattern(f"{marker}(.*)$", dot_all=True)
    return F.regexp_extract(text, pattern, 0)


def required_block(text: Column, required: Column, preferred: Column) -> Column:
    """The required part of a stripped text, from the two marker tails.

    A preferred marker after the required one leaves nothing of the required block,
    and a blank block stands for the whole text.
    """
    body = _after_marker(required, fv.REQUIRED_MARKER)
    preferred_later = (preferred != "") & (F.length(preferred) < F.length(required))
    return F.when(preferred_later | (body == ""), text).otherwise(body)


def preferred_block(preferred: Column) -> Column:
    return _after_marker(preferred, fv.PREFERRED_MARKER)


def _after_marker(tail: Column, marker: str) -> Column:
    pattern = java_pattern(f"^{marker}", dot_all=True)
    return strip(F.regexp_replace(tail, pattern, ""))


def experience_phrases(text: Column) -> Column:
    """Phrases from a number of years to the end of the sentence, each once."""
    # Ending the match at its last non-space character trims it in place.
    rest = r"[^\.]*"
    end = rf"(?:{rest}[^.{WS[1:]})?"
    pattern = fv.EXPERIENCE_PHRASE_PATTERN.replace(rest, end)
    return distinct_matches(text, pattern)
