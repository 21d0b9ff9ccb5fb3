"""Explainable include and exclude decisions."""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.extract import NO_AMOUNT, least_annual_amount, most_years, whole
from jobloom.functions.text import CASE_PARTNERS, apart_pattern, normalized, normalized_literal
from jobloom.session import stage


@dataclass(frozen=True)
class InclusionRules:
    locations: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    title_keywords: tuple[str, ...] = ()
    description_keywords: tuple[str, ...] = ()
    other_rules: tuple[str, ...] = ()


@dataclass(frozen=True)
class ExclusionRules:
    title_keywords: tuple[str, ...] = ()
    description_keywords: tuple[str, ...] = ()
    career_level_keywords: tuple[str, ...] = ()
    maximum_years: int | None = None
    maximum_annual: int | None = None
    raw_rules: tuple[str, ...] = ()


# A handler sees the posting's columns by name and the rules, and gives two columns:
# whether the posting passes (boolean), and why (array of text).
Posting = Mapping[str, Column]
RuleHandler = Callable[[Posting, object], tuple[Column, Column]]

_LOWERED = ("job_title", "description", "title_and_description")


def no_reasons() -> Column:
    return F.array().cast("array<string>")


_RULE = "struct<pos: int, reason: string, needle: string, pattern: string>"
#: From so many rules on, texts are cut into pieces and only the rules filed under these are tried.
LONG_LIST = 64
#: Up to so many rules are tried in plain expressions, which Spark compiles; functions on arrays are not compiled.
PLAIN_LIST = 16
_PIECE = 3


def _literal_table(rows: list, of: str) -> Column:
    """Rows as one array. It is a single literal in the plan, however long."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<{of}>")


def _pieces(text: str, size: int) -> set[str]:
    return {text[i : i + size] for i in range(len(text) - size + 1)}


def _rules_to_try(text: Column, rows: list[dict]) -> Column:
    """The rules whose needle may be in the text: all that are, of a long list few others.

    Each rule is filed under the piece of its needle that the fewest needles have, in a
    table of slots by the piece's checksum, so that no rule is looked at for a text without it.
    """
    if len(rows) < LONG_LIST:
        return _literal_table(rows, _RULE)
    sizes = [min(_PIECE, len(row["needle"])) for row in rows]
    pieces = [_pieces(row["needle"], size) for row, size in zip(rows, sizes)]
    often = Counter(piece for some in pieces for piece in some)
    slots = [[] for _ in range(1 << (2 * len(rows)).bit_length())]
    for row, some in zip(rows, pieces):
        piece = min(some, key=lambda piece: (often[piece], piece))
        slots[zlib.crc32(piece.encode("utf-8", "replace")) % len(slots)].append(row)
    parts = F.concat(*[
        F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)) for size in sorted(set(sizes))
    ])
    numbers = F.array_distinct(F.transform(parts, lambda piece: (F.crc32(piece) % len(slots)).cast("int")))
    table = _literal_table(slots, f"array<{_RULE}>")
    return F.coalesce(F.flatten(F.transform(numbers, lambda n: F.get(table, n))), F.array().cast(f"array<{_RULE}>"))


def keyword_hits(
    posting: Posting, field: str, keywords: Sequence[str], reason: str
) -> tuple[Column, Column]:
    """Whether any keyword occurs in the field, and a reason for each that does.

    Short tokens must stand apart from letters, longer ones match anywhere; blank keywords
    match nothing.
    """
    text, lowered = posting[field], posting[f"{field}_lower"]
    rows = []
    for keyword in keywords:
        needle = keyword.strip()
        pattern = apart_pattern(needle) if len(needle) <= fv.SHORT_KEYWORD_LENGTH else None
        if needle:
            rows.append({
                "pos": len(rows), "reason": reason.format(keyword), "needle": needle.lower(), "pattern": pattern,
            })

    odd = reduce(or_, [F.contains(lowered, F.lit(c)) for c in CASE_PARTNERS])

    if 0 < len(rows) <= PLAIN_LIST:
        met = []
        for row in rows:
            there = F.contains(lowered, F.lit(row["needle"]))
            met.append((there | odd) & F.regexp_like(text, F.lit(row["pattern"])) if row["pattern"] else there)
        said = [F.when(one, F.array(F.lit(row["reason"]))).otherwise(no_reasons()) for one, row in zip(met, rows)]
        return F.coalesce(reduce(or_, met), F.lit(False)), F.concat(*said)

    def hit(item: Column) -> Column:
        there = F.contains(lowered, item["needle"]) | odd
        alone = there & F.regexp_like(text, item["pattern"])
        return F.when(item["pattern"].isNull(), F.contains(lowered, item["needle"])).otherwise(alone)

    # A text with such letters may match needles that it does not contain as they are.
    tried = _rules_to_try(lowered, rows)
    if len(rows) >= LONG_LIST:
        tried = F.when(odd, _literal_table(rows, _RULE)).otherwise(tried)
    found = F.filter(tried, hit)
    if len(rows) >= LONG_LIST:
        found = F.array_sort(found)
    found = F.transform(found, lambda item: item["reason"])
    return F.size(found) > 0, found


def match_location(location: Column, allowed: Sequence[str]) -> Column:
    """The reason of the first allowed location that matches, or null.

    ``location`` is normalised text. Each entry is tried as a substring and then, for
    the states that have one, as a two-letter token.
    """
    rows = []
    for name in allowed:
        wanted = normalized_literal(name)
        token = fv.STATE_TOKENS.get(wanted)
        if wanted:
            said = fv.REASON_LOCATION.format(name)
            rows.append({"pos": len(rows), "reason": said, "needle": wanted, "pattern": None})
        if wanted and token:
            said, pattern = fv.REASON_STATE_TOKEN.format(name), apart_pattern(token, ignore_case=False)
            rows.append({"pos": len(rows), "reason": said, "needle": token, "pattern": pattern})

    if 0 < len(rows) <= PLAIN_LIST:
        said = []
        for row in rows:
            met = F.contains(location, F.lit(row["needle"]))
            if row["pattern"]:
                met = met & F.regexp_like(location, F.lit(row["pattern"]))
            said.append(F.when(met, row["reason"]))
        return F.coalesce(*said)

    def hit(item: Column) -> Column:
        there = F.contains(location, item["needle"])
        return F.when(item["pattern"].isNull(), there).otherwise(there & F.regexp_like(location, item["pattern"]))

    found = F.filter(_rules_to_try(location, rows), hit)
    return F.array_min(found)["reason"]


def prepared(**columns: Callable[[Posting, object], Column]):
    """Give a handler named columns that are computed once, before it looks at them."""

    def attach(handler: RuleHandler) -> RuleHandler:
        handler.prepared = columns
        return handler

    return attach


def apart(handler: RuleHandler) -> RuleHandler:
    """Give a handler only the rows that reach it.

    Spark computes Python functions for all rows of a projection, whatever ``F.when`` stands
    around them. For such a handler the rows so far are kept as a table, and those settled by
    then are put beside the others again afterwards.
    """
    handler.apart = True
    return handler


@prepared(
    matched=lambda posting, rules: match_location(
        posting["location_normalized"], rules.locations
    )
)
def location_inclusion(posting: Posting, rules: InclusionRules) -> tuple[Column, Column]:
    if not rules.locations:
        return F.lit(True), F.array(F.lit(fv.REASON_NO_LOCATION_RULES))
    matched, location = posting["matched"], posting["location_normalized"]
    reason = F.when(location == "", fv.REASON_LOCATION_MISSING).otherwise(
        F.coalesce(matched, F.lit(fv.REASON_LOCATION_OTHER))
    )
    return (location != "") & matched.isNotNull(), F.array(reason)


def keyword_inclusion(posting: Posting, rules: InclusionRules) -> tuple[Column, Column]:
    lists = (
        ("job_title", rules.title_keywords, fv.REASON_TITLE_INCLUSION),
        ("description", rules.description_keywords, fv.REASON_DESCRIPTION_INCLUSION),
        ("title_and_description", rules.keywords, fv.REASON_INCLUSION),
    )
    if not any(keywords for _, keywords, _ in lists):
        return F.lit(True), F.array(F.lit(fv.REASON_NO_KEYWORD_RULES))
    found = [keyword_hits(posting, *each) for each in lists]
    relevant = reduce(or_, [hit for hit, _ in found])
    nothing = F.array(F.lit(fv.REASON_NOT_RELEVANT))
    return relevant, F.when(relevant, F.concat(*[r for _, r in found])).otherwise(nothing)


def _excluded_by(field: str, rule_list: str, reason: str) -> RuleHandler:
    def handler(posting: Posting, rules: ExclusionRules) -> tuple[Column, Column]:
        hit, reasons = keyword_hits(posting, field, getattr(rules, rule_list), reason)
        return ~hit, F.when(hit, reasons).otherwise(no_reasons())

    return handler


title_exclusion = _excluded_by("job_title", "title_keywords", fv.REASON_TITLE_EXCLUSION)
description_exclusion = _excluded_by(
    "description", "description_keywords", fv.REASON_DESCRIPTION_EXCLUSION
)
career_level_exclusion = _excluded_by(
    "title_and_description", "career_level_keywords", fv.REASON_CAREER_EXCLUSION
)


def _at_most(amount: Column, limit: int, reason: str) -> tuple[Column, Column]:
    """Pass unless the amount is strictly above the limit."""
    text = F.format_string(reason, whole(amount), F.lit(limit))
    passes = amount <= limit
    return passes, F.when(passes, no_reasons()).otherwise(F.array(text))


@prepared(years=lambda posting, rules: most_years(posting["title_and_description"]))
def experience_exclusion(posting: Posting, rules: ExclusionRules) -> tuple[Column, Column]:
    if rules.maximum_years is None:
        return F.lit(True), no_reasons()
    return _at_most(posting["years"], rules.maximum_years, fv.REASON_YEARS)


@prepared(
    pay=lambda posting, rules: least_annual_amount(
        F.concat_ws(" ", posting["salary"], posting["description"])
    )
)
def salary_exclusion(posting: Posting, rules: ExclusionRules) -> tuple[Column, Column]:
    if rules.maximum_annual is None:
        return F.lit(True), no_reasons()
    pay = F.when(posting["pay"] < NO_AMOUNT, F.floor(posting["pay"])).otherwise(0)
    return _at_most(pay, rules.maximum_annual, fv.REASON_PAY)


INCLUSION_HANDLERS: tuple[tuple[str, RuleHandler], ...] = (
    ("location", location_inclusion),
    ("relevance", keyword_inclusion),
)
EXCLUSION_HANDLERS: tuple[tuple[str, RuleHandler], ...] = (
    ("title_keywords", title_exclusion),
    ("description_keywords", description_exclusion),
    ("career_level", career_level_exclusion),
    ("experience", experience_exclusion),
    ("salary", salary_exclusion),
)


class PostingFilter:
    """Rules and handlers, applied as one chain of projections."""

    def __init__(
        self,
        inclusion: InclusionRules,
        exclusion: ExclusionRules,
        *,
        inclusion_handlers: Sequence[tuple[str, RuleHandler]] | None = None,
        exclusion_handlers: Sequence[tuple[str, RuleHandler]] | None = None,
    ) -> None:
        self.stages = [
            (f"inclusion:{name}", handler, inclusion)
            for name, handler in inclusion_handlers or INCLUSION_HANDLERS
        ] + [
            (f"exclusion:{name}", handler, exclusion)
            for name, handler in exclusion_handlers or EXCLUSION_HANDLERS
        ]

    def decide(self, postings: DataFrame) -> DataFrame:
        """Add ``decision``, with the reasons up to the stage that settled it.

        A stage is computed only for rows that passed the stages before it.
        """
        df = postings.withColumn("_location", normalized(F.col("location")))
        names = [f"_stage_{i}" for i in range(len(self.stages))]
        posting = _posting_columns(df, staged=False)
        for i, (_, handler, rules) in enumerate(self.stages):
            reached = F.col(f"{names[i - 1]}.passes") if i else F.lit(True)
            needed = getattr(handler, "prepared", None)
            seen, settled = posting, None
            if i and getattr(handler, "apart", False):
                kept = stage(df, "reached")
                reached = F.coalesce(reached, F.lit(False))
                settled, df, reached = kept.where(~reached), kept.where(reached), F.lit(True)
            if needed:
                columns = [make(posting, rules).alias(name) for name, make in needed.items()]
                df = df.withColumn("_prepared", F.when(reached, F.struct(*columns)))
                seen = posting | {name: F.col(f"_prepared.{name}") for name in needed}
            passes, reasons = handler(seen, rules)
            verdict = F.struct(
                F.coalesce(passes, F.lit(False)).alias("passes"), reasons.alias("reasons")
            )
            df = df.withColumn(names[i], F.when(reached, verdict))
            if settled is not None:
                df = df.unionByName(settled, allowMissingColumns=True)
            if i == 0:
                # Lower-cased text serves every later stage; the first one, on the
                # short location field, has by then dropped most rows.
                df = df.withColumn("_text", F.when(F.col(f"{names[0]}.passes"), _texts(posting)))
                posting = _posting_columns(df, staged=True)
        outcome = F
        for name, (label, _, _) in zip(names, self.stages):
            outcome = outcome.when(~F.col(f"{name}.passes"), label)
        reasons = F.concat(*[F.coalesce(f"{name}.reasons", no_reasons()) for name in names])
        df = df.withColumn("_reasons", reasons)
        df = df.withColumn("_accepted", F.coalesce(F.col(f"{names[-1]}.passes"), F.lit(False)))
        passed = F.when(F.size("_reasons") == 0, fv.REASON_PASSED_ALL).otherwise(
            fv.REASON_PASSED_EXCLUSION
        )
        decision = F.struct(
            F.col("_accepted").alias("included"),
            outcome.otherwise(fv.STAGE_ACCEPTED).alias("stage"),
            F.when(F.col("_accepted"), F.array_append("_reasons", passed))
            .otherwise(F.col("_reasons"))
            .alias("reasons"),
        )
        return df.select(*postings.columns, decision.alias("decision"))


def _texts(posting: Posting) -> Column:
    both = posting["title_and_description"]
    return F.struct(
        both.alias("title_and_description"),
        *[posting[f"{name}_lower"].alias(f"{name}_lower") for name in _LOWERED],
    )


def _posting_columns(df: DataFrame, *, staged: bool) -> dict[str, Column]:
    columns = {name: F.col(name) for name in df.columns if not name.startswith("_")}
    columns["location_normalized"] = F.col("_location")
    if staged:
        names = ["title_and_description", *[f"{name}_lower" for name in _LOWERED]]
        return columns | {name: F.col(f"_text.{name}") for name in names}
    both = F.concat_ws(" ", columns["job_title"], columns["description"])
    columns["title_and_description"] = both
    return columns | {f"{name}_lower": F.lower(columns[name]) for name in _LOWERED}


def accepted(decided: DataFrame) -> DataFrame:
    return decided.where(F.col("decision.included"))


def audit_rows(decided: DataFrame) -> DataFrame:
    """One row per posting, rejected ones too, with the reasons as text."""
    return decided.select(
        F.col("url").alias("source_url"),
        "source_platform",
        "job_title",
        F.col("company").alias("employer"),
        "location",
        F.col("decision.included").alias("included"),
        F.col("decision.stage").alias("stage"),
        F.array_join("decision.reasons", fv.REASON_JOINER).alias("reasons"),
    )


def included_counts(decided: DataFrame) -> DataFrame:
    return decided.agg(
        F.count_if(F.col("decision.included")).alias("included"),
        F.count(F.lit(1)).alias("total"),
    )
