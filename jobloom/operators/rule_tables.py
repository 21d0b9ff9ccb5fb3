"""Rules as tables: any number of keywords, places and rule sets, none of them on the driver.

A keyword occurs in a text only if its longest run of letters or digits lies inside a run of
the text. There are fewer different runs than texts, so keywords are matched with the
different runs of all texts, once each: the runs of the texts are cut into pieces of the
lengths that keywords have, and an equi-join on the piece finds the keywords. Pieces that are
no keyword's, which are nearly all, are dropped before the shuffle by a bitmap of hashes, and
so are the runs in which nothing was found, before the texts are joined with what was found.
Keywords of one run are decided on the run alone; only those of several are looked for in
the texts that hold their longest one. The shortest keywords, at most NEAR, occur most often: they
are sent to the texts, so that what they meet is not shuffled.

Work grows with the different runs and with what is found, not with rules times rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom import fixed_values as fv
from jobloom.functions.extract import NO_AMOUNT, least_annual_amount, most_years, whole
from jobloom.functions.text import folded, normalized, strip
from jobloom.operators.decide import ExclusionRules, InclusionRules, Posting, PostingFilter, no_reasons, prepared
from jobloom.session import stage

_WORD = r"[\p{L}\p{N}_]+"
_RUNS = rf"{_WORD}|[^\p{{L}}\p{{N}}_\s]+"
#: Longer keywords are filed under their first so many characters.
PIECE = 32
#: So many of the shortest keywords of one run at most are sent to the texts.
NEAR = 200_000
#: Up to so many different characters a pattern lists.
LETTERS = 500
#: Bits of the bitmap by which rows are dropped before a shuffle, as a power of two.
MARK_BITS = 27
#: Up to so many keyword rules of a sheet are tried one by one on the postings that name it.
SHORT_SHEET = 500
#: Postings that name one sheet are joined with its rules in shares of so many.
SHARE = 50_000


def _runs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_RUNS), F.lit(0)))


def _filed(rules: DataFrame, column: str) -> DataFrame:
    """The rules with the ``piece`` under which texts are to find the column."""
    return rules.withColumn("piece", F.substring(column, 1, PIECE))


def _cut(texts: DataFrame, column: str, filed: DataFrame) -> DataFrame:
    """A row for each different piece of the column that may be one of ``filed``."""
    sizes = filed.agg(F.collect_set(F.length("piece")).alias("_sizes"))

    def of_size(size: Column) -> Column:
        at = F.sequence(F.lit(1), F.length(column) - size + 1)
        return F.transform(at, lambda i: F.substring(F.col(column), i, size))

    fitting = F.filter("_sizes", lambda size: size <= F.length(column))
    pieces = F.array_distinct(F.flatten(F.transform(fitting, of_size)))
    cut = texts.crossJoin(F.broadcast(sizes)).select(*texts.columns, F.explode(pieces).alias("piece"))
    return _maybe_among(cut, "piece", filed)


def _maybe_among(rows: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """The rows whose value may be in the same column of ``values``: all that are, and few others.

    The values are a bitmap of hashes, at most 2**MARK_BITS bits however many there are, in
    rows of 64 numbers of 64 bits.
    """
    mark = F.pmod(F.xxhash64(column), F.lit(1 << MARK_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_mark") % 64).cast("int"))
    numbers = (
        values.select(mark.alias("_mark"))
        .groupBy(F.shiftright("_mark", 6).alias("_number")).agg(F.bit_or(bit).alias("_bits"))
    )
    entries = F.map_from_entries(F.collect_list(F.struct((F.col("_number") % 64).alias("at"), "_bits")))
    marks = (
        numbers.groupBy(F.shiftright("_number", 6).alias("_group")).agg(entries.alias("_of"))
        .select("_group", F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint")), lambda i: F.coalesce(F.col("_of")[i], F.lit(0).cast("bigint"))
        ).alias("_marks"))
    )
    number = F.get("_marks", (F.shiftright(mark, 6) % 64).cast("int"))
    there = (F.shiftright(mark, 12) == F.col("_group")) & (F.bit_get(number, (mark % 64).cast("int")) == 1)
    return rows.join(F.broadcast(marks), there, "left_semi")


def needles(rules: DataFrame, keyword: str = "keyword") -> DataFrame:
    """(keyword, needle, apart, run, whole) of the different keywords that are not blank.

    Short ones must stand apart from letters. ``run`` is the longest run, ``whole`` says that
    there is nothing else.
    """
    needle = strip(F.col("keyword"))
    lowered = folded(F.lower(needle))
    longest = F.array_max(F.transform(_runs(lowered), lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))
    return (
        rules.select(F.col(keyword).alias("keyword")).distinct().where(needle != "")
        .select(
            "keyword", needle.alias("needle"),
            (F.length(needle) <= fv.SHORT_KEYWORD_LENGTH).alias("apart"),
            longest["run"].alias("run"),
        )
        .withColumn("whole", (folded(F.lower("needle")) == F.col("run")) & F.regexp_like("run", F.lit(f"^{_WORD}$")))
    )


def occurs(text: Column, needle: Column, apart: Column) -> Column:
    """Whether the needle is in the text; if ``apart``, not beside ASCII letters."""
    inside = F.contains(F.lower(text), F.lower(needle))
    return F.when(apart, F.regexp_like(text, _apart_pattern(needle))).otherwise(inside)


def _apart_pattern(needle: Column) -> Column:
    return F.concat(F.lit(r"(?iu)(?<![A-Za-z])\Q"), needle, F.lit(r"\E(?![A-Za-z])"))


def keyword_hits(texts: DataFrame, rules: DataFrame, key: str = "ord") -> DataFrame:
    """(key, keyword), once each: the keywords that occur in the texts.

    ``texts`` has the unique column ``key`` and ``text``, ``rules`` the column ``keyword``; other
    columns are not read. Blank keywords and null texts match nothing. Keywords of up to
    SHORT_KEYWORD_LENGTH characters must stand apart from ASCII letters.
    """
    wanted = stage(_filed(needles(rules), "run"), "needles")
    sizes, all_near = _near_sizes(wanted)
    is_near = F.coalesce(F.col("whole") & F.length("run").isin(sizes), F.lit(False))
    nothing = no_reasons()
    by_key = texts.where(F.col(key).isNotNull()).select(key, nothing.alias("_met"), nothing.alias("_maybe"), "text")
    if not all_near:
        by_key = _met_apart(texts, wanted.where(~is_near), key).unionByName(by_key)
    listed = lambda name: F.array_distinct(F.flatten(F.collect_list(name))).alias(name)
    by_key = by_key.groupBy(key).agg(listed("_met"), listed("_maybe"), F.collect_list("text").alias("_texts"))

    def is_there(keyword: Column) -> Column:
        needle = strip(keyword)
        apart = F.length(needle) <= fv.SHORT_KEYWORD_LENGTH
        return F.exists("_texts", lambda text: occurs(text, needle, apart))

    found = F.concat("_met", F.filter("_maybe", is_there))
    if not sizes:
        return by_key.select(key, F.explode(found).alias("keyword"))
    # A piece of the runs tells all of a keyword, but whether a short one stands apart.
    near = wanted.where(is_near).select(
        "keyword", "needle", "apart", F.when(F.col("apart"), F.col("run")).otherwise(F.lower("needle")).alias("piece")
    )
    cuts = _near_cuts(near)
    keyless = texts.where(F.col(key).isNull()).select(key, nothing.alias("_found"), F.array("text").alias("_texts"))
    return _with_near(by_key.select(key, found.alias("_found"), "_texts"), near, cuts, key).unionByName(
        _with_near(keyless, near, cuts, key).distinct()
    )


def _near_sizes(wanted: DataFrame) -> tuple[list[int], bool]:
    """The lengths of the keywords that are sent to the texts, and whether there are no others.

    At most 2 * (PIECE + 1) counts come to the driver.
    """
    size = F.least(F.length("run"), F.lit(PIECE + 1)).alias("size")
    counts = wanted.groupBy("whole", size).agg(F.count(F.lit(1)).alias("number")).collect()
    sizes, number = [], 0
    for row in sorted((r for r in counts if r.whole and r.size <= PIECE), key=lambda r: r.size):
        if number + row.number > NEAR:
            break
        sizes, number = [*sizes, row.size], number + row.number
    return sizes, number == sum(r.number for r in counts)


def _met_apart(texts: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(key, _met, _maybe, text): a row for each text and run in which a keyword was met; no text."""
    found = texts.select(key, F.explode(_runs(F.col("text"))).alias("run"))
    words = found.select("run").distinct().withColumn("lowered", folded(F.lower("run")))
    met = (
        _cut(words, "lowered", wanted).drop("lowered")
        .join(wanted.withColumnRenamed("run", "wanted"), "piece")
        .where(F.contains(folded(F.lower("run")), "wanted"))
        .where(~F.col("whole") | occurs(F.col("run"), F.col("needle"), F.col("apart")))
        .groupBy("run").agg(
            F.collect_set(F.when(F.col("whole"), F.col("keyword"))).alias("_met"),
            F.collect_set(F.when(~F.col("whole"), F.col("keyword"))).alias("_maybe"),
        )
    )
    met = stage(met, "met-runs")
    return (
        _maybe_among(found, "run", met).join(met, "run")
        .select(key, "_met", "_maybe", F.lit(None).cast("string").alias("text"))
    )


def _near_cuts(near: DataFrame) -> dict[bool, list[str]]:
    """The patterns that cut text into pieces, for those that stand apart and for others: one a length."""
    sizes = near.select("apart", F.length("piece").alias("size")).distinct().collect()
    letters = near.select(F.explode(F.split("piece", "")).alias("letter")).distinct().where("letter <> ''")
    known = sorted(row.letter for row in letters.limit(LETTERS + 1).collect())
    # The characters that keywords have, if they are not too many for a pattern.
    letter = f"[{''.join(known)}]" if len(known) <= LETTERS else r"[^\n]"
    return {apart: [f"(?=({letter}{{{r.size}}}))" for r in sorted(sizes) if r.apart == apart] for apart in (True, False)}


def _with_near(rows: DataFrame, near: DataFrame, cuts: dict[bool, list[str]], key: str) -> DataFrame:
    """(key, keyword) of rows (key, _found, _texts): what was found, and what of ``near`` is there."""
    runs = F.array_distinct(F.flatten(F.transform("_texts", _runs)))
    lowered = F.lower("_runs")

    def tried(apart: bool) -> Column:
        text, where = (folded(lowered), F.col("_runs")) if apart else (lowered, F.lit(None).cast("string"))
        pieces = (F.regexp_extract_all(text, F.lit(cut), F.lit(1)) for cut in cuts[apart])
        return F.transform(F.array_distinct(F.concat(no_reasons(), *pieces)), lambda piece: F.struct(
            F.lit(None).cast("string").alias("keyword"), piece.alias("piece"), F.lit(apart).alias("apart"), where.alias("where")
        ))

    no_text = F.lit(None).cast("string")
    met = F.transform("_found", lambda keyword: F.struct(
        keyword.alias("keyword"), no_text.alias("piece"), F.lit(False).alias("apart"), no_text.alias("where")
    ))
    there = F.col("_near").isNotNull() & (~F.col("apart") | occurs(F.col("where"), F.col("needle"), F.lit(True)))
    return (
        rows.select(key, "_found", F.array_join(runs, "\n").alias("_runs"))
        .select(key, F.explode(F.concat(met, tried(True), tried(False))).alias("_either")).select(key, "_either.*")
        .join(F.broadcast(near.withColumnRenamed("keyword", "_near")), ["piece", "apart"], "left")
        .where(F.col("keyword").isNotNull() | there)
        .select(key, F.coalesce("keyword", "_near").alias("keyword"))
    )


def having_any(texts: DataFrame, rules: DataFrame, key: str = "ord") -> DataFrame:
    """The rows of ``texts`` in which some keyword occurs."""
    return texts.join(keyword_hits(texts, rules, key), key, "left_semi")


def having_none(texts: DataFrame, rules: DataFrame, key: str = "ord") -> DataFrame:
    """The rows of ``texts`` in which no keyword occurs."""
    return texts.join(keyword_hits(texts, rules, key), key, "left_anti")


def location_reasons(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(sheet_id, location, reason) of the different ``(sheet_id, location)`` in ``places`` that
    some rule of the sheet matches: the first one in order.

    ``location`` is normalised text, ``rules`` has sheet_id, ord and value. A place is tried as
    a substring and, for the states that have one, as a two-letter token; both are looked
    for in every different location once, however many rows have it.
    """
    states = F.create_map(*[F.lit(x) for pair in fv.STATE_TOKENS.items() for x in pair])
    named = rules.select("sheet_id", "ord", "value", normalized(F.col("value")).alias("wanted")).where("wanted != ''")
    tried = named.select(
        "sheet_id", "ord", "value",
        F.explode(F.array(
            F.struct(F.col("wanted").alias("keyword"), F.lit(False).alias("token")),
            F.struct(F.try_element_at(states, "wanted").alias("keyword"), F.lit(True).alias("token")),
        )).alias("try"),
    ).select("sheet_id", "ord", "value", "try.*").where("keyword IS NOT NULL")
    texts = stage(places.select("location").distinct().where("location != ''"), "different-locations")
    # Two letters are found apart from letters; other short names are found anywhere.
    named_texts = texts.withColumn("text", F.col("location"))
    tokens = keyword_hits(named_texts, tried.where("token"), "location").withColumn("token", F.lit(True))
    parts = substring_hits(named_texts, tried.where("not token"), "location").withColumn("token", F.lit(False))
    hits = tokens.unionByName(parts)
    reason = F.when(F.col("token"), _said(fv.REASON_STATE_TOKEN, F.col("value"))).otherwise(
        _said(fv.REASON_LOCATION, F.col("value"))
    )
    # A name that a sheet repeats stands once, at its first place.
    firsts = tried.groupBy("sheet_id", "keyword", "token").agg(
        F.min(F.struct("ord", "token", reason.alias("reason"))).alias("first")
    )
    return (
        places.select("sheet_id", "location").distinct()
        .join(hits, "location").join(firsts, ["sheet_id", "keyword", "token"])
        .groupBy("sheet_id", "location").agg(F.min("first")["reason"].alias("reason"))
    )


def substring_hits(texts: DataFrame, rules: DataFrame, key: str = "ord") -> DataFrame:
    """(key, keyword) of short texts, with the keywords found anywhere in them as they are."""
    wanted = _filed(rules.select("keyword").distinct(), "keyword")
    return (
        _cut(texts.select(key, "text"), "text", wanted).join(wanted, "piece")
        .where(F.contains("text", "keyword")).select(key, "keyword")
    )


def _said(template: str, value: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


# --- many rule sets at once ---

#: bucket, the text it is looked for in, the reason: in the order of reasons.
_INCLUDING = (
    ("title_keywords", "job_title", fv.REASON_TITLE_INCLUSION),
    ("description_keywords", "description", fv.REASON_DESCRIPTION_INCLUSION),
    ("keywords", "both", fv.REASON_INCLUSION),
)
_EXCLUDING = (
    ("title_keywords", "job_title", fv.REASON_TITLE_EXCLUSION),
    ("description_keywords", "description", fv.REASON_DESCRIPTION_EXCLUSION),
    ("career_level_keywords", "both", fv.REASON_CAREER_EXCLUSION),
)


def _keyword_rules(inclusion: DataFrame, exclusion: DataFrame) -> DataFrame:
    """(sheet_id, field, bucket, rule_ord, keyword, reason) of all rules that look for a keyword."""

    def listed(kind: str, rules: DataFrame, buckets: tuple) -> DataFrame:
        of = lambda value: F.coalesce(*[F.when(F.col("bucket") == b[0], value(b)) for b in buckets])
        return rules.where(F.col("bucket").isin(*[b[0] for b in buckets])).select(
            "sheet_id", of(lambda b: F.lit(b[1])).alias("field"),
            F.concat(F.lit(f"{kind}:"), "bucket").alias("bucket"),
            F.col("ord").alias("rule_ord"), F.col("value").alias("keyword"),
            of(lambda b: _said(b[2], F.col("value"))).alias("reason"),
        )

    return listed("inclusion", inclusion, _INCLUDING).unionByName(listed("exclusion", exclusion, _EXCLUDING))


def _found_reasons(postings: DataFrame, listed: DataFrame) -> DataFrame:
    """(ord, sheet_found): for each rule list the reasons of the posting's own sheet, in order."""
    both = F.concat_ws(" ", "job_title", "description")
    fields = {"job_title": F.col("job_title"), "description": F.col("description"), "both": both}
    texts = postings.select("ord", "sheet_id", F.explode(F.array(*(
        F.struct(F.lit(name).alias("field"), text.alias("text")) for name, text in fields.items()
    ))).alias("at")).select(F.struct("ord", "sheet_id", "at.field").alias("place"), "at.text")
    return (
        keyword_hits(texts, listed, "place").select("place.*", "keyword")
        .join(listed, ["sheet_id", "field", "keyword"])
        .groupBy("ord", "bucket")
        .agg(F.array_sort(F.collect_list(F.struct("rule_ord", "reason")))["reason"].alias("reasons"))
        .groupBy("ord")
        .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "reasons"))).alias("sheet_found"))
    )


def _sheet_rules(listed: DataFrame) -> DataFrame:
    """(sheet_id, sheet_rules, is_long): for each rule list of a short sheet its rules, in order.

    Of a long sheet only the first SHORT_SHEET + 1 rules are looked at, to see that it is one.
    """
    needle = strip(F.col("keyword"))
    lowered = F.lower(needle)
    apart = F.length(needle) <= fv.SHORT_KEYWORD_LENGTH
    rule = F.struct(
        "rule_ord", "keyword", F.when(apart, folded(lowered)).otherwise(lowered).alias("needle"),
        F.when(apart, _apart_pattern(needle)).alias("pattern"),
    )
    place = F.row_number().over(Window.partitionBy("sheet_id").orderBy("rule_ord"))
    first = listed.where(needle != "").withColumn("_place", place).where(F.col("_place") <= SHORT_SHEET + 1)
    return (
        first.groupBy("sheet_id", "bucket")
        .agg(F.sort_array(F.collect_list(rule)).alias("_rules"), F.max("_place").alias("_last"))
        .groupBy("sheet_id")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("bucket", "_rules"))).alias("_of"),
            (F.max("_last") > SHORT_SHEET).alias("is_long"),
        )
        .select("sheet_id", F.when(~F.col("is_long"), F.col("_of")).alias("sheet_rules"), "is_long")
    )


def _sheet_facts(inclusion: DataFrame, exclusion: DataFrame) -> DataFrame:
    """(sheet_id, has_locations, has_keywords, maximum_years, maximum_annual)"""
    has = lambda *names: F.max(F.col("bucket").isin(*names).cast("int")) == 1
    of = lambda bucket: F.max(F.when(F.col("bucket") == bucket, F.col("num_value")))
    including = inclusion.groupBy("sheet_id").agg(
        has("locations").alias("has_locations"), has(*(b for b, _, _ in _INCLUDING)).alias("has_keywords")
    )
    excluding = exclusion.groupBy("sheet_id").agg(
        of("experience_rules").alias("maximum_years"), of("salary_rules").alias("maximum_annual")
    )
    return including.join(excluding, "sheet_id", "full_outer")


def _found(kind: str, bucket: str, field: str, reason: str):
    """The reasons of the rules of one list that the posting meets: found before, or tried here."""
    name, field = f"{kind}:{bucket}", {"both": "title_and_description"}.get(field, field)

    def reasons(posting: Posting, rules: object) -> Column:
        text, lowered = posting[field], posting[f"{field}_lower"]

        def tried(alike: Column) -> Column:
            def hit(rule: Column) -> Column:
                alone = F.contains(alike, rule["needle"]) & F.regexp_like(text, rule["pattern"])
                return F.when(rule["pattern"].isNull(), F.contains(lowered, rule["needle"])).otherwise(alone)

            return F.transform(F.filter(posting["sheet_rules"][name], hit), lambda rule: _said(reason, rule["keyword"]))

        # The array of one gives the folded text a name, so that it is made once for all rules.
        met = F.flatten(F.transform(F.array(folded(lowered)), tried))
        return F.coalesce(posting["sheet_found"][name], met, no_reasons())

    return reasons


def _sheet_location(posting, rules):
    reason, location = posting["sheet_location_reason"], posting["location_normalized"]
    said = F.when(location == "", fv.REASON_LOCATION_MISSING).otherwise(
        F.coalesce(reason, F.lit(fv.REASON_LOCATION_OTHER))
    )
    free = ~F.coalesce(posting["has_locations"], F.lit(False))
    return free | reason.isNotNull(), F.array(F.when(free, fv.REASON_NO_LOCATION_RULES).otherwise(said))


@prepared(
    found=lambda posting, rules: F.concat(*[_found("inclusion", *of)(posting, rules) for of in _INCLUDING])
)
def _sheet_relevance(posting, rules):
    found = posting["found"]
    free = ~F.coalesce(posting["has_keywords"], F.lit(False))
    nothing = F.array(F.lit(fv.REASON_NOT_RELEVANT))
    reasons = F.when(free, F.array(F.lit(fv.REASON_NO_KEYWORD_RULES))).when(F.size(found) > 0, found)
    return free | (F.size(found) > 0), reasons.otherwise(nothing)


def _sheet_exclusion(bucket: str, field: str, reason: str):
    @prepared(found=_found("exclusion", bucket, field, reason))
    def handler(posting, rules):
        return F.size(posting["found"]) == 0, posting["found"]

    return handler


def _below(amount: Column, limit: Column, reason: str) -> tuple[Column, Column]:
    passes = limit.isNull() | (amount <= limit)
    text = F.format_string(reason, whole(amount), limit)
    return passes, F.when(passes, no_reasons()).otherwise(F.array(text))


@prepared(years=lambda posting, rules: most_years(posting["title_and_description"]))
def _sheet_experience(posting, rules):
    return _below(posting["years"], posting["maximum_years"], fv.REASON_YEARS)


@prepared(pay=lambda posting, rules: least_annual_amount(F.concat_ws(" ", posting["salary"], posting["description"])))
def _sheet_salary(posting, rules):
    pay = F.when(posting["pay"] < NO_AMOUNT, F.floor(posting["pay"])).otherwise(0)
    return _below(pay, posting["maximum_annual"], fv.REASON_PAY)


def _shares(postings: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with a ``_share``, so that postings of a sheet that very many name are not one task's."""
    named = postings.groupBy("sheet_id").agg(F.count(F.lit(1)).alias("_named"))
    heavy = F.broadcast(stage(named.where(F.col("_named") > SHARE), "heavy-sheets"))
    shares = F.coalesce(F.ceil(F.col("_named") / SHARE), F.lit(1))
    dealt = postings.join(heavy, "sheet_id", "left").withColumn("_share", F.pmod(F.xxhash64("ord"), shares))
    copied = facts.join(heavy, "sheet_id", "left").withColumn("_share", F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)))
    return dealt.drop("_named"), copied.drop("_named")


def decide_by_sheet(postings: DataFrame, inclusion: DataFrame, exclusion: DataFrame) -> DataFrame:
    """Add ``decision`` to postings that each name the ``sheet_id`` of their rules.

    ``inclusion`` and ``exclusion`` are the long tables of the sheets. Any number of sheets
    is applied in one job. The keyword rules of a sheet of up to SHORT_SHEET are joined to its
    postings and tried there, stage by stage; those of longer sheets are matched with the texts
    by ``keyword_hits``, not with postings by sheet. A sheet that most postings name is joined in
    shares. A posting whose sheet_id has no rules is held to none. Stages, reasons and their
    order are those of ``PostingFilter``.
    """
    postings, inclusion, exclusion = (
        stage(df, name) for df, name in ((postings, "postings"), (inclusion, "including"), (exclusion, "excluding"))
    )
    listed = _keyword_rules(inclusion, exclusion)
    facts = _sheet_facts(inclusion, exclusion).join(_sheet_rules(listed), "sheet_id", "full_outer")
    facts = stage(facts, "sheet-facts")
    placed = postings.withColumn("_place", normalized(F.col("location")))
    matched = location_reasons(
        placed.select("sheet_id", F.col("_place").alias("location")), inclusion.where("bucket = 'locations'")
    ).select("sheet_id", F.col("location").alias("_place"), F.col("reason").alias("sheet_location_reason"))
    dealt, copied = _shares(placed, facts)
    known = (
        dealt.join(matched, ["sheet_id", "_place"], "left")
        .join(copied, ["sheet_id", "_share"], "left")
        # As with what is found before, a posting without ord has no keywords.
        .withColumn("sheet_rules", F.when(F.col("ord").isNotNull(), F.col("sheet_rules")))
    )
    long_sheets = facts.where("is_long").select("sheet_id")
    if long_sheets.isEmpty():
        known = known.withColumn("sheet_found", F.lit(None).cast("map<string, array<string>>"))
    else:
        placed_right = "is_long AND (NOT coalesce(has_locations, false) OR sheet_location_reason IS NOT NULL)"
        searched = known.where(placed_right).select("ord", "sheet_id", "job_title", "description")
        found = _found_reasons(stage(searched, "searched"), listed.join(long_sheets, "sheet_id", "left_semi"))
        known = known.join(found, "ord", "left")
    chain = PostingFilter(
        InclusionRules(), ExclusionRules(),
        inclusion_handlers=[("location", _sheet_location), ("relevance", _sheet_relevance)],
        exclusion_handlers=[
            *((stage_name, _sheet_exclusion(*of)) for stage_name, of in zip(
                ("title_keywords", "description_keywords", "career_level"), _EXCLUDING
            )),
            ("experience", _sheet_experience), ("salary", _sheet_salary),
        ],
    )
    return chain.decide(known.drop("_place", "_share")).select(*postings.columns, "decision")
