"""The registered queries again, in SQL for the comparison engine.

Each text is built from named steps; a step is written from the rules in
``fixed_values`` alone and shares no code with the column functions.
"""

from __future__ import annotations

from jobloom import fixed_values as fv
from jobloom.plans import testdata as td
from jobloom.plans.catalog import (
    AS_OF,
    DICTIONARY,
    EXCLUSION,
    INCLUSION,
    RELEVANCE,
    WIDER_DICTIONARY,
    WITH_DESCRIPTION,
)

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TABLES = {name: name for name in ("orders", "customer", "part", "supplier", "documents", "postings", "cards_html", "page_bodies")}


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _norm(x: str) -> str:
    return f"regexp_replace(lower({_strip(x)}), '{_SPACE}+', ' ', 'g')"


def _word(x: str, keyword: str) -> str:
    """Keyword containment with the letter rule for short tokens."""
    kw = keyword.strip()
    if len(kw) <= fv.SHORT_KEYWORD_LENGTH:
        return f"regexp_matches({x}, '(?i)(^|[^A-Za-z]){kw}([^A-Za-z]|$)')"
    return f"contains(lower({x}), {_q(kw.lower())})"


def _listed(parts: list[str]) -> str:
    """Join the parts that are not null."""
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda v: v IS NOT NULL), '; ')"


def _distinct(matches: str) -> str:
    return (
        f"array_to_string(list_filter({matches}, "
        f"lambda v, i: list_position({matches}, v) = i), '; ')"
    )


def _steps(*steps: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n"


def _key(title: str, company: str, location: str, url: str) -> str:
    u = _norm(url)
    return f"""CASE WHEN {u} = '' THEN concat('tcl::', {_norm(title)}, '|', {_norm(company)}, '|', {_norm(location)})
      WHEN regexp_matches({u}, '[?&]jk=[a-z0-9]') THEN concat('url::jk::', regexp_extract({u}, '[?&]jk=([a-z0-9]+)', 1))
      ELSE concat('url::', split_part({u}, '#', 1)) END"""


POSTINGS = f"postings AS ({td.POSTINGS_SQL.format(**_TABLES)})"
_POSTING_KEY = _key("job_title", "company", "location", "url")
UNIQUE = f"""uniq AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {_POSTING_KEY} ORDER BY ord) AS rn FROM postings) WHERE rn = 1)"""


# --- rules ---


def _location_reason(rules) -> str:
    loc, cases = _norm("location"), []
    for name in rules.locations:
        wanted = name.strip().lower()
        cases.append(f"WHEN contains(nloc, {_q(wanted)}) THEN {_q(f"matched location '{name}'")}")
        if wanted in fv.STATE_TOKENS:
            cases.append(
                f"WHEN regexp_matches(nloc, '(^|[^A-Za-z]){fv.STATE_TOKENS[wanted]}([^A-Za-z]|$)') "
                f"THEN {_q(f"matched location abbreviation for '{name}'")}"
            )
    return (
        f"(SELECT CASE WHEN nloc = '' THEN 'missing location' {' '.join(cases)} "
        f"ELSE 'location not in inclusion list' END FROM (SELECT {loc} AS nloc))"
    )


def _hits(lists) -> str:
    return _listed(
        [
            f"CASE WHEN {_word(text, k)} THEN {_q(reason.format(k))} END"
            for text, words, reason in lists
            for k in words
        ]
    )


_BLOB = "concat(job_title, ' ', description)"
_PAY_TEXT = "concat(salary, ' ', description)"


def _relevance_hits(rules) -> str:
    return _hits(
        [
            ("job_title", rules.title_keywords, "title inclusion keyword '{}'"),
            ("description", rules.description_keywords, "description inclusion keyword '{}'"),
            (_BLOB, rules.keywords, "inclusion keyword '{}'"),
        ]
    )


def _years(pattern: str, x: str = _BLOB) -> str:
    return f"list_transform(regexp_extract_all({x}, '(?i){pattern}', 1), lambda v: CAST(v AS BIGINT))"


def _amounts(x: str = _PAY_TEXT) -> str:
    value = "CAST(replace(v, ',', '') AS DOUBLE)"
    hourly = f"(contains(lower({x}), 'hour') OR contains(lower({x}), '/hr'))"
    return (
        f"list_transform(list_filter(regexp_extract_all({x}, '{fv.MONEY_PATTERN}', 1), "
        f"lambda v: replace(v, ',', '') <> ''), "
        f"lambda v: CAST(floor(CASE WHEN {hourly} AND {value} < 500 THEN {value} * 2080 ELSE {value} END) AS BIGINT))"
    )


_MOST_YEARS = f"list_max({_years(fv.YEARS_PATTERNS[0])})"
_LEAST_PAY = f"list_min({_amounts()})"


def _rule_columns(inclusion, exclusion) -> str:
    """One text column per rule: the reasons, blank where an exclusion rule passes."""
    relevance = (
        f"coalesce(nullif({_relevance_hits(inclusion)}, ''), 'no inclusion keywords matched title/description')"
        if inclusion.keywords or inclusion.title_keywords or inclusion.description_keywords
        else "'no keyword inclusion rules configured'"
    )
    title = _hits([("job_title", exclusion.title_keywords, "excluded title keyword '{}'")])
    body = (
        _hits([("description", exclusion.description_keywords, "excluded description keyword '{}'")])
        if exclusion.description_keywords
        else "''"
    )
    career = _hits([(_BLOB, exclusion.career_level_keywords, "excluded career-level keyword '{}'")])
    return f"""{_location_reason(inclusion)} AS r_location, {relevance} AS r_relevance,
    {title} AS r_title, {body} AS r_description, {career} AS r_career,
    {_MOST_YEARS} AS n_years, {_LEAST_PAY} AS n_pay"""


def _decided(inclusion, exclusion) -> str:
    return f"""ruled AS (SELECT *, {_rule_columns(inclusion, exclusion)} FROM uniq),
limited AS (SELECT *,
    CASE WHEN n_years > {exclusion.maximum_years} THEN concat('experience requirement ', n_years, ' years exceeds maximum {exclusion.maximum_years}') ELSE '' END AS r_experience,
    CASE WHEN n_pay > {exclusion.maximum_annual} THEN concat('salary/pay ', n_pay, ' exceeds maximum annual {exclusion.maximum_annual}') ELSE '' END AS r_salary
  FROM ruled),
decided AS (SELECT *, stage = 'accepted' AS included,
    CASE stage WHEN 'inclusion:location' THEN r_location
      WHEN 'inclusion:relevance' THEN concat(r_location, '; ', r_relevance)
      ELSE concat(r_location, '; ', r_relevance, '; ', CASE stage
        WHEN 'exclusion:title_keywords' THEN r_title WHEN 'exclusion:description_keywords' THEN r_description
        WHEN 'exclusion:career_level' THEN r_career WHEN 'exclusion:experience' THEN r_experience
        WHEN 'exclusion:salary' THEN r_salary ELSE 'passed all exclusion rules' END) END AS reasons
  FROM (SELECT *, CASE WHEN NOT starts_with(r_location, 'matched') THEN 'inclusion:location'
      WHEN starts_with(r_relevance, 'no inclusion') THEN 'inclusion:relevance'
      WHEN r_title <> '' THEN 'exclusion:title_keywords'
      WHEN r_description <> '' THEN 'exclusion:description_keywords'
      WHEN r_career <> '' THEN 'exclusion:career_level'
      WHEN r_experience <> '' THEN 'exclusion:experience'
      WHEN r_salary <> '' THEN 'exclusion:salary' ELSE 'accepted' END AS stage FROM limited))"""


DECIDED = _decided(INCLUSION, EXCLUSION)


# --- coding of text; the step before gives "txt", the trimmed description ---


def _first_label(x: str, labels) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({x}, '(?i){pattern}') THEN '{label}'" for pattern, label in labels
    )
    return f"CASE {cases} ELSE 'Not Specified' END"


def _found(x: str, pattern: str) -> str:
    return _distinct(f"regexp_extract_all({x}, '(?i){pattern.replace(chr(39), chr(39) * 2)}', 1)")


def _skills(x: str, catalogue) -> str:
    labels = dict.fromkeys(entry.strip() for entry in catalogue)
    return _listed(
        [f"CASE WHEN contains(lower({x}), '{label.lower()}') THEN '{label}' END" for label in labels]
    )


_P_ALL = f"regexp_extract(txt, '(?is){fv.PREFERRED_MARKER}(.*)$', 0)"
_R_ALL = f"regexp_extract(txt, '(?is){fv.REQUIRED_MARKER}(.*)$', 0)"
_P_TAIL = _strip(f"regexp_extract(txt, '(?is){fv.PREFERRED_MARKER}(.*)$', 2)")
_R_TAIL = _strip(f"regexp_extract(txt, '(?is){fv.REQUIRED_MARKER}(.*)$', 2)")
_REQUIRED = f"""CASE WHEN {_R_ALL} <> '' AND {_P_ALL} <> '' AND length({_P_ALL}) < length({_R_ALL}) THEN txt
      WHEN {_R_TAIL} = '' THEN txt ELSE {_R_TAIL} END"""
_PREFERRED_CREDENTIALS = f"""CASE WHEN contains(lower(txt), 'preferred')
      THEN {_found(f"CASE WHEN {_P_TAIL} <> '' THEN {_P_TAIL} ELSE txt END", fv.CREDENTIAL_PATTERN)} ELSE '' END"""
_PHRASES_ALL = f"list_transform(regexp_extract_all(txt, '(?i){fv.EXPERIENCE_PHRASE_PATTERN}', 1), lambda v: {_strip('v')})"
_PHRASES = _distinct(_PHRASES_ALL)


def _notes(decision: str | None) -> str:
    parts = [
        f"CASE WHEN {c} <> '' THEN concat('{label}: ', {c}) END"
        for label, c in (
            ("Posting date", "posting_date"),
            ("Search keyword", "search_keyword"),
            ("Search location", "search_location"),
        )
    ]
    if decision:
        parts += [
            f"CASE WHEN {decision} THEN concat('Filter stage: ', stage) END",
            f"CASE WHEN {decision} THEN concat('Filter reasons: ', reasons) END",
        ]
    parts.append(
        f"CASE WHEN contains(lower(url), 'demo') OR starts_with(lower(posting_date), 'demo') THEN {_q(fv.DEMO_NOTE)} END"
    )
    return _listed(parts)


def _records(source: str, name: str, number: str, decision: str | None = None) -> str:
    made = {
        "record_id": f"printf('IND%04d', {number})" if number else "''",
        "dataset_source": "'Indeed'",
        "collection_date": f"CASE WHEN collected_at = '' THEN '{AS_OF}' ELSE collected_at END",
        "source_url": "url",
        "source_platform": "CASE WHEN source_platform = '' THEN 'Indeed' ELSE source_platform END",
        "job_title": _strip("job_title"),
        "employer": _strip("company"),
        "location": _strip("location"),
        "work_setting": _first_label("concat(location, ' ', txt)", fv.WORK_SETTINGS),
        "education_requirements": _found("txt", fv.EDUCATION_PATTERN),
        "required_qualifications": f"left({_REQUIRED}, 4000)",
        "preferred_qualifications": f"left({_P_TAIL}, 4000)",
        "credential_required": f"coalesce(nullif({_found('txt', fv.CREDENTIAL_PATTERN)}, ''), 'Not Specified')",
        "credential_preferred": f"coalesce(nullif({_PREFERRED_CREDENTIALS}, ''), 'Not Specified')",
        "experience_requirements": _PHRASES,
        "long_description": "left(txt, 8000)",
        "primary_responsibilities": "left(txt, 4000)",
        "qualifications": f"left({_REQUIRED}, 4000)",
        "technical_skills": _skills("txt", fv.TECHNICAL_SKILLS),
        "soft_skills": _skills("txt", fv.SOFT_SKILLS),
        "ai_or_emerging_technology_skills": _skills("txt", fv.AI_SKILLS),
        "salary_or_pay": f"coalesce(nullif({_strip('salary')}, ''), 'Not Listed')",
        "employment_type": _first_label("concat(txt, ' ', salary)", fv.EMPLOYMENT_TYPES),
        "notes": _notes(decision),
    }
    columns = ", ".join(
        f"{made.get(field, _q(default))} AS {field}" for field, default in fv.RECORD_DEFAULTS.items()
    )
    return f"{name} AS (SELECT ord, {columns} FROM (SELECT *, {_strip('description')} AS txt FROM ({source})))"


_FIELDS = ", ".join(fv.RECORD_DEFAULTS)
RECORDS = _records(
    "SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ord) AS n FROM decided) WHERE included",
    "records", "n", "true",
)
_NO_ERROR = " AND ".join(f"trim({name}) <> ''" for name in fv.REQUIRED_FIELDS)
FINAL = f"""final AS (SELECT * REPLACE (printf('IND%04d', row_number() OVER (ORDER BY ord)) AS record_id)
  FROM records WHERE {_NO_ERROR})"""
TEXTS = f"texts AS ({td.TEXTS_SQL.format(**_TABLES)})"
_TEXT = f"SELECT *, {_strip('description')} AS txt FROM texts"

_TO_RECORDS = (POSTINGS, UNIQUE, DECIDED, RECORDS)
_TO_DECIDED = (POSTINGS, UNIQUE, DECIDED)


def _issues(dictionary, enforce: bool = False) -> str:
    checks = [
        (name, f"trim({name}) = ''", "'required field is empty'", "error")
        for name in fv.REQUIRED_FIELDS
        if name in dictionary.data_types
    ]
    for name, kind in dictionary.data_types.items():
        if name not in fv.RECORD_DEFAULTS:
            checks.append((name, "true", "'schema field missing from JobRecord model'", "warning"))
            continue
        if "date" in kind.lower():
            bad = f"{name} <> '' AND NOT regexp_matches(trim({name}), '^\\d{{4}}-\\d{{2}}(-\\d{{2}})?$')"
            checks.append((name, bad, f"concat('date-like value may be nonstandard: ', {name})", "warning"))
        allowed = dictionary.allowed_values.get(name, ())
        if enforce and allowed and max(map(len, allowed)) <= fv.ALLOWED_VALUE_LENGTH:
            bad = (
                f"{name} NOT IN ({', '.join(map(_q, allowed))}) AND "
                f"lower(trim({name})) NOT IN ('', 'not specified', 'not listed', 'not applicable')"
            )
            checks.append((name, bad, f"concat('value ''', {name}, ''' not in allowed examples')", "warning"))
    found = " UNION ALL ".join(
        f"SELECT ord, {i} AS rank, record_id, '{name}' AS field, {text} AS message, '{severity}' AS severity FROM records WHERE {bad}"
        for i, (name, bad, text, severity) in enumerate(checks)
    )
    return f"""issues AS (SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY rank) - 1 AS issue_pos,
  record_id, field, message, severity FROM ({found}))"""


_ISSUE_COLUMNS = "ord, issue_pos, record_id, field, message, severity"


# --- pages ---

_CARDS_HTML = f"cards_html AS ({td.CARDS_HTML_SQL.format(**_TABLES)})"
_PAGES = (
    POSTINGS,
    _CARDS_HTML,
    "page_bodies AS (SELECT page_id, string_agg(card, '' ORDER BY ord) AS body FROM cards_html GROUP BY page_id)",
    f"result_pages AS ({td.RESULT_PAGES_SQL.format(**_TABLES)})",
)


def _block_reason(html: str, status: str | None) -> str:
    cases = []
    if status:
        codes = ", ".join(map(str, fv.BLOCK_STATUS_CODES))
        cases.append(
            f"WHEN {status} IN ({codes}) THEN concat('HTTP ', {status}, ' from Indeed (likely anti-bot / rate limit)')"
        )
    cases.append(f"WHEN {_strip(html)} = '' THEN 'empty response body'")
    cases += [
        f"WHEN contains(lower({html}), {_q(m)}) THEN {_q(f'anti-bot challenge detected ({m})')}"
        for m in fv.BLOCK_MARKERS
    ]
    if status:
        cases.append(
            f"WHEN {status} = 200 AND length(lower({html})) < 1500 AND NOT regexp_matches({html}, '{'|'.join(fv.JOB_MARKERS)}') "
            "THEN 'suspiciously short non-results page (possible soft block)'"
        )
    return f"CASE {' '.join(cases)} END"


# The cards must give back the postings they were made from.
_CARDS = f"""cards AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS INTEGER) AS card_ord, ord,
    CASE WHEN ord % 9 = 8 THEN '' ELSE trim(job_title) END AS job_title, company, location, salary,
    trim(description) AS description, concat('https://www.indeed.com/viewjob?jk=k', ord - ord % 2) AS url,
    posting_date, concat('k', ord - ord % 2) AS job_key
  FROM (SELECT *, ord // 10 AS page_id FROM postings) WHERE page_id % 12 NOT IN (0, 1, 2)),
titled AS (SELECT * FROM cards WHERE job_title <> ''),
firsts AS (SELECT * FROM titled QUALIFY row_number() OVER (PARTITION BY page_id, job_key ORDER BY card_ord) = 1)"""
_CARD_COLUMNS = "page_id, card_ord, job_title, company, location, salary, description, url, posting_date, job_key"

_PROVENANCE = """CASE page_id % 3 WHEN 0 THEN 'health informatics' WHEN 1 THEN 'rhia' ELSE 'Health Informatics' END AS search_keyword,
  CASE page_id % 3 WHEN 0 THEN 'louisiana' ELSE 'Texas' END AS search_location"""


def _encode(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


# --- sheets ---


def _sheet_value(sql: str) -> str:
    return f"cells AS (SELECT sheet_id, ord, {_strip('c0')} AS value FROM ({sql.format(**_TABLES)}))"


_SECTION = "CASE lower(value) " + " ".join(
    f"WHEN '{text}' THEN '{bucket}'" for text, bucket in fv.INCLUSION_SECTIONS.items()
) + " END"
_ENDS = (
    f"(lower(value) IN ({', '.join(map(_q, fv.SHEET_END_MARKERS))}) "
    f"OR starts_with(lower(value), '{fv.SHEET_END_PREFIX}'))"
)
_EXPERIENCE_RULE = f"regexp_extract(value, '(?i){fv.EXPERIENCE_RULE_PATTERN}', 1)"
_SALARY_RULE = f"regexp_extract(value, '(?i){fv.SALARY_RULE_PATTERN}', 1)"
_KIND = f"""CASE WHEN {_EXPERIENCE_RULE} <> '' THEN 'experience_rules' WHEN {_SALARY_RULE} <> '' THEN 'salary_rules'
    WHEN lower(value) IN ({', '.join(map(_q, fv.CAREER_LEVEL_WORDS))}) OR contains(lower(value), 'career level') THEN 'career_level_keywords'
    WHEN len(regexp_split_to_array(value, '\\s+')) <= 2 THEN 'title_keywords' ELSE 'description_keywords' END"""

def _inclusion_steps(sql: str) -> tuple[str, str]:
    return (
        _sheet_value(sql),
        f"""marked AS (SELECT *, {_SECTION} AS section, max({_ENDS}::INT) OVER w AS ended,
              last_value(CASE WHEN value = '' THEN '' ELSE {_SECTION} END IGNORE NULLS) OVER w AS inside
              FROM cells WINDOW w AS (PARTITION BY sheet_id ORDER BY ord ROWS UNBOUNDED PRECEDING))""",
    )


_INCLUSION_ROWS = """SELECT sheet_id, coalesce(nullif(inside, ''), 'other_rules') AS bucket, ord, value FROM marked
          WHERE ended = 0 AND value <> '' AND section IS NULL"""


def _exclusion_steps(sql: str) -> tuple[str, str]:
    return (
        _sheet_value(sql),
        f"""kinds AS (SELECT *, {_KIND} AS bucket, CAST(replace(CASE WHEN {_EXPERIENCE_RULE} <> '' THEN {_EXPERIENCE_RULE}
              ELSE nullif({_SALARY_RULE}, '') END, ',', '') AS BIGINT) AS num_value FROM cells WHERE value <> '')""",
    )


_EXCLUSION_ROWS = """SELECT sheet_id, 'raw_rules' AS bucket, ord, value, CAST(NULL AS BIGINT) AS num_value FROM kinds
          UNION ALL SELECT sheet_id, bucket, ord, value, num_value FROM (SELECT * FROM kinds WHERE bucket LIKE '%keywords'
            QUALIFY row_number() OVER (PARTITION BY sheet_id, bucket, value ORDER BY ord) = 1)
          UNION ALL SELECT sheet_id, bucket, ord, value, num_value FROM (SELECT * FROM kinds WHERE bucket LIKE '%\\_rules' ESCAPE '\\'
            QUALIFY row_number() OVER (PARTITION BY sheet_id, bucket ORDER BY ord DESC) = 1)"""


# --- rules as tables: every rule with every row ---

_KEYWORDS = f"words AS (SELECT DISTINCT keyword, {_strip('keyword')} AS needle FROM ({td.KEYWORDS_SQL.format(customer='customer', part='part', supplier='supplier')}))"
_SEARCHED = "searched AS (SELECT ord, concat(job_title, ' ', company, ' ', url) AS txt, lower(txt) AS low FROM postings)"


def _occurs(text: str, low: str, needle: str) -> str:
    return (
        f"CASE WHEN length({needle}) > {fv.SHORT_KEYWORD_LENGTH} THEN contains({low}, lower({needle})) "
        f"WHEN contains({low}, lower({needle})) THEN "
        f"regexp_matches({text}, concat('(?i)(^|[^A-Za-z])', regexp_escape({needle}), '([^A-Za-z]|$)')) ELSE false END"
    )


_PLACE_TOKEN = "CASE wanted " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fv.STATE_TOKENS.items()) + " END"


def _place_reason(where: str) -> str:
    """First matching rule for each location; ``where`` names (sheet_id, location) and rules."""
    return f"""SELECT sheet_id, location, arg_min(CASE WHEN contains(location, wanted) THEN concat('matched location ''', value, '''')
        ELSE concat('matched location abbreviation for ''', value, '''') END, ord) AS reason
      FROM (SELECT *, {_PLACE_TOKEN} AS token FROM {where})
      WHERE wanted <> '' AND location <> '' AND (contains(location, wanted)
        OR coalesce(regexp_matches(location, '(^|[^A-Za-z])' || token || '([^A-Za-z]|$)'), false))
      GROUP BY sheet_id, location"""


_SHEET_BUCKETS = (
    ("including", "title_keywords", "t", "job_title", "title inclusion keyword"),
    ("including", "description_keywords", "d", "description", "description inclusion keyword"),
    ("including", "keywords", "k", _BLOB, "inclusion keyword"),
    ("excluding", "title_keywords", "xt", "job_title", "excluded title keyword"),
    ("excluding", "description_keywords", "xd", "description", "excluded description keyword"),
    ("excluding", "career_level_keywords", "xc", _BLOB, "excluded career-level keyword"),
)


def _own_sheet_steps() -> list[str]:
    found = ",\n".join(
        f"""hits_{name} AS (SELECT p.ord, string_agg(concat('{said} ''', value, ''''), '; ' ORDER BY r.ord) AS found
          FROM own p JOIN {table} r USING (sheet_id) WHERE bucket = '{bucket}' AND {_occurs(text, f'lower({text})', 'value')} GROUP BY p.ord)"""
        for table, bucket, name, text, said in _SHEET_BUCKETS
    )
    joined = " ".join(f"LEFT JOIN hits_{name} ON hits_{name}.ord = own.ord" for _, _, name, _, _ in _SHEET_BUCKETS)
    return [
        f"own AS (SELECT *, {_norm('location')} AS nloc FROM ({td.OWN_SHEETS_SQL.format(postings='postings')}))",
        f"including AS ({_steps(*_inclusion_steps(td.OWN_INCLUSION_SQL))}{_INCLUSION_ROWS})",
        f"excluding AS ({_steps(*_exclusion_steps(td.OWN_EXCLUSION_SQL))}{_EXCLUSION_ROWS})",
        found,
        "place AS (" + _place_reason(
            "(SELECT DISTINCT o.sheet_id, nloc AS location, r.ord, r.value, " + _norm("r.value")
            + " AS wanted FROM own o JOIN including r ON r.sheet_id = o.sheet_id AND r.bucket = 'locations')"
        ) + ")",
        """facts AS (SELECT sheet_id, bool_or(bucket = 'locations') AS has_locations,
          bool_or(bucket IN ('keywords', 'title_keywords', 'description_keywords')) AS has_keywords FROM including GROUP BY sheet_id)""",
        """limits AS (SELECT sheet_id, max(num_value) FILTER (WHERE bucket = 'experience_rules') AS most_years,
          max(num_value) FILTER (WHERE bucket = 'salary_rules') AS most_pay FROM excluding GROUP BY sheet_id)""",
        f"""ruled AS (SELECT own.ord, own.sheet_id,
          CASE WHEN NOT coalesce(has_locations, false) THEN 'no location inclusion rules configured' WHEN nloc = '' THEN 'missing location'
            ELSE coalesce(place.reason, 'location not in inclusion list') END AS r_location,
          CASE WHEN NOT coalesce(has_keywords, false) THEN 'no keyword inclusion rules configured'
            ELSE coalesce(nullif(concat_ws('; ', hits_t.found, hits_d.found, hits_k.found), ''), 'no inclusion keywords matched title/description') END AS r_relevance,
          coalesce(hits_xt.found, '') AS r_title, coalesce(hits_xd.found, '') AS r_description, coalesce(hits_xc.found, '') AS r_career,
          {_MOST_YEARS} AS n_years, {_LEAST_PAY} AS n_pay, most_years, most_pay
        FROM own {joined} LEFT JOIN place ON place.sheet_id = own.sheet_id AND place.location = nloc
          LEFT JOIN facts ON facts.sheet_id = own.sheet_id LEFT JOIN limits ON limits.sheet_id = own.sheet_id)""",
        """limited AS (SELECT *,
          CASE WHEN n_years > most_years THEN concat('experience requirement ', n_years, ' years exceeds maximum ', most_years) ELSE '' END AS r_experience,
          CASE WHEN n_pay > most_pay THEN concat('salary/pay ', n_pay, ' exceeds maximum annual ', most_pay) ELSE '' END AS r_salary FROM ruled)""",
        """staged AS (SELECT *, CASE WHEN r_location IN ('missing location', 'location not in inclusion list') THEN 'inclusion:location'
            WHEN starts_with(r_relevance, 'no inclusion') THEN 'inclusion:relevance' WHEN r_title <> '' THEN 'exclusion:title_keywords'
            WHEN r_description <> '' THEN 'exclusion:description_keywords' WHEN r_career <> '' THEN 'exclusion:career_level'
            WHEN r_experience <> '' THEN 'exclusion:experience' WHEN r_salary <> '' THEN 'exclusion:salary' ELSE 'accepted' END AS stage FROM limited)""",
    ]


_OWN_SHEET_ROWS = """SELECT ord, sheet_id, stage = 'accepted' AS included, stage,
  CASE stage WHEN 'inclusion:location' THEN r_location WHEN 'inclusion:relevance' THEN concat(r_location, '; ', r_relevance)
    ELSE concat(r_location, '; ', r_relevance, '; ', CASE stage WHEN 'exclusion:title_keywords' THEN r_title
      WHEN 'exclusion:description_keywords' THEN r_description WHEN 'exclusion:career_level' THEN r_career
      WHEN 'exclusion:experience' THEN r_experience WHEN 'exclusion:salary' THEN r_salary ELSE 'passed all exclusion rules' END) END AS reasons
FROM staged"""


_DICTIONARY = f"""cells AS ({td.DICTIONARY_SHEETS_SQL.format(**_TABLES)}),
heads AS (SELECT sheet_id, ord AS head, lower(trim(c1)) AS h1, lower(trim(c2)) AS h2, lower(trim(c3)) AS h3 FROM cells
  WHERE lower(coalesce(nullif(trim(c0), ''), nullif(trim(c1), ''), nullif(trim(c2), ''), nullif(trim(c3), ''))) = 'variable name'
  QUALIFY row_number() OVER (PARTITION BY sheet_id ORDER BY ord) = 1),
rows_ AS (SELECT sheet_id, ord, trim(c0) AS variable_name, trim(c3) AS label,
    CASE WHEN h2 = 'data type' THEN trim(c2) ELSE trim(c1) END AS data_type,
    CASE WHEN h2 = 'data type' THEN trim(c1) ELSE trim(c2) END AS allowed
  FROM cells JOIN heads USING (sheet_id) WHERE ord > head AND trim(c0) <> '' AND lower(trim(c0)) <> 'variable name'),
fields AS (SELECT sheet_id, min(ord) AS ord, variable_name, arg_max(label, ord) AS label, arg_max(data_type, ord) AS data_type,
    coalesce(arg_max(allowed, ord) FILTER (WHERE regexp_replace(allowed, '[;\\s]', '', 'g') <> ''), '') AS allowed_values_kept
  FROM rows_ GROUP BY sheet_id, variable_name)"""


def _rule_query(passes: str, reasons: str, source: str = "postings") -> str:
    return _steps(POSTINGS, TEXTS) + f"SELECT ord, {passes} AS passes, {reasons} AS reasons FROM {source}"


def _exclusion_query(reasons: str, source: str = "postings") -> str:
    return _rule_query(f"({reasons}) = ''", reasons, source)


def _skill_query(catalogue) -> str:
    both = (
        "SELECT ord, description AS txt FROM postings "
        "UNION ALL SELECT -doc_id - 1 AS ord, text AS txt FROM documents"
    )
    return _steps(POSTINGS) + f"SELECT ord, {_skills('txt', catalogue)} AS skills FROM ({both})"


def _text_query(expression: str, name: str) -> str:
    return _steps(POSTINGS, TEXTS) + f"SELECT ord, {expression} AS {name} FROM ({_TEXT})"


def oracle_sql() -> dict[str, str]:
    location = _location_reason(INCLUSION)
    relevance = _relevance_hits(RELEVANCE)
    title = _hits([("job_title", EXCLUSION.title_keywords, "excluded title keyword '{}'")])
    years = f"list_concat({', '.join(_years(p) for p in fv.YEARS_PATTERNS)})"
    everything = f"SELECT {_FIELDS} FROM final"
    return {
        "dedupe_key": _steps(POSTINGS) + f"SELECT ord, {_POSTING_KEY} AS dedupe_key FROM postings",
        "dedupe_first_seen": _steps(POSTINGS, UNIQUE)
        + "SELECT ord, job_title, company, location, url FROM uniq",
        "dedupe_documents": f"""SELECT doc_id, source FROM (SELECT doc_id, source,
          row_number() OVER (PARTITION BY {_norm('text')} ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
        "record_dedupe": _steps(POSTINGS, UNIQUE)
        + f"SELECT ord, {_strip('job_title')} AS job_title, {_strip('company')} AS employer, url AS source_url FROM uniq",
        "frontier": f"""SELECT c_name AS keyword, place AS location, CAST(page * 10 AS INTEGER) AS start,
          concat('https://www.indeed.com/jobs?q=', {_encode('c_name')}, '&l=', {_encode('place')}, '&start=', page * 10) AS url,
          left(regexp_replace(c_name, '[^a-zA-Z0-9]+', '_', 'g'), 40) AS keyword_slug,
          left(regexp_replace(place, '[^a-zA-Z0-9]+', '_', 'g'), 40) AS location_slug
          FROM customer, (VALUES ('New Orleans, LA'), ('Remote*~'), ('a&b=C++')) AS places(place), range(3) AS pages_(page)""",
        "page_block_class": _steps(*_PAGES)
        + f"SELECT page_id, {_block_reason('html', 'status_code')} AS block_reason FROM result_pages",
        "page_block_class_unknown_status": f"""SELECT page_id, {_block_reason('html', None)} AS without_status,
          {_block_reason('html', '200')} AS with_status FROM pages""",
        "page_block_counts": _steps(*_PAGES)
        + f"""SELECT block_reason, count(*) AS pages FROM (SELECT {_block_reason('html', 'status_code')} AS block_reason
          FROM result_pages) WHERE block_reason IS NOT NULL GROUP BY block_reason""",
        "page_cards": _steps(POSTINGS, _CARDS) + f"SELECT {_CARD_COLUMNS} FROM titled",
        "page_cards_dedup": _steps(POSTINGS, _CARDS) + f"SELECT {_CARD_COLUMNS} FROM firsts",
        "page_cards_dedup_table": _steps(POSTINGS)
        + """SELECT page_id, card_ord, job_key FROM (SELECT ord // 10 AS page_id, ord AS card_ord,
            regexp_extract(url, '[?&]jk=([a-zA-Z0-9]+)', 1) AS job_key, url, job_title FROM postings)
          QUALIFY row_number() OVER (PARTITION BY page_id, coalesce(nullif(job_key, ''), nullif(url, ''), job_title)
            ORDER BY card_ord) = 1""",
        "cards_as_postings": _steps(POSTINGS, _CARDS)
        + f"""SELECT page_id * {2**28} + card_ord AS ord, job_title, company,
            CASE WHEN location = '' THEN search_location ELSE location END AS location, salary, description, url,
            posting_date, 'Indeed' AS source_platform, search_keyword, search_location, '{AS_OF}' AS collected_at
          FROM (SELECT *, {_PROVENANCE} FROM firsts)""",
        "card_detail_enrich": _steps(POSTINGS, _CARDS)
        + """SELECT page_id, card_ord, url, coalesce(detail, f.description) AS description FROM firsts f
          LEFT JOIN (SELECT ord - ord % 2 AS pair, trim(concat('Full text. ', description)) AS detail FROM postings
            WHERE ord % 4 < 2 QUALIFY row_number() OVER (PARTITION BY ord - ord % 2 ORDER BY ord) = 1) d
          ON f.ord - f.ord % 2 = d.pair""",
        "page_scan_order": _steps(*_PAGES)
        + """SELECT row_number() OVER (ORDER BY ends_with(name, '.htm'), name) - 1 AS page_id, name AS file_name,
            length(html) AS n_chars FROM (SELECT concat('_p', page_id, file_name) AS name, html FROM result_pages)""",
        "provenance_from_name": _steps(*_PAGES) + f"SELECT page_id, {_PROVENANCE} FROM result_pages",
        "loc_match": _rule_query(f"starts_with({location}, 'matched')", location),
        "loc_match_long_list": _rule_query(f"starts_with({location}, 'matched')", location),
        "keyword_include": _rule_query(
            f"{relevance} <> ''",
            f"coalesce(nullif({relevance}, ''), 'no inclusion keywords matched title/description')",
        ),
        "excl_title": _exclusion_query(title),
        "excl_title_long_list": _exclusion_query(title),
        "excl_description": _exclusion_query(
            _hits([("description", WITH_DESCRIPTION.description_keywords, "excluded description keyword '{}'")]),
            "texts",
        ),
        "excl_career": _exclusion_query(
            _hits([(_BLOB, EXCLUSION.career_level_keywords, "excluded career-level keyword '{}'")]),
            "texts",
        ),
        "excl_experience": _exclusion_query(
            f"CASE WHEN {_MOST_YEARS} > 7 THEN concat('experience requirement ', {_MOST_YEARS}, ' years exceeds maximum 7') ELSE '' END",
            "texts",
        ),
        "excl_salary": _exclusion_query(
            f"CASE WHEN {_LEAST_PAY} > 150000 THEN concat('salary/pay ', {_LEAST_PAY}, ' exceeds maximum annual 150000') ELSE '' END",
            "texts",
        ),
        "years_extract": _steps(POSTINGS, TEXTS)
        + f"SELECT ord, array_to_string({years}, '; ') AS years, list_max({years}) AS most_years FROM texts",
        "pay_annual": _steps(POSTINGS, TEXTS)
        + f"SELECT ord, array_to_string({_amounts()}, '; ') AS amounts, {_LEAST_PAY} AS least_amount FROM texts",
        "filter_decision": _steps(POSTINGS, UNIQUE, _decided(RELEVANCE, WITH_DESCRIPTION))
        + "SELECT ord, included, stage, reasons FROM decided",
        "filter_audit": _steps(*_TO_DECIDED)
        + """SELECT url AS source_url, source_platform, job_title, company AS employer, location, included, stage, reasons
          FROM decided""",
        "filter_counts": _steps(*_TO_DECIDED)
        + "SELECT count(*) FILTER (WHERE included) AS included, count(*) AS total FROM decided",
        "filter_stage_counts": _steps(*_TO_DECIDED)
        + "SELECT stage, count(*) AS postings FROM decided GROUP BY stage",
        "custom_handler": _steps(POSTINGS)
        + f"""SELECT ord, CASE WHEN source_platform = '' THEN 'inclusion:platform' WHEN hits <> '' THEN 'exclusion:title_keywords'
            ELSE 'accepted' END AS stage,
          CASE WHEN source_platform = '' THEN 'platform missing' WHEN hits <> '' THEN concat('platform named; ', hits)
            ELSE 'platform named; passed all exclusion rules' END AS reasons
          FROM (SELECT *, {title} AS hits FROM postings)""",
        "python_handler": _steps(
            POSTINGS,
            f"""seen AS (SELECT *, {location} AS r_location, {title} AS r_title, {_hits([(_BLOB, EXCLUSION.career_level_keywords, "excluded career-level keyword '{}'")])} AS r_career,
              list_filter(regexp_split_to_array(lower({_BLOB}), '\\s+'), lambda w: w <> '') AS words FROM postings)""",
            """ruled AS (SELECT ord, r_location, r_title, r_career, CASE WHEN NOT starts_with(r_location, 'matched') THEN 'inclusion:location'
              WHEN r_title <> '' THEN 'exclusion:title_keywords' WHEN len(words) - len(list_distinct(words)) > 2 THEN 'exclusion:wording'
              WHEN r_career <> '' THEN 'exclusion:career_level' ELSE 'accepted' END AS stage FROM seen)""",
        )
        + """SELECT ord, stage, CASE stage WHEN 'inclusion:location' THEN r_location
            ELSE concat(r_location, '; no keyword inclusion rules configured; ', CASE stage WHEN 'exclusion:title_keywords' THEN r_title
              WHEN 'exclusion:wording' THEN 'says things again' WHEN 'exclusion:career_level' THEN r_career ELSE 'passed all exclusion rules' END) END AS reasons
          FROM ruled""",
        "source_plugin_union": _steps(POSTINGS)
        + f"""SELECT ord, job_title, url, length(description) AS n_chars, '' AS lang, '' AS source FROM postings UNION ALL
          SELECT doc_id + {2**56} AS ord, '' AS job_title, '' AS url, length(text) AS n_chars, lang, source FROM documents""",
        "source_fallback": _steps(POSTINGS) + "SELECT ord, job_title FROM postings",
        "run_counters": _steps(*_TO_RECORDS, _issues(DICTIONARY))
        + """SELECT 'postings' AS counter, count(*) AS value FROM postings
          UNION ALL SELECT 'unique', count(*) FROM uniq
          UNION ALL SELECT 'included', count(*) FROM decided WHERE included
          UNION ALL SELECT concat('issues: ', severity), count(*) FROM issues GROUP BY severity
          UNION ALL SELECT 'dropped', count(DISTINCT ord) FROM issues WHERE severity = 'error'""",
        "work_setting": _text_query(
            _first_label("concat(location, ' ', txt)", fv.WORK_SETTINGS), "work_setting"
        ),
        "employment_type": _text_query(
            _first_label("concat(txt, ' ', salary)", fv.EMPLOYMENT_TYPES), "employment_type"
        ),
        "credentials": _text_query(_found("txt", fv.CREDENTIAL_PATTERN), "credentials"),
        "education": _text_query(_found("txt", fv.EDUCATION_PATTERN), "education"),
        "cred_preferred": _text_query(_PREFERRED_CREDENTIALS, "credentials"),
        "skills_technical": _skill_query(fv.TECHNICAL_SKILLS),
        "skills_soft": _skill_query(fv.SOFT_SKILLS),
        "skills_ai": _skill_query(fv.AI_SKILLS),
        "req_pref_split": _text_query(f"{_REQUIRED} AS required, {_P_TAIL}", "preferred"),
        "experience_phrases": _text_query(_PHRASES, "phrases"),
        "notes": _steps(*_TO_DECIDED) + f"SELECT ord, {_notes('true')} AS notes FROM decided",
        "normalize_records": _steps(
            *_TO_DECIDED,
            _records(
                "SELECT *, row_number() OVER (ORDER BY ord) AS n FROM decided",
                "records", "n", "stage <> 'exclusion:salary'",
            ),
        )
        + f"SELECT ord, {_FIELDS} FROM records",
        "validate_required": _steps(*_TO_RECORDS, _issues(DICTIONARY))
        + f"SELECT {_ISSUE_COLUMNS} FROM issues WHERE severity = 'error'",
        "validate_dates": _steps(*_TO_RECORDS, _issues(DICTIONARY))
        + f"SELECT {_ISSUE_COLUMNS} FROM issues WHERE field = 'collection_date'",
        "validate_allowed": _steps(*_TO_RECORDS, _issues(DICTIONARY, enforce=True))
        + f"SELECT {_ISSUE_COLUMNS} FROM issues",
        "validate_allowed_table": _steps(*_TO_RECORDS)
        + """SELECT ord, record_id, field, value FROM (
            SELECT ord, record_id, 'employer' AS field, employer AS value FROM records
            WHERE employer NOT IN (SELECT c_name FROM customer)
            UNION ALL SELECT ord, record_id, 'location', location FROM records
            WHERE location NOT IN (SELECT n_name FROM nation))
          WHERE lower(trim(value)) NOT IN ('', 'not specified', 'not listed', 'not applicable')""",
        "validate_coverage": _steps(*_TO_RECORDS, _issues(WIDER_DICTIONARY))
        + f"SELECT {_ISSUE_COLUMNS} FROM issues WHERE field IN ('shift_pattern', 'revised_date')",
        "validate_split": _steps(*_TO_RECORDS)
        + f"SELECT ord, record_id, source_url FROM records WHERE {_NO_ERROR}",
        "numbered_output": _steps(*_TO_RECORDS) + "SELECT ord, record_id FROM records",
        "numbered_within_company": _steps(POSTINGS)
        + "SELECT ord, printf('J%04d', row_number() OVER (PARTITION BY company ORDER BY ord)) AS record_id FROM postings",
        "final_dataset": _steps(*_TO_RECORDS, FINAL) + everything,
        "final_dataset_wider": _steps(*_TO_RECORDS, FINAL)
        + "SELECT record_id, '' AS shift_pattern, '' AS revised_date, job_title FROM final",
        "sink_roundtrip_csv": _steps(*_TO_RECORDS, FINAL) + everything,
        "sink_roundtrip_json": _steps(*_TO_RECORDS, FINAL) + everything,
        "sink_roundtrip_audit": _steps(*_TO_DECIDED)
        + """SELECT url AS source_url, source_platform, job_title, company AS employer, location,
            CASE WHEN included THEN 'True' ELSE 'False' END AS included, stage, reasons FROM decided""",
        "raw_archive": _steps(POSTINGS)
        + """SELECT ord, job_title, company, location, salary, description, url, 'r1' AS run,
          left(collected_at, 7) AS ingest_date FROM postings""",
        "unseen_by_archive": _steps(POSTINGS, f"keyed AS (SELECT ord, collected_at, {_POSTING_KEY} AS posting_key FROM postings)")
        + """SELECT ord, posting_key FROM keyed WHERE collected_at <> '2026-08-03'
          AND posting_key NOT IN (SELECT posting_key FROM keyed WHERE collected_at = '2026-08-03')""",
        "rules_inclusion": _steps(*_inclusion_steps(td.INCLUSION_SHEETS_SQL)) + _INCLUSION_ROWS,
        "rules_exclusion": _steps(*_exclusion_steps(td.EXCLUSION_SHEETS_SQL)) + _EXCLUSION_ROWS,
        "keyword_table_hits": _steps(POSTINGS, _SEARCHED, _KEYWORDS)
        + f"SELECT ord, keyword FROM searched JOIN words ON needle <> '' AND {_occurs('txt', 'low', 'needle')}",
        "keyword_table_any": _steps(POSTINGS, _SEARCHED, _KEYWORDS)
        + f"SELECT ord FROM searched WHERE EXISTS (SELECT 1 FROM words WHERE starts_with(keyword, 'D') AND contains(low, lower(needle)))",
        "keyword_table_none": _steps(POSTINGS, _SEARCHED, _KEYWORDS)
        + f"SELECT ord FROM searched WHERE NOT EXISTS (SELECT 1 FROM words WHERE starts_with(keyword, 'D') AND contains(low, lower(needle)))",
        "location_table_first": _steps(
            POSTINGS, f"placed AS (SELECT ord, 'places' AS sheet_id, {_norm('location')} AS location FROM postings)",
            f"rules AS (SELECT ord, value, {_norm('value')} AS wanted FROM ({td.PLACES_SQL.format(customer='customer')}))",
            "place AS (" + _place_reason("(SELECT * FROM (SELECT DISTINCT sheet_id, location FROM placed) CROSS JOIN rules)") + ")",
        )
        + "SELECT ord, location, reason FROM placed LEFT JOIN place USING (sheet_id, location)",
        "decision_by_sheet": _steps(POSTINGS, *_own_sheet_steps()) + _OWN_SHEET_ROWS,
        "dictionary_fields": _steps(_DICTIONARY)
        + "SELECT sheet_id, ord, variable_name, label, data_type, allowed_values_kept FROM fields",
        "allowed_values": _steps(
            _DICTIONARY,
            """parts AS (SELECT sheet_id, variable_name, list_filter(list_transform(string_split(allowed_values_kept, ';'),
              lambda v: trim(v)), lambda v: v <> '') AS vals FROM fields)""",
        )
        + """SELECT sheet_id, variable_name, generate_subscripts(vals, 1) - 1 AS pos, unnest(vals) AS value FROM parts""",
    }
