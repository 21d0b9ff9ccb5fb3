"""Results depend on these words, labels, patterns and limits.

Every constant that decides a result stands here, as plain text and in the order
in which it is tried. The code elsewhere holds no word lists of its own.
"""

# --- fixed values: tables ---------------------------------------------------

POSTING_FIELDS = (
    "job_title", "company", "location", "salary", "description", "url",
    "posting_date", "source_platform", "search_keyword", "search_location",
    "collected_at",
)

# Record columns in output order, with the value a column has when nothing fills it.
RECORD_DEFAULTS = {
    "record_id": "",
    "dataset_source": "",
    "collection_date": "",
    "source_url": "",
    "source_platform": "",
    "job_title": "",
    "alternate_titles": "",
    "employer": "",
    "location": "",
    "work_setting": "Not Specified",
    "career_level": "Not Specified",
    "himss_category": "Not Specified",
    "beebe_domain": "",
    "ahima_career_map_domain": "",
    "ahima_rhia_domain_alignment": "",
    "himss_domain_alignment": "",
    "education_requirements": "",
    "required_qualifications": "",
    "preferred_qualifications": "",
    "credential_required": "Not Specified",
    "credential_preferred": "Not Specified",
    "experience_requirements": "",
    "work_requirements": "",
    "long_description": "",
    "primary_responsibilities": "",
    "qualifications": "",
    "technical_skills": "",
    "soft_skills": "",
    "ai_or_emerging_technology_skills": "",
    "salary_or_pay": "Not Listed",
    "employment_type": "Not Specified",
    "notes": "",
}

REQUIRED_FIELDS = (
    "record_id", "dataset_source", "collection_date", "source_url",
    "source_platform", "job_title", "employer", "location",
)

# --- fixed values: page checks ----------------------------------------------

BLOCK_STATUS_CODES = (401, 403, 429, 503)
BLOCK_MARKERS = (
    "permission denied",
    "access denied",
    "unusual traffic",
    "additional verification",
    "captcha",
    "cf-challenge",
    "akamai",
    "request blocked",
    "are you a robot",
    "verify you are a human",
    "enable javascript and cookies",
    "sorry, we just need to make sure you're not a robot",
)
JOB_MARKERS = ("job_seen_beacon", "jobsearch-ResultsList", "data-jk=", "jobTitle")
SHORT_PAGE_LENGTH = 1500

# --- fixed values: result-page markup ----------------------------------------

CARD_SELECTORS = ("div.job_seen_beacon", "div.resultContent", "li.css-5lfssg")
FALLBACK_CARD_SELECTORS = ("a[data-jk]", "div[data-jk]")
TITLE_SELECTORS = (
    "h2.jobTitle span[title]", "h2.jobTitle a", "a.jcs-JobTitle",
    "h2 span[title]", "a[data-jk]",
)
LINK_SELECTORS = ("a[href]",)
COMPANY_SELECTORS = (
    "[data-testid='company-name']", "span.companyName", "span.css-1h7lukg",
)
LOCATION_SELECTORS = (
    "[data-testid='text-location']", "div.companyLocation",
    "div[class*='companyLocation']",
)
SALARY_SELECTORS = (
    "div.salary-snippet-container", "div.metadata.salary-snippet-container",
    "[data-testid='attribute_snippet_testid']",
)
DATE_SELECTORS = ("span.date", "span[data-testid='myJobsStateDate']")
SNIPPET_SELECTORS = ("div.job-snippet", "ul li")
DETAIL_SELECTORS = (
    "#jobDescriptionText", "div.jobsearch-jobDescriptionText",
    "div[id*='jobDescription']",
)
SITE_NAME = "Indeed"
SITE_URL = "https://www.indeed.com"
PAGE_STEP = 10
DEFAULT_SEARCH_KEYWORDS = (
    "Health Information Management",
    "Health Informatics",
    "RHIA",
    "Medical Records",
)

# --- fixed values: rule sheets -----------------------------------------------

INCLUSION_SECTIONS = {
    "location": "locations",
    "locations": "locations",
    "keyword": "keywords",
    "keywords": "keywords",
    "title keyword": "title_keywords",
    "title keywords": "title_keywords",
    "title": "title_keywords",
    "description keyword": "description_keywords",
    "description keywords": "description_keywords",
}
SHEET_END_MARKERS = (
    "variable name",
    "him compentency-workforce data dictionary",
    "him competency-workforce data dictionary",
)
SHEET_END_PREFIX = "created from uploaded"
EXPERIENCE_RULE_PATTERN = r"(?:over|more than|>)\s*(\d+)\s*years?"
SALARY_RULE_PATTERN = r"salary\s+over\s+\$?\s*([\d,]+)"
CAREER_LEVEL_WORDS = (
    "senior", "junior", "entry", "mid", "advanced", "expert", "vp", "director",
    "chief", "intern", "internship",
)
CAREER_LEVEL_PHRASE = "career level"
DICTIONARY_HEADINGS = {
    "variable name": "variable_name",
    "label": "label",
    "definition": "definition",
    "data type": "data_type",
    "allowed values / examples": "allowed_values_raw",
    "allowed values": "allowed_values_raw",
    "applies to": "applies_to",
    "source sheet / column": "source_columns",
    "source columns": "source_columns",
    "notes for coding": "notes",
}
DICTIONARY_DESCRIPTIONS = ("label", "definition", "applies_to", "source_columns", "notes")

# --- fixed values: rule evaluation -------------------------------------------

STATE_TOKENS = {"louisiana": "la", "arkansas": "ar", "mississippi": "ms", "texas": "tx"}
SHORT_KEYWORD_LENGTH = 3
YEARS_PATTERNS = (
    r"(\d+)\s*\+?\s*(?:years?|yrs?)",
    r"minimum\s+of\s+(\d+)\s+years?",
    r"at\s+least\s+(\d+)\s+years?",
)
MONEY_PATTERN = r"\$\s?([\d,]+(?:\.\d+)?)"
HOURLY_WORDS = ("hour", "/hr")
HOURLY_LIMIT = 500
HOURS_PER_YEAR = 2080

# --- fixed values: coding of free text ---------------------------------------

WORK_SETTINGS = (
    (r"\bhybrid\b", "Hybrid"),
    (r"\bremote\b", "Remote"),
    (r"\b(on[\s-]?site|in[\s-]?person)\b", "On Site"),
)
EMPLOYMENT_TYPES = (
    (r"\bfull[\s-]?time\b", "Full Time"),
    (r"\bpart[\s-]?time\b", "Part Time"),
    (r"\bcontract\b", "Contract"),
    (r"\btemporary\b", "Temporary"),
    (r"\bintern(ship)?\b", "Internship"),
)
CREDENTIAL_PATTERN = (
    r"\b(RHIA|RHIT|CCS|CPC|CCA|CHDA|CDIP|CISSP|CPHIMS|CAHIMS|BLS|CPR)\b"
)
EDUCATION_PATTERN = (
    r"(high school diploma/?GED|associate(?:'s)? degree|bachelor(?:'s)? degree|"
    r"master(?:'s)?(?: degree)?(?: preferred)?|doctoral degree|Ph\.?D\.?)"
)
PREFERRED_MARKER = r"(preferred qualifications?|preferred|nice to have|plus)[:\-]?\s*"
REQUIRED_MARKER = (
    r"(required qualifications?|requirements?|minimum qualifications?)[:\-]?\s*"
)
PREFERRED_WORD = "preferred"
EXPERIENCE_PHRASE_PATTERN = r"(\d+\s*\+?\s*years?[^\.]*)"
TECHNICAL_SKILLS = (
    "SQL", "Tableau", "Power BI", "Excel", "EHR", "Epic", "Cerner", "ICD-10-CM",
    "ICD-10-PCS", "ICD-10", "CPT", "FHIR", "HL7", "Python", "R ", "HIPAA",
)
SOFT_SKILLS = (
    "communication", "collaboration", "teamwork", "leadership", "time management",
    "stakeholder management", "problem solving", "organization",
)
AI_SKILLS = (
    "artificial intelligence", "machine learning", " NLP", "NLP",
    "predictive modeling", "IoMT", "cloud", "FHIR", "interoperability",
    "digital health", "AI", "ML",
)
NOT_SPECIFIED = "Not Specified"
NOT_LISTED = "Not Listed"
LONG_TEXT_LENGTH = 8000
TEXT_LENGTH = 4000
SLUG_LENGTH = 40
DEMO_WORD = "demo"
DEMO_NOTE = (
    "PROVENANCE: demo/fallback Indeed record used because live crawl "
    "was empty or blocked."
)
RECORD_ID_PREFIX = "IND"
RECORD_ID_DIGITS = 4

# --- fixed values: validation ------------------------------------------------

DATE_PATTERNS = (r"\d{4}-\d{2}-\d{2}", r"\d{4}-\d{2}")
ALLOWED_VALUE_LENGTH = 60
SOFT_DEFAULTS = ("not specified", "not listed", "not applicable", "")

# --- fixed values: reasons, messages and formats ------------------------------

REASON_NO_LOCATION_RULES = "no location inclusion rules configured"
REASON_NO_KEYWORD_RULES = "no keyword inclusion rules configured"
REASON_LOCATION_MISSING = "missing location"
REASON_LOCATION_OTHER = "location not in inclusion list"
REASON_LOCATION = "matched location '{}'"
REASON_STATE_TOKEN = "matched location abbreviation for '{}'"
REASON_TITLE_INCLUSION = "title inclusion keyword '{}'"
REASON_DESCRIPTION_INCLUSION = "description inclusion keyword '{}'"
REASON_INCLUSION = "inclusion keyword '{}'"
REASON_NOT_RELEVANT = "no inclusion keywords matched title/description"
REASON_TITLE_EXCLUSION = "excluded title keyword '{}'"
REASON_DESCRIPTION_EXCLUSION = "excluded description keyword '{}'"
REASON_CAREER_EXCLUSION = "excluded career-level keyword '{}'"
REASON_YEARS = "experience requirement %d years exceeds maximum %d"
REASON_PAY = "salary/pay %d exceeds maximum annual %d"
REASON_PASSED_EXCLUSION = "passed all exclusion rules"
REASON_PASSED_ALL = "passed all inclusion and exclusion rules"
STAGE_ACCEPTED = "accepted"
REASON_JOINER = "; "

BLOCKED_STATUS = "HTTP {status} from {site} (likely anti-bot / rate limit)"
BLOCKED_EMPTY = "empty response body"
BLOCKED_MARKER = "anti-bot challenge detected ({})"
BLOCKED_SHORT = "suspiciously short non-results page (possible soft block)"

ISSUE_REQUIRED = "required field is empty"
ISSUE_COVERAGE = "schema field missing from JobRecord model"
ISSUE_DATE = "date-like value may be nonstandard: "
ISSUE_ALLOWED = ("value '", "' not in allowed examples")

NOTE_LABELS = {
    "posting_date": "Posting date: ",
    "search_keyword": "Search keyword: ",
    "search_location": "Search location: ",
    "stage": "Filter stage: ",
    "reasons": "Filter reasons: ",
}
SEARCH_URL = "{site}/jobs?q={keyword}&l={location}&start={start}"
JOB_URL = "{site}/viewjob?jk={key}"
