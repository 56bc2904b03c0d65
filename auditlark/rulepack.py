"""Rule packs: the fixed vocabulary an audit compares data and texts with.

A pack is plain data. Another jurisdiction is another ``RulePack`` (usually
``DEFAULT_PACK.replace(...)``), never other code. Order matters everywhere a
"first match" is reported, so every table is a tuple in declared order.
"""

from __future__ import annotations

import dataclasses

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# --------------------------------------------------------------------------
# Patterns, word lists, constants and message texts that audit
# results must agree on.
# --------------------------------------------------------------------------

PII_PATTERNS = (
    ("email", r"[\w\.\-\+]+@[\w\.\-]+\.\w{2,}"),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("phone", r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"),
    ("credit_card", r"\b(?:\d{4}[-\s]?){3}\d{4}\b"),
    ("ip_address", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"),
    ("date_of_birth", r"\b(?:0[1-9]|1[0-2])[/\-](?:0[1-9]|[12]\d|3[01])[/\-](?:19|20)\d{2}\b"),
)

SENSITIVE_KEYWORDS = (
    ("health_data", ("diagnosis", "treatment", "medical", "prescription", "health condition",
                     "mental health", "physical health", "patient", "clinical")),
    ("biometric_data", ("fingerprint", "iris", "face scan", "facial recognition", "retina",
                        "voiceprint", "palm print", "gait", "biometric")),
    ("neural_data", ("eeg", "brainwave", "neural signal", "brain-computer", "neurofeedback",
                     "neural data", "brain scan")),
    ("genetic_data", ("dna", "genetic", "genome", "chromosom", "hereditary")),
    ("geolocation", ("gps", "latitude", "longitude", "precise location", "geolocation",
                     "geo-fence", "geofence")),
    ("racial_ethnic", ("race", "ethnicity", "ethnic origin", "racial")),
    ("religious", ("religion", "religious belief", "faith", "worship")),
    ("sexual_orientation", ("sexual orientation", "gender identity", "sex life")),
)

COLUMN_HINTS = (
    ("email", ("email", "e-mail", "email_address")),
    ("name", ("name", "first_name", "last_name", "full_name")),
    ("phone", ("phone", "telephone", "mobile", "cell")),
    ("ssn", ("ssn", "social_security", "social_sec")),
    ("address", ("address", "street", "city", "zip", "postal")),
    ("dob", ("dob", "date_of_birth", "birth_date", "birthday")),
    ("ip_address", ("ip", "ip_address")),
)

CONSUMER_ID_COLUMNS = ("customer_id", "user_id", "consumer_id", "id", "email", "account_id")

NUMBER_WORDS = (
    ("one hundred thousand", "100000"),
    ("thirty-five thousand", "35000"),
    ("thirty five thousand", "35000"),
    ("forty-five", "45"),
    ("forty five", "45"),
    ("sixty", "60"),
    ("ninety", "90"),
    ("one hundred", "100"),
)

# (threshold value, confidence, patterns); the first level with any hit wins
THRESHOLD_LEVELS = (
    (100000, 0.95, (
        r"100[,.]?000\s+consumers",
        r"100000\s+consumers",
        r"not\s+less\s+than\s+100[,.]?000",
        r"personal\s+data\s+of.*?100[,.]?000",
    )),
    (35000, 0.90, (
        r"35[,.]?000\s+consumers",
        r"35000\s+consumers",
        r"derives.*revenue.*sale.*personal\s+data.*35[,.]?000",
    )),
)
THRESHOLD_UNKNOWN_CONFIDENCE = 0.3

SENSITIVE_CATEGORIES = (
    "racial or ethnic origin",
    "religious beliefs",
    "mental or physical health condition",
    "mental or physical health diagnosis",
    "sex life",
    "sexual orientation",
    "citizenship or immigration status",
    "biometric data",
    "genetic data",
    "precise geolocation",
    "neural data",
    "personal data of a known child",
)

STATUTE_RIGHTS = (
    ("access", ("right to access", "right to confirm", "confirm whether", "access personal data")),
    ("correct", ("right to correct", "correct inaccuracies")),
    ("delete", ("right to delete", "deletion of personal data", "right to request deletion")),
    ("portability", ("right to obtain", "portable", "data portability", "readily usable format")),
    ("opt-out", ("right to opt out", "opt-out of the processing", "opt out of", "opt-out")),
    ("appeal", ("right to appeal", "appeal a decision", "appeal process")),
)

EXEMPTIONS = (
    ("glba", ("gramm-leach-bliley", "glba", "financial institution")),
    ("hipaa", ("hipaa", "health insurance portability", "protected health information")),
    ("ferpa", ("ferpa", "family educational rights")),
    ("coppa", ("coppa", "children's online privacy")),
    ("fcra", ("fair credit reporting", "fcra")),
    ("nonprofit", ("nonprofit", "non-profit", "not-for-profit")),
    ("government", ("state agency", "political subdivision", "government entity")),
    ("higher_education", ("institution of higher education", "higher education")),
)

# (timeline key, patterns); a later pattern of the same key replaces an earlier one
TIMELINE_PATTERNS = (
    ("consumer_request_response_days", (
        r"(\d+)\s*(?:calendar\s+)?days.*(?:respond|response|request)",
        r"without\s+undue\s+delay.*?(\d+)\s*days",
    )),
    ("cure_period_days", (r"(\d+)\s*(?:calendar\s+)?days.*(?:cure|correct|remedy)",)),
    ("appeal_response_days", (r"(\d+)\s*(?:calendar\s+)?days.*appeal",)),
)
DEFAULT_TIMELINE = ("consumer_request_response_days", 45, "CTDPA default")

# (right, description, keywords)
POLICY_RIGHTS = (
    ("access",
     "Consumers have the right to confirm whether their personal data is being processed and to access that personal data.",
     ("access", "request a copy", "copy of the personal data", "obtain your data", "view your data", "confirm whether")),
    ("correct",
     "Consumers have the right to correct inaccuracies in their personal data.",
     ("correct", "correction", "inaccuracies", "inaccurate", "rectify", "amend")),
    ("delete",
     "Consumers have the right to delete personal data provided by or obtained about the consumer.",
     ("delete", "deletion", "erase", "erasure", "remove your data", "right to delete")),
    ("portability",
     "Consumers have the right to obtain a copy of their personal data in a portable, readily usable format.",
     ("portable", "portability", "machine-readable", "readily usable format", "export")),
    ("opt-out",
     "Consumers have the right to opt out of the processing of personal data for targeted advertising, sale of personal data, or profiling.",
     ("opt out", "opt-out", "do not sell", "targeted advertising", "profiling", "unsubscribe from processing")),
    ("appeal",
     "Consumers have the right to appeal a controller's refusal to take action on a request within a reasonable period of time.",
     ("appeal", "appeal process", "appeal a refusal", "dispute", "reconsider")),
)
HIGH_SEVERITY_RIGHTS = ("access", "delete", "opt-out")
SIMILARITY_STRONG = 0.45
SIMILARITY_WITH_KEYWORD = 0.25

DISCLOSURE_TERMS = (
    ("health_data", ("health", "medical", "diagnosis", "treatment", "health condition")),
    ("biometric_data", ("biometric", "fingerprint", "facial recognition", "iris")),
    ("neural_data", ("neural", "brain", "eeg", "neurofeedback")),
    ("genetic_data", ("genetic", "dna", "genome")),
    ("geolocation", ("geolocation", "precise location", "gps", "location data")),
    ("racial_ethnic", ("race", "ethnicity", "ethnic origin", "racial")),
    ("religious", ("religion", "religious", "faith")),
    ("sexual_orientation", ("sexual orientation", "gender identity")),
)

APPEAL_TERMS = ("appeal", "dispute", "review decision", "reconsideration", "grievance",
                "contest", "challenge a decision")
APPEAL_DETAIL_TERMS = ("inform the consumer", "appeal process", "online mechanism",
                       "how to appeal", "submit an appeal")
# quality -> confidence
APPEAL_CONFIDENCE = (("DETAILED", 0.95), ("BASIC", 0.75), ("MISSING", 0.90))
NO_APPEAL_TEXT = ("Business privacy policy does not include an appeal procedure. CTDPA Sec. 42-520(a)(4) "
                  "requires controllers to establish a process for consumers to appeal.")
WEAK_APPEAL_TEXT = ("Policy mentions appeals but lacks detail on the appeal process. Consider adding "
                    "specific instructions for consumers.")

REQUEST_DATE_NAMES = ("request", "request_date", "date_requested", "submitted")
RESPONSE_DATE_NAMES = ("response", "response_date", "date_responded", "completed")
RESPONSE_LIMIT_DAYS = 45
EXTENSION_DAYS = 45

# (violation type, right or empty, text); an empty right is the text for the whole type
RECOMMENDATIONS = (
    ("MISSING_RIGHT", "access", "Update your privacy policy to clearly state that consumers can confirm and access their personal data. Provide a mechanism (e.g., web form, email) for submitting access requests."),
    ("MISSING_RIGHT", "correct", "Add a provision allowing consumers to correct inaccuracies in their personal data. Describe the correction process."),
    ("MISSING_RIGHT", "delete", "Include a clear right-to-delete provision. Specify how consumers can request deletion and any exceptions."),
    ("MISSING_RIGHT", "portability", "State that consumers can obtain their personal data in a portable, readily usable format (e.g., CSV, JSON)."),
    ("MISSING_RIGHT", "opt-out", "Add opt-out rights for targeted advertising, sale of personal data, and profiling. Consider a universal opt-out mechanism."),
    ("MISSING_RIGHT", "appeal", "Establish and document an appeal process for when consumer requests are denied."),
    ("UNDISCLOSED_SENSITIVE_DATA", "", "Update your privacy policy to explicitly disclose the processing of {data_category} data. Under CTDPA, processing sensitive data requires the consumer's consent."),
    ("CRITICAL_NO_APPEAL", "", "Immediately establish an appeal process. CTDPA Sec. 42-520(a)(4) requires controllers to inform consumers of their right to appeal and provide an online mechanism for submitting appeals."),
    ("LATE_RESPONSE", "", "Implement a request tracking system to ensure all consumer requests receive responses within 45 calendar days. Consider automated reminders at 30 and 40 days."),
    ("EXTREME_LATE_RESPONSE", "", "URGENT: Responses exceeding 90 days represent serious CTDPA violations. Audit your request handling process immediately and consider additional staffing or automation."),
    ("THRESHOLD_TRIGGERED", "", "Your organization processes data from enough consumers to trigger full CTDPA compliance requirements. Ensure all provisions are implemented."),
    ("WEAK_APPEAL_PROCESS", "", "Strengthen your appeal process documentation. Include specific instructions, timelines, and an online submission mechanism."),
)

SEVERITY_WEIGHTS = (("CRITICAL", 10), ("HIGH", 7), ("MEDIUM", 4), ("LOW", 1), ("INFO", 0))
DEFAULT_SEVERITY_WEIGHT = 4
MAX_RISK_SCORE = 100
# (lowest score, grade, label)
GRADE_LADDER = ((70, "F", "Critical Risk"), (50, "D", "High Risk"), (30, "C", "Moderate Risk"),
                (10, "B", "Low Risk"))
GRADE_BELOW_LADDER = ("A", "Minimal Risk")
GRADE_NO_FINDINGS = ("A", "Excellent")

# (right or violation type, section, quote)
LAW_CITATIONS = (
    ("access", "Sec. 42-520(a)(1)", "A controller shall... confirm whether or not the controller is processing the consumer's personal data and provide the consumer access to such personal data."),
    ("correct", "Sec. 42-520(a)(2)", "A controller shall... correct inaccuracies in the consumer's personal data, taking into account the nature of the personal data and the purposes of the processing."),
    ("delete", "Sec. 42-520(a)(3)", "A controller shall... delete personal data provided by, or obtained about, the consumer."),
    ("portability", "Sec. 42-520(a)(4)", "A controller shall... provide a copy of the consumer's personal data... in a portable and, to the extent technically feasible, readily usable format."),
    ("opt-out", "Sec. 42-520(a)(5)", "A controller shall... opt out of the processing of the personal data for purposes of targeted advertising, the sale of personal data, or profiling."),
    ("appeal", "Sec. 42-520(a)(6)", "A controller shall establish a process for a consumer to appeal the controller's refusal to take action on a request... The appeal process shall be conspicuously available."),
    ("UNDISCLOSED_SENSITIVE_DATA", "Sec. 42-515(27) & Sec. 42-520(b)", "A controller shall not process sensitive data concerning a consumer without obtaining the consumer's consent... 'Sensitive data' includes personal data revealing racial or ethnic origin, religious beliefs, health condition or diagnosis, sex life, sexual orientation, or biometric or genetic data."),
    ("THRESHOLD_TRIGGERED", "Sec. 42-516(a)", "This chapter applies to persons that conduct business in Connecticut or produce products or services targeted to residents of Connecticut and that during the preceding calendar year controlled or processed personal data of not less than 100,000 consumers... or 25,000 consumers and derived more than 25% of gross revenue from the sale of personal data."),
    ("LATE_RESPONSE", "Sec. 42-520(c)", "A controller shall act on a verified consumer request without undue delay, but not later than forty-five days after receipt of the request."),
    ("EXTREME_LATE_RESPONSE", "Sec. 42-520(c)", "A controller shall act on a verified consumer request without undue delay, but not later than forty-five days after receipt of the request."),
)

GROUND_TRUTH_KEYS = ("expected_violations", "expected_pii_types", "expected_rights_coverage",
                     "expected_compliance_status")
TOTAL_CLAUSES = 6
STAGE_GATE = 0.7

# How texts are taken apart and joined.
PARAGRAPH_BREAK = r"\n\s*\n|(?=\n\s*(?:\d+\.|[A-Z][.)]\s|#{1,3}\s|Section\s))"
FENCED_BLOCK = r"```(?:json)?\s*\n?([\s\S]*?)\n?```"
NEXT_DOCUMENT = "\n\n--- Next Document ---\n\n"
NARRATIVE_VIOLATION = r"(?is)VIOLATION\s*\d+[:\s]*(.*?)(?:\n\n|\z)"
NARRATIVE_GRADE = r"(?i)(?:Risk Grade|Grade)[:\s]*\*{0,2}\s*\*{0,2}([A-F])"
NARRATIVE_SUMMARY = r"(?is)(?:EXECUTIVE SUMMARY|SUMMARY)\s*\n+(.*?)(?:\n\n|\n---|\n###)"

# --------------------------------------------------------------------------
# End of the fixed values.
# --------------------------------------------------------------------------

# What a text must hold for a pattern to be able to match at all: any one of
# some literals, or one cheap probe pattern. This spares the costly patterns
# most texts and cannot change a result. Patterns not listed are always tried.
# NUMBER_SHAPES is what each number pattern is without its borders; all begin with a digit, so other characters cost
# one test, and the dates, amounts and keys that fill most tables pass none of them.
NUMBER_SHAPES = (r"\d(?:\d(?:\d(?:-\d{2}-\d{4}|\)?+[-.\s]?+\d{3}[-.\s]?+\d{4}|\d[-\s]?+\d{4}[-\s]?+\d{4}[-\s]?+\d{4})"
                 r"|[/\-]\d{2}[/\-](?:19|20)\d{2})|\.\d{1,3}+\.\d{1,3}+\.\d)")
PATTERN_NEEDS = (
    *((p, ("@",)) for kind, p in PII_PATTERNS if kind == "email"),
    *((p, ("000",)) for _, _, patterns in THRESHOLD_LEVELS for p in patterns),
    *((p, ("days",)) for _, patterns in TIMELINE_PATTERNS for p in patterns),
)
PATTERN_PROBES = tuple((p, NUMBER_SHAPES) for kind, p in PII_PATTERNS if kind != "email")
# A look at the next character with which a match can begin; it spares the word borders, which cost most, everywhere else.
PATTERN_STARTS = tuple((p, r"(?=[\d+(])") for kind, p in PII_PATTERNS if kind != "email")

# Cuts for TF-IDF scores, which are lower than an encoder's.
LEXICAL_STRONG = 0.35
LEXICAL_WITH_KEYWORD = 0.15

# The head of every report.
REPORT_TITLE = "Privacy compliance audit"
REPORT_FRAMEWORK = "Connecticut Data Privacy Act, Conn. Gen. Stat. Sec. 42-515 et seq."
REPORT_SCOPE = "Connecticut only"

# The order in which an audit lists its violations, and which of them the appeals step finds.
VIOLATION_ORDER = ("MISSING_RIGHT", "UNDISCLOSED_SENSITIVE_DATA", "THRESHOLD_TRIGGERED", "CRITICAL_NO_APPEAL", "WEAK_APPEAL_PROCESS", "LATE_RESPONSE",
                   "EXTREME_LATE_RESPONSE")
APPEAL_VIOLATIONS = VIOLATION_ORDER[3:]

# Ways dates are written, in the order they are tried: name, what a text of that kind looks like, and Spark's pattern for it (None: as ISO).
# Where day and month could be either, the month comes first, as in the United States.
DATE_FORMATS = (
    ("iso", r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$", None),
    ("month_first", r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    ("month_first_time", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    ("day_first", r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    ("year_slashes", r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    ("dots", r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    ("compact", r"^\d{8}$", "yyyyMMdd"),
    ("day_name", r"^\d{1,2}[- ][A-Z][a-z]{2}[- ]\d{4}$", "d-MMM-yyyy"),
    ("name_day", r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    ("year_month", r"^\d{4}(-\d{2})?$", None),
)


@dataclasses.dataclass(frozen=True)
class RulePack:
    """All tables an audit needs; every field may be replaced."""

    patterns: tuple = PII_PATTERNS
    pattern_needs: tuple = PATTERN_NEEDS
    pattern_probes: tuple = PATTERN_PROBES
    pattern_starts: tuple = PATTERN_STARTS
    keywords: tuple = SENSITIVE_KEYWORDS
    column_hints: tuple = COLUMN_HINTS
    consumer_id_columns: tuple = CONSUMER_ID_COLUMNS
    number_words: tuple = NUMBER_WORDS
    threshold_levels: tuple = THRESHOLD_LEVELS
    threshold_unknown_confidence: float = THRESHOLD_UNKNOWN_CONFIDENCE
    categories: tuple = SENSITIVE_CATEGORIES
    statute_rights: tuple = STATUTE_RIGHTS
    exemptions: tuple = EXEMPTIONS
    timelines: tuple = TIMELINE_PATTERNS
    default_timeline: tuple = DEFAULT_TIMELINE
    policy_rights: tuple = POLICY_RIGHTS
    high_severity_rights: tuple = HIGH_SEVERITY_RIGHTS
    similarity_strong: float = SIMILARITY_STRONG
    similarity_with_keyword: float = SIMILARITY_WITH_KEYWORD
    lexical_strong: float = LEXICAL_STRONG
    lexical_with_keyword: float = LEXICAL_WITH_KEYWORD
    disclosure_terms: tuple = DISCLOSURE_TERMS
    appeal_terms: tuple = APPEAL_TERMS
    appeal_detail_terms: tuple = APPEAL_DETAIL_TERMS
    request_date_names: tuple = REQUEST_DATE_NAMES
    response_date_names: tuple = RESPONSE_DATE_NAMES
    date_formats: tuple = DATE_FORMATS
    response_limit_days: int = RESPONSE_LIMIT_DAYS
    extension_days: int = EXTENSION_DAYS
    recommendations: tuple = RECOMMENDATIONS
    severity_weights: tuple = SEVERITY_WEIGHTS
    default_severity_weight: int = DEFAULT_SEVERITY_WEIGHT
    citations: tuple = LAW_CITATIONS
    ground_truth_keys: tuple = GROUND_TRUTH_KEYS

    def replace(self, **changes) -> "RulePack":
        return dataclasses.replace(self, **changes)

    @property
    def described_rights(self) -> tuple:
        """The policy rights, and statute rights without a description under a generic one."""
        known = {right for right, _, _ in self.policy_rights}
        return self.policy_rights + tuple(
            (right, f"right to {right}", ()) for right, _ in self.statute_rights if right not in known
        )

    def needs(self, pattern: str) -> tuple:
        return dict(self.pattern_needs).get(pattern, ())

    def probe(self, pattern: str) -> str | None:
        return dict(self.pattern_probes).get(pattern)

    def start(self, pattern: str) -> str:
        return dict(self.pattern_starts).get(pattern, "")

    def terms(self) -> list[tuple[str, str]]:
        """(category, term) of every keyword in declared order."""
        return [(category, term) for category, terms in self.keywords for term in terms]


DEFAULT_PACK = RulePack()


def lookup_frame(spark: SparkSession, columns: dict[str, tuple], types: dict[str, pa.DataType] | None = None) -> DataFrame:
    """A rule table as a DataFrame.

    Arrow input becomes a local relation, so Catalyst knows its exact size and
    itself decides between a broadcast and a shuffled join.
    """
    types = types or {}
    arrays = {name: pa.array(list(values), types.get(name, pa.string())) for name, values in columns.items()}
    return spark.createDataFrame(pa.table(arrays))


def severity_weight_frame(spark: SparkSession, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    return lookup_frame(
        spark,
        {"severity": tuple(s for s, _ in pack.severity_weights), "weight": tuple(w for _, w in pack.severity_weights)},
        {"weight": pa.int64()},
    )


def recommendation_frame(spark: SparkSession, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    kinds, rights, texts = zip(*pack.recommendations)
    return lookup_frame(spark, {"type": kinds, "right": rights, "text": texts})


def citation_frame(spark: SparkSession, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    keys, sections, quotes = zip(*pack.citations)
    return lookup_frame(spark, {"citation_key": keys, "section": sections, "quote": quotes})


def required_right_frame(spark: SparkSession, pack: RulePack = DEFAULT_PACK) -> DataFrame:
    rights, descriptions, _ = zip(*pack.policy_rights)
    return lookup_frame(spark, {"right": rights, "description": descriptions})
