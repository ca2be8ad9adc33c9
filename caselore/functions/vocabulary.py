"""The word lists, ranges and label texts that results depend on."""

# An e-mail whose subject holds one of these is left out.
EMAIL_SUBJECT_EXCLUSIONS = [
    "New File Uploaded for",
    "{CREDITCARDPII}",
    "Automated Notification",
    "Automated reply:",
    "Automatic reply:",
]

# Texts removed from notes, in this order.
NOTE_PATTERNS = [
    "ALPHANUMERICPII",
    "NAMEPII",
    "EMAILPII",
    "@microsoft.com",
    "NAME+EMAILPII",
    "ADDRESSPII",
    "PHONEPII",
    "{}",
    "CREDITCARDPII",
    '<a href="mailto:.{NAME+}',
    'href="mailto: ">',
    '<a href="mailto:@',
    "PHONE+",
    "NAME+",
    "UNCPII",
    "==============================================",
    "___",
]

# Separators of threads and of thread pieces inside a document.
THREAD_SEPARATOR = "\n----\n"
PIECE_SEPARATOR = "\n---\n"

# Entity types of the graph.
ENTITY_TYPES = [
    "CASE_PROBLEM",
    "PROBLEM_STATEMENT",
    "ISSUE",
    "ISSUE_CATEGORY",
    "ISSUE_SUBCATEGORY",
    "SYMPTOM",
    "ROOT_CAUSE",
    "FAILURE_MODE",
    "FAILURE_EFFECT",
    "FAILURE_CAUSE",
    "PREVENTION_CONTROL",
    "DETECTION_CONTROL",
    "SEVERITY_RATING",
    "OCCURRENCE_FREQUENCY",
    "DETECTABILITY_RATING",
    "RESOLUTION_STEPS",
    "OUTAGE",
    "KNOWN_ISSUE",
    "SELFHELP_TOPIC",
    "SELFHELP_STEP",
    "PRODUCT",
    "CUSTOMER_SOLVABLE",
    "FREQUENCY_INDICATOR",
]

# Relation type, source type, target type (None: not fixed), least and greatest strength.
RELATION_TYPES = [
    ("COVERED_BY", "CASE_PROBLEM", None, 8, 10),
    ("NOT_COVERED_BY", "CASE_PROBLEM", None, 9, 10),
    ("PARTIALLY_COVERED_BY", "CASE_PROBLEM", None, 6, 8),
    ("FREQUENTLY_OCCURS_WITHOUT_HELP", "CASE_PROBLEM", None, 10, 10),
    ("CUSTOMER_SOLVABLE_BUT_NO_GUIDE", "CASE_PROBLEM", None, 9, 10),
    ("TRIGGERS", "FAILURE_CAUSE", "FAILURE_MODE", 1, 10),
    ("RESULTS_IN", "FAILURE_MODE", "FAILURE_EFFECT", 1, 10),
    ("MANIFESTS_AS", "FAILURE_MODE", "SYMPTOM", 1, 10),
    ("ESCALATES_TO", "ISSUE", "PROBLEM_STATEMENT", 1, 10),
    ("PREVENTS", "PREVENTION_CONTROL", "FAILURE_MODE", 1, 10),
    ("DETECTS", "DETECTION_CONTROL", "FAILURE_MODE", 1, 10),
    ("MITIGATES", "PREVENTION_CONTROL", "FAILURE_EFFECT", 1, 10),
    ("RESOLVES", "RESOLUTION_STEPS", "FAILURE_MODE", 1, 10),
    ("PREVENTABLE_BY_CUSTOMER", "FAILURE_MODE", "CUSTOMER_SOLVABLE", 1, 10),
    ("PREVENTION_STEPS_MISSING", "PREVENTION_CONTROL", "SELFHELP_STEP", 1, 10),
    ("HAS_SEVERITY", "FAILURE_MODE", "SEVERITY_RATING", 1, 10),
    ("HAS_FREQUENCY", "FAILURE_MODE", "OCCURRENCE_FREQUENCY", 1, 10),
    ("HAS_DETECTABILITY", "FAILURE_MODE", "DETECTABILITY_RATING", 1, 10),
]

# The questions asked of every corpus.
GAP_QUESTIONS = [
    "What problems appear frequently in support cases but have no corresponding self-help content?",
    "Which issues could customers solve themselves but currently require support intervention?",
    "What existing self-help content covers which specific problems?",
    "Which self-help topics need updates based on current support resolution patterns?",
]
FMEA_QUESTIONS = [
    "What are the most common failure modes and their causes across all support cases?",
    "Which failure modes have the highest risk priority based on severity, frequency, and detectability?",
    "What prevention controls exist and where are the gaps?",
    "Which failures could be prevented with better monitoring or customer education?",
]
FOLLOW_UP_QUESTIONS = [
    "What problems appear most frequently in support cases but have no self-help documentation?",
    "Which customer issues could be resolved with better self-service content?",
    "What are the top 5 knowledge gaps where customers repeatedly need support help?",
    "Which product areas have the most support cases but least self-help coverage?",
    "What failure modes occur repeatedly and could be prevented?",
]

# Thresholds and defaults.
HIGH_RISK_RPN = 100
CRITICAL_RPN = 200
DEFAULT_RATING = 5
DEFAULT_IMPACT = 5
DEFAULT_FREQUENCY = 1
MAX_INCREMENTS = 10
MAX_INDEX_AGE_DAYS = 7
CHUNK_SIZE = 1200
CHUNK_OVERLAP = 100
RECORD_TTL_SECONDS = 86400 * 365

# Parameters of the extraction record format (template variables, so these are defaults of ours).
TUPLE_DELIMITER = "<|>"
RECORD_DELIMITER = "##"
END_MARK = "<|COMPLETE|>"
