"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour being
reproduced (label sets, keyword lists, thresholds, weights, message texts and
date formats).  Lists are kept in their natural order; where a list holds the
same word twice the duplicate is intentional (it doubles that word's weight).
Nothing here is computed.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: label sets (order matters: it breaks ties)
# ---------------------------------------------------------------------------
CATEGORIES = ["Billing", "App Bug", "Delivery", "Staff/Support", "Other"]
SENTIMENTS = ["Positive", "Neutral", "Negative"]
LIMITED = "Limited by Source Data Quality"

# ---------------------------------------------------------------------------
# FIXED VALUES: missing-value tokens a CSV reader must turn into null
# ---------------------------------------------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: audit
# ---------------------------------------------------------------------------
PLACEHOLDER_TEXTS = ["ok i guess", "meh", "ignore", "test test test ignore",
                     "test test", "ok guess", "ignoring"]
MIN_TEXT_LENGTH = 4

CONTRADICTION_POSITIVE = ["great", "love", "fantastic", "wonderful", "perfect",
                          "helpful", "solved", "excellent"]
CONTRADICTION_NEGATIVE = ["failed", "crash", "charge", "deduct", "spill", "rude",
                          "late", "cancel", "error", "worst", "ridiculous", "double"]

AGENT_NAMES = ["priya", "meera", "vikram", "rahul", "sana", "anil", "neha",
               "arjun", "moulee"]
FOREIGN_WORDS = ["pedido", "llego", "tarde", "livreur", "impoli", "cierra",
                 "aplicacion", "mera", "aaya", "bura", "accci", "nahi"]

# Health score: points deducted per 1 % of affected records.
PENALTY_MISSING_TIMESTAMP = 1.0
PENALTY_MISSING_RATING = 0.5
PENALTY_DUPLICATE_ROW = 0.5
PENALTY_DUPLICATE_FEEDBACK = 1.0
PENALTY_EMPTY_FEEDBACK = 1.5
PENALTY_INVALID_TIMESTAMP = 1.0

# ---------------------------------------------------------------------------
# FIXED VALUES: cleaning
# ---------------------------------------------------------------------------
IMPUTE_POSITIVE = ["great", "love", "perfect", "fantastic", "good", "thanks",
                   "excelente", "friendly", "solved"]
IMPUTE_NEGATIVE = ["crash", "fail", "cancel", "refund", "worst", "late", "bad",
                   "rude", "charge", "double", "spill"]
IMPUTE_NEGATIVE_RATING = 1.0
IMPUTE_POSITIVE_RATING = 5.0
IMPUTE_NEUTRAL_RATING = 3.0

# FIXED VALUES: what is taken out of a lower-cased, stripped text for its pattern
# key, in this order; ``\s`` is Python's white space, ``\w`` and ``\d`` are Unicode.
NORMALISE_PATTERNS = [
    (r"\bagent\s+\w+\s+was\s+handling\s+it[\s.!]*", ""),
    (r"thank\s+you\s+to\s+the\s+agent\s+\w+\s+who\s+handled\s+my\s+complaint\s+so\s+well[\s()#\d]*", ""),
    (r"\(\s*order\s*#\s*\d+\s*\)", ""),
    (r"\border\s*#\s*\d+\b", ""),
    (r"-\s*my\s+[\w\s]+\s+order\s+in\s+\w+", ""),
    (r"\bthis\s+is\s+the\s+(first|second|third|fourth|fifth|last)\s+time[\s.!]*", ""),
    (r"!+", "!"),
    (r"\.+", "."),
    (r"\?+", "?"),
    (r"\s+", " "),
]

# Rewrites that leave the written (local) date of a value: weekday, ordinal
# suffix, a time in the middle (C style), a time with or without zone at the end.
DATE_REWRITES = [
    (r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", ""),
    (r"(?i)\bsept\b", "Sep"),
    (r"(?i)(\d)(st|nd|rd|th)\b", "$1"),
    (r"^([A-Za-z]{3,9} +\d{1,2}) +\d{1,2}:\d{2}:\d{2} +(\d{4})$", "$1 $2"),
    (r"(?i)[T ]+([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?( ?[ap]m)?( ?(z|utc|gmt|[+-]\d{2}:?\d{2}))?$", ""),
    (r"^(\d{8})T\d{4}(\d{2})?$", "$1"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: classifier keyword tables
# ---------------------------------------------------------------------------
SENTIMENT_KEYWORDS = {
    "Negative": [
        "crash", "fail", "cancel", "delay", "late", "rude", "worst", "charge", "refund",
        "double", "cierra", "bura", "impoli", "cold", "drains", "battery", "greyed",
        "error", "failed", "subscription", "ridiculous", "hold", "disconnected",
        "miserable", "slow", "spill", "empty", "missing", "bad", "wrong",
        "fee", "bill", "charging", "charged", "debited", "deducted", "deduct", "stuck",
        "freeze", "freezes", "crashed", "waiting", "waited", "hours", "minutes", "spilled",
        "broken", "incomplete", "unauthorized", "unapproved", "scam", "cheat", "cheated",
        "complaint", "issue", "problem", "terrible", "awful", "horrible", "annoying", "poor",
        "unsatisfied", "nothing", "never", "none", "no", "not",
    ],
    "Positive": [
        "great", "love", "good", "perfect", "fantastic", "wonderful", "helpful", "friendly",
        "solved", "merci", "excelente", "encanta", "super", "smooth", "brilliant", "fast", "quick",
        "thank", "thanks", "appreciate", "happy", "satisfied", "well", "nice", "excellent",
        "awesome", "best",
    ],
}

CATEGORY_KEYWORDS = {
    "Billing": [
        "charge", "billing", "refund", "deduct", "double", "money", "subscription", "card",
        "payment", "fee", "invoice", "price", "cost", "pay", "coupon", "promo", "save50",
        "deduction", "debited",
    ],
    "App Bug": [
        "app", "crash", "loading", "freeze", "screen", "button", "greyed", "save", "login",
        "battery", "update", "version", "cierra", "aplicacion", "bug", "battery", "loading",
        "login", "slow", "freezes",
    ],
    "Delivery": [
        "delivery", "driver", "late", "delay", "cold", "food", "door", "wrong", "spill",
        "bag", "arrive", "courier", "livreur", "delivered", "address",
    ],
    "Staff/Support": [
        "agent", "support", "customer", "care", "priya", "meera", "vikram", "rahul", "sana",
        "anil", "neha", "arjun", "reply", "email", "chat", "representative", "hold",
    ],
}

# Confidence levels of the heuristic classifier.
CONFIDENCE_BASE = 0.85
CONFIDENCE_HIGH_RATING_NEGATIVE = 0.45
CONFIDENCE_LOW_RATING_POSITIVE = 0.50
CONFIDENCE_NO_RATING_DROP = 0.10
CONFIDENCE_MIXED_DROP = 0.15
CONFIDENCE_FLOOR = 0.30
CONFIDENCE_CEIL = 0.99
CONFIDENCE_FAILED_CALL_CAP = 0.6

# Leading phrases ignored when deciding whether a summary is long enough.
SUMMARY_PREFIXES = ["i was charged", "cannot add", "login button", "login keeps",
                    "app crashed", "app stuck", "driver could not", "waited two hours",
                    "order mark", "food was spilled", "customer care"]
SUMMARY_MIN_REST = 5
SUMMARY_MAX = 60
SUMMARY_CUT = 57
DEFAULT_SUMMARY_CHARS = 50

# Result defaults when a classifier answer lacks a field.
DEFAULT_SENTIMENT = "Neutral"
DEFAULT_CATEGORY = "Other"
DEFAULT_CONFIDENCE = 0.8
CLASSIFIER_BATCH_SIZE = 20

# ---------------------------------------------------------------------------
# FIXED VALUES: validation
# ---------------------------------------------------------------------------
SENTIMENT_NEGATIVE_HINTS = ["neg", "bad", "poor"]
SENTIMENT_POSITIVE_HINTS = ["pos", "good", "great", "star"]

# Free-text category value -> allowed category; first contained key wins.
CATEGORY_FALLBACK = [
    ("payment issue", "Billing"),
    ("refund", "Billing"),
    ("subscription", "Billing"),
    ("charge", "Billing"),
    ("price", "Billing"),
    ("fee", "Billing"),
    ("payment", "Billing"),
    ("billing", "Billing"),
    ("technical error", "App Bug"),
    ("crash", "App Bug"),
    ("login", "App Bug"),
    ("loading", "App Bug"),
    ("button", "App Bug"),
    ("battery", "App Bug"),
    ("app", "App Bug"),
    ("driver", "Delivery"),
    ("livreur", "Delivery"),
    ("late", "Delivery"),
    ("cold food", "Delivery"),
    ("delivery", "Delivery"),
    ("food spilled", "Delivery"),
    ("order late", "Delivery"),
    ("support agent", "Staff/Support"),
    ("customer care", "Staff/Support"),
    ("no reply", "Staff/Support"),
    ("support", "Staff/Support"),
    ("agent", "Staff/Support"),
]

REVIEW_THRESHOLD = 0.70
RELIABILITY_HIGH_HEALTH = 80
RELIABILITY_HIGH_CONFIDENCE = 0.85
RELIABILITY_LOW_HEALTH = 60
RELIABILITY_LOW_CONFIDENCE = 0.70

SENTIMENT_REASON = "Value '%s' mapped to standard sentiment '%s'"
CATEGORY_REASON = "Value '%s' mapped to standard category '%s'"

# ---------------------------------------------------------------------------
# FIXED VALUES: trend
# ---------------------------------------------------------------------------
TREND_THRESHOLD = 2.0
TREND_NO_DATES = "Insufficient timestamp data to compute trend."
TREND_FEW_WEEKS = "Not enough weekly data points to calculate direction."
TREND_IMPROVING = "Negative sentiment decreased from %s%% to %s%% during the observed period."
TREND_WORSENING = "Negative sentiment increased from %s%% to %s%% during the observed period."
TREND_STABLE = "Negative sentiment remained stable (changed from %s%% to %s%%)."

# ---------------------------------------------------------------------------
# FIXED VALUES: recommendation rules, in rule order
# (rule_no, impact, title, description; %s takes the rule's percentage)
# ---------------------------------------------------------------------------
IMPACT_ORDER = ["Critical", "High", "Medium", "Low"]

REC_DELIVERY = (
    "Perform Logistics Partner Audit & SLA Review", "High",
    "Delivery issues account for %s%% of customer complaints. Management should audit "
    "third-party logistics partners, penalize delayed drops, and establish strict packaging "
    "guidelines to prevent food spills.")
REC_APP = (
    "Mobile App Crash & Checkout Bug Fix", "High",
    "App bugs represent %s%% of complaints. Engineering teams must prioritize solving the "
    "checkout screen freezes, payment gateway failures, and address-saving issues reported in "
    "the latest app release.")
REC_BILLING = (
    "Audit Coupon Application & Double Charges", "Medium",
    "Billing anomalies affect %s%% of complaints. System audits are required for the SAVE50 "
    "coupon application mechanics during checkout, and a payment refund program must reverse "
    "double-deductions promptly.")
REC_SUPPORT = (
    "Retrain Support Staff and Implement Escalation Rules", "Medium",
    "Support issues represent %s%% of tickets. Improve support response SLAs (currently "
    "customers report long hold times) and train agents to avoid boilerplate/copy-paste "
    "replies for urgent refund issues.")
REC_WORSENING = (
    "Urgent Service Recovery Program", "Critical",
    "Customer sentiment is worsening over time, with negative complaints rising. Form an "
    "immediate service recovery team to contact high-value clients who reported negative "
    "delivery and billing experiences.")
REC_STABLE = (
    "Establish Feedback Loops for Category Hotspots", "Low",
    "Sentiment is stable but complaints remain constant. Focus on solving the top category "
    "drivers sequentially to shift sentiment positive.")
REC_CONFLICT = (
    "Review Feedback Rating UI & Sarcasm Filters", "Low",
    "A high contradiction rate (%s%%) exists between customer ratings and text reviews. UI "
    "design should test if users are misclicking star ratings, and the customer success "
    "dashboard should use text analysis to flag complaints instead of relying solely on "
    "star-based alerts.")
REC_GENERIC = (
    "Monitor App Release Performance", "Medium",
    "Maintain regular weekly monitoring of category complaints. App release updates should be "
    "gated by regression testing of payment and map screen elements.")

REC_DELIVERY_OVER = 30.0
REC_APP_OVER = 25.0
REC_BILLING_OVER = 15.0
REC_SUPPORT_OVER = 15.0
REC_CONFLICT_OVER = 8.0

# ---------------------------------------------------------------------------
# FIXED VALUES: executive spotlight templates per category
# ---------------------------------------------------------------------------
SPOTLIGHT = {
    "App Bug": ("App Bug Fixes",
                "Focus engineering effort on crash reports, payment flow stability, and "
                "loading screen failures."),
    "Delivery": ("Courier SLAs",
                 "Review courier SLA compliance and delayed delivery hotspots."),
    "Staff/Support": ("Support Workflows",
                      "Audit customer support workflows, hold times, and response templates "
                      "to improve SLA compliance."),
    "Billing": ("Billing & Refunds",
                "Audit charge mechanisms, billing errors, and payment gateway "
                "double-deductions."),
    "Other": ("General UX & Features",
              "Address general user experience suggestions, logo feedback, and minor "
              "feature requests."),
}
SPOTLIGHT_TOP = 3
CATEGORY_EXAMPLES = 3
CONFLICT_SAMPLE = 5

# ---------------------------------------------------------------------------
# FIXED VALUES: audit action table (issue, action; %s takes a cleaning count)
# ---------------------------------------------------------------------------
AUDIT_ACTIONS = [
    ("Missing Timestamps", "missing_timestamp_count", None,
     "Preserved; parsed dates set to Blank for weekly filters."),
    ("Missing Ratings", "missing_rating_count", None,
     "Preserved; sentiment derived solely from feedback text."),
    ("Duplicate Rows (Exact)", "duplicate_row_count", "exact_duplicates_removed",
     "Removed %s identical rows."),
    ("Duplicate Feedback Text (Near-Duplicates)", "duplicate_feedback_count",
     "normalized_duplicates_removed",
     "Consolidated %s duplicate complaints; mapped to complaint volume counts."),
    ("Empty / Placeholder Feedback", "empty_feedback_count", "empty_removed",
     "Removed %s meaningless comments."),
    ("Invalid Timestamp format", "invalid_timestamp_count", "timestamps_standardized",
     "Standardized %s timestamps to ISO format."),
]
