"""Word lists, thresholds, labels and weights that results depend on."""

from __future__ import annotations

UNKNOWN = "unknown"
NO_DESCRIPTION = "NO_DESCRIPTION"
MASKED = "MASKED"

# Accepted spellings of a status and what each one means.
STATUS_WORDS = {
    "pending": "pending",
    "pend": "pending",
    "approved": "approved",
    "approve": "approved",
    "approved_": "approved",
    "closed": "approved",
    "denied": "denied",
    "deny": "denied",
    "rejected": "denied",
    "rejected_review": "under_review",
    "under review": "under_review",
    "under_review": "under_review",
    "in_review": "under_review",
    "review": "under_review",
}

# Accepted spellings of a claim type and what each one means.
CLAIM_TYPE_WORDS = {
    "auto": "auto",
    "automobile": "auto",
    "vehicle": "auto",
    "car": "auto",
    "home": "home",
    "homeowner": "home",
    "house": "home",
    "property": "home",
    "health": "health",
    "medical": "health",
    "life": "life",
    "disability": "disability",
    "disab": "disability",
    "dis": "disability",
}

STATUSES = (*sorted(set(STATUS_WORDS.values())), UNKNOWN)
CLAIM_TYPES = (*sorted(set(CLAIM_TYPE_WORDS.values())), UNKNOWN)

# Amount categories, as (exclusive upper bound, label); the last is open.
AMOUNT_CATEGORIES = ((1000.0, "small"), (10000.0, "medium"), (None, "large"))

# Resolution-time buckets, as (lower bound excluded, upper bound included, label).
# Zero and negative durations belong to no bucket.
RESOLUTION_BUCKETS = (
    (0, 7, "0-7 days"),
    (7, 14, "8-14 days"),
    (14, 30, "15-30 days"),
    (30, 60, "31-60 days"),
    (60, 90, "61-90 days"),
    (90, None, "90+ days"),
)

# The coarse split, as (upper bound included, label), and the label for open claims.
RESOLUTION_SPLIT = ((7, "0-7_DAYS"), (30, "8-30_DAYS"), (None, "30+_DAYS"))
UNRESOLVED = "PENDING"

# Risk score weights, in tenths.
RISK_HIGH_AMOUNT = 4
RISK_LONG_RESOLUTION = 3
RISK_CLAIM_TYPES = {"auto": 2, "home": 1}

HIGH_VALUE_THRESHOLD = 20000.0
LARGE_AMOUNT_FACTOR = 1.5
RETENTION_TOLERANCE = 0.95
NULL_PERCENT_KEYS = 10.0
NULL_PERCENT_OTHER = 20.0
TRANSFORMATION_VERSION = "1.0"

# Cell texts that a data-frame CSV reader takes as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters counted as blank at the ends of a text and between words.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
