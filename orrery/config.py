"""Fixed values and default parameters.

The first block holds fixed values that must equal the reference's for the
same results: reject-reason texts, recommender sizes (top 10 per user from
50 candidates = 10 x oversample 5), ALS settings (rank 30, maxIter 15,
regParam 0.05, coldStartStrategy "drop", seed 42), the 80/20 split, the
tag separator ", " (comma then one blank), the unit sentinel "Unknown", the
rating sentinel -1, the 5000-user sample, histogram bin targets (score 40,
catalogue score 30, list size 50, user average 40), the tag ranking (at
least 5 items, first 20), and the dashboard defaults (members > 10000 for
the top 10; catalogue members >= 10000 and score >= 0.0; list size >= 10).
"""

# ---- fixed values (must equal the reference's for the same results) ----
# Reject reasons: prefix + the rule's columns joined by ", ", and the
# foreign-key text "<column> not found in <table>".
REASON_MISSING_PREFIX = "missing required column(s): "
REASON_DUPLICATE_PREFIX = "duplicate key: "
REASON_NOT_FOUND = "{column} not found in {table}"

TOP_N = 10
OVERSAMPLE = 5
ALS_RANK = 30
ALS_MAX_ITER = 15
ALS_REG_PARAM = 0.05
SEED = 42
TRAIN_PERCENT = 80

TAG_SEPARATOR = ", "
UNITS_SENTINEL = "Unknown"
RATING_SENTINEL = -1

SAMPLE_SIZE = 5000
SCORE_BINS = 40
CATALOG_SCORE_BINS = 30
ACTIVITY_BINS = 50
AVERAGE_BINS = 40
TREND_BINS = 10
TAG_MIN_ITEMS = 5
TAG_TOP = 20
TOP_ITEMS = 10
TOP_ITEMS_MIN_MEMBERS = 10000
CATALOG_TOP = 20
CATALOG_MIN_MEMBERS = 10000
CATALOG_MIN_SCORE = 0.0
MIN_REVIEWS = 10
TOP_USERS = 20
TOP_USERS_WITH_RECOS = 10
HISTORY_TOP = 10
USER_TAG_TOP = 15

# ---- parameters (our choices) ----
# Fixture parameters (FIXTURES.md): the excluded tags and the band limits.
# Band limits are parameters; the dashboard's own were 6 and 8.
EXCLUDED_TAGS = ("anvil", "PROMO")
BAND_LIMITS = (5.0, 6.0)

# Registered-query parameters for the catalogue filters.
CATALOG_KINDS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5")
CATALOG_TAGS = ("small", "SMALL")

# Broadcast only sides whose row count is known to be at most this: single
# integer keys (~8 bytes a row) and narrow dimension rows (id + short name).
BROADCAST_MAX_KEY_ROWS = 2_000_000
BROADCAST_MAX_ROWS = 200_000
# Rows of a few numbers that one task counts or sorts (about 150 MB).
TASK_ROWS = 2_000_000

# The user of the registered one-user pages.
ONE_USER = 7
