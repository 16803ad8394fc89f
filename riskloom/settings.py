"""Fixed values that results depend on.  Everything else is a parameter."""

from __future__ import annotations

# --- fixed values: constants, column lists and thresholds of the data contract ---

EARTH_RADIUS_KM = 6371.0088
SECONDS_PER_YEAR = 365.25 * 86400.0

TRAIN_FRACTION = 0.70
VAL_FRACTION = 0.15

ENCODING_SMOOTHING = 20
ENCODING_FOLDS = 5
ENCODED_COLUMNS = ("merchant", "category", "state", "job")

ROLLING_WINDOWS_SECONDS = {"1h": 3_600, "24h": 86_400, "7d": 604_800}

OPERATING_THRESHOLD = 0.6642
COST_THRESHOLD = 0.52
COST_PER_FALSE_POSITIVE = 5.0
TOP_FRACTION = 0.01
LIFT_FRACTIONS = (0.01, 0.05, 0.10)
MIN_LIFT_OVER_BASE_RATE = 5.0
PUBLISHED_BASE_RATE = 0.0058
DISPLAY_RANGE = (0.30, 0.70)
LOGIT_CLIP = 1e-6

SEGMENT_MIN_ROWS = 50
SEGMENT_MIN_POSITIVES = 5
WEAK_SEGMENT_MARGIN = 0.10

APPROVE_BELOW = 0.30
BLOCK_FROM = 0.85

PSI_ALERT = 0.2
FAIRNESS_MIN_ROWS = 100
FAIRNESS_RATIO = {"state": 2.0, "age_group": 1.5, "category": 2.0}

RAW_COLUMNS = (
    "Unnamed: 0", "trans_date_trans_time", "cc_num", "merchant", "category", "amt",
    "first", "last", "gender", "street", "city", "state", "zip", "lat", "long",
    "city_pop", "job", "dob", "trans_num", "unix_time", "merch_lat", "merch_long",
    "is_fraud", "merch_zipcode",
)

FEATURE_COLUMNS = (
    "log1p_amt", "amt_gt_p95_legit",
    "hour", "dow", "is_night", "hour_sin", "hour_cos",
    "age",
    "time_since_last_tx", "dist_consecutive_km", "velocity_kmh",
    "rolling_count_1h", "rolling_amt_sum_1h", "rolling_amt_mean_1h", "rolling_amt_std_1h",
    "rolling_count_24h", "rolling_amt_sum_24h", "rolling_amt_mean_24h", "rolling_amt_std_24h",
    "rolling_count_7d", "rolling_amt_sum_7d", "rolling_amt_mean_7d", "rolling_amt_std_7d",
    "te_merchant", "te_category", "te_state", "te_job",
)

# The first eight features come from the row itself and always exist.
REQUIRED_FEATURES = FEATURE_COLUMNS[:8]
NULLABLE_FEATURES = FEATURE_COLUMNS[8:]

TARGET = "is_fraud"
SPLITS = ("train", "val", "test")

AGE_BUCKETS = ((0, 25, "<25"), (25, 35, "25-35"), (35, 50, "35-50"), (50, 65, "50-65"), (65, 120, "65+"))
POPULATION_BUCKETS = (
    (0, 1_000, "<1k"), (1_000, 10_000, "1k-10k"), (10_000, 100_000, "10k-100k"),
    (100_000, 1_000_000, "100k-1M"), (1_000_000, 50_000_000, "1M+"),
)
