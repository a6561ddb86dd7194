"""Named column sets, thresholds and fixed calendar values.

Everything in the block marked FIXED VALUES must equal the values the original
workflow uses so that feature sets, bands and flags mean the same thing.
Every operator takes these as default arguments, so callers can override them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original workflow; stated plainly, in order)
# ---------------------------------------------------------------------------
RAW_NUMERIC = [
    "pickup_lat",
    "pickup_lon",
    "delivery_lat",
    "delivery_lon",
    "distance",
    "weight",
    "market_index",
    "quote_signal",
]
RAW_CATEGORICAL = ["pickup", "delivery", "equipment"]

BASIC_FEATURES = [
    "distance",
    "weight",
    "weight_missing",
    "weight_sign_corrected",
    "market_index",
    "market_index_missing",
    "quote_signal",
    "equipment",
]

DATE_FEATURES = [
    "year",
    "month",
    "quarter",
    "week_of_year",
    "day_of_month",
    "day_of_year",
    "day_of_week",
    "weekend",
    "month_start",
    "month_end",
    "days_since_start",
    "month_sin",
    "month_cos",
    "weekday_sin",
    "weekday_cos",
    "annual_sin",
    "annual_cos",
    "federal_holiday",
    "near_thanksgiving",
    "near_christmas",
]

COMPACT_DATE_FEATURES = [
    "days_since_start",
    "month",
    "day_of_week",
    "day_of_month",
    "week_of_year",
    "weekend",
    "annual_sin",
    "annual_cos",
    "weekday_sin",
    "weekday_cos",
]

ROUTE_FEATURES = [
    "pickup",
    "delivery",
    "route",
    "pickup_equipment",
    "delivery_equipment",
    "route_equipment",
    "pickup_frequency",
    "delivery_frequency",
    "route_frequency",
    "equipment_frequency",
    "pickup_equipment_frequency",
    "delivery_equipment_frequency",
    "route_equipment_frequency",
    "rare_pickup",
    "rare_delivery",
    "rare_route",
    "unseen_pickup",
    "unseen_delivery",
    "unseen_route",
]

# Route features used by the tree learners: the composite strings are dropped.
MODEL_ROUTE_FEATURES = [
    "pickup",
    "delivery",
    "pickup_frequency",
    "delivery_frequency",
    "route_frequency",
    "equipment_frequency",
    "pickup_equipment_frequency",
    "delivery_equipment_frequency",
    "route_equipment_frequency",
    "rare_pickup",
    "rare_delivery",
    "rare_route",
    "unseen_pickup",
    "unseen_delivery",
    "unseen_route",
]

GEOGRAPHIC_FEATURES = [
    "pickup_lat",
    "pickup_lon",
    "delivery_lat",
    "delivery_lon",
    "haversine_distance",
    "distance_haversine_difference",
    "distance_haversine_ratio",
    "latitude_difference",
    "longitude_difference",
    "absolute_latitude_difference",
    "absolute_longitude_difference",
    "midpoint_latitude",
    "midpoint_longitude",
    "bearing_sin",
    "bearing_cos",
    "distance_band",
]

INTERACTION_FEATURES = [
    "log_distance",
    "log_weight",
    "distance_squared_scaled",
    "weight_to_distance",
    "distance_market_index",
    "distance_quote_signal",
    "market_quote_interaction",
    "equipment_distance_band",
]

COMMON_FEATURE_SETS: dict[str, list[str]] = {
    "basic_supplied": BASIC_FEATURES,
    "basic_plus_date": BASIC_FEATURES + DATE_FEATURES,
    "basic_plus_route": BASIC_FEATURES + MODEL_ROUTE_FEATURES,
    "basic_plus_geographic": BASIC_FEATURES + GEOGRAPHIC_FEATURES,
    "basic_plus_interactions": BASIC_FEATURES + INTERACTION_FEATURES,
    "best_combined": BASIC_FEATURES + DATE_FEATURES + MODEL_ROUTE_FEATURES
    + GEOGRAPHIC_FEATURES + INTERACTION_FEATURES,
    "compact_calendar": ["distance", "weight", "equipment", "pickup", "delivery", "log_distance"]
    + COMPACT_DATE_FEATURES,
}

SCENARIO_FEATURE_SETS: dict[str, list[str]] = {
    "december_basic": ["distance", "weight", "equipment", "pickup", "delivery"]
    + COMPACT_DATE_FEATURES + ["log_distance"],
    "december_enriched_geo": ["distance", "weight", "equipment", "pickup", "delivery"]
    + COMPACT_DATE_FEATURES + GEOGRAPHIC_FEATURES + ["log_distance"],
}

CATEGORICAL_FEATURES = {
    "pickup",
    "delivery",
    "equipment",
    "route",
    "pickup_equipment",
    "delivery_equipment",
    "route_equipment",
    "distance_band",
    "equipment_distance_band",
}

# Keys whose training counts become frequency features, in this order.
FREQUENCY_KEYS = [
    "pickup",
    "delivery",
    "route",
    "equipment",
    "pickup_equipment",
    "delivery_equipment",
    "route_equipment",
]
RARE_KEYS = ["pickup", "delivery", "route"]

# Holidays of 2025 (calendar anchors); callers pass their own for other years.
FEDERAL_HOLIDAYS = [
    "2025-01-01",
    "2025-01-20",
    "2025-02-17",
    "2025-05-26",
    "2025-06-19",
    "2025-07-04",
    "2025-09-01",
    "2025-10-13",
    "2025-11-11",
    "2025-11-27",
    "2025-12-25",
]
THANKSGIVING = ["2025-11-27"]
CHRISTMAS = ["2025-12-25"]
NEAR_DATE_DAYS = 2

# Distance bands: (-inf, 250] Short, (250, 800] Medium, (800, 1600] Long, rest Very Long.
DISTANCE_BAND_EDGES = [250.0, 800.0, 1600.0]
DISTANCE_BAND_LABELS = ["Short", "Medium", "Long", "Very Long"]
# Target bands from holdout quantiles 0.25 / 0.75.
TARGET_BAND_QUANTILES = [0.25, 0.75]
TARGET_BAND_LABELS = ["Low", "Medium", "High"]

EARTH_RADIUS_MILES = 3958.7613
RARE_THRESHOLD = 10
ROUTE_SEPARATOR = " > "
COMPOSITE_SEPARATOR = " | "
UNKNOWN = "Unknown"
INNER_HORIZON_DAYS = 61
MIN_SPLIT_ROWS = 1_000
STABILITY_FOLDS = 3
RANDOM_SEED = 42
SHIFT_FLAG_SMD = 0.5
HISTOGRAM_BINS = 45
HISTOGRAM_CAP_QUANTILE = 0.995
SELECTION_TOLERANCE = 1e-12
TARGET = "posted_rate"
ID = "load_id"
PREDICTION = "predicted_rate"

MODEL_FAMILY_A = "AbsoluteBoost"
MODEL_FAMILY_B = "QuantileForest"
BASELINE_FAMILY = "Baseline"

# Boolean spellings accepted by the leaderboard readers.
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]
# ---------------------------------------------------------------------------

LOAD_COLUMNS = [
    "load_id",
    "pickup",
    "delivery",
    "pickup_lat",
    "pickup_lon",
    "delivery_lat",
    "delivery_lon",
    "distance",
    "equipment",
    "weight",
    "date",
    "market_index",
    "quote_signal",
]
SCENARIO_COLUMNS = ["pickup", "delivery", "distance", "equipment", "weight", "date"]
