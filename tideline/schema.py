"""Column names shared by every operator.

A *reading* is one observed price of one product at one entity (a station, a shop, a supplier). All
operators work on these neutral names; the readers in :mod:`tideline.sources` map files onto them.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ("entity", "product")

# Descriptive columns of an entity; one value per key survives (see operators.readings.entity_span).
ATTRIBUTES = ("latitude", "longitude", "postal_code", "road_type", "city", "address")

READING_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("observed_at", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("address", T.StringType()),
    ]
)

STATE_COLUMNS = ("entity", "product", "day", "price", *ATTRIBUTES)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()) if name == "day" else READING_SCHEMA[name]
        for name in STATE_COLUMNS
    ]
)

PANEL_COLUMNS = (
    "entity", "product", "day", "price", "prev_price",
    *ATTRIBUTES,
    "area", "weekday",
    "ref_lag0", "ref_lag1", "ref_lag3", "ref_lag7",
    "ref_diff_1d", "ref_diff_7d", "ref_spread",
    "is_holiday", "before_holiday", "after_holiday",
    "break_zone_a", "break_zone_b", "break_zone_c",
    "days_unchanged", "peer_gap", "rolling_gap",
)

PREDICTION_COLUMNS = (
    "entity", "product", "day", "price", "predicted_price", "predicted_delta", "trend",
    "latitude", "longitude", "postal_code", "city", "address", "area",
)

# The model's 18 inputs: same list for training and scoring.
CATEGORICAL_FEATURES = ("product", "road_type", "area", "weekday")
NUMERIC_FEATURES = (
    "prev_price", "ref_lag0", "ref_diff_1d", "ref_diff_7d", "ref_spread",
    "days_unchanged", "peer_gap", "rolling_gap",
)
FLAG_FEATURES = (
    "is_holiday", "before_holiday", "after_holiday",
    "break_zone_a", "break_zone_b", "break_zone_c",
)

TRENDS = ("down", "stable", "up")
