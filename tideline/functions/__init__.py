from tideline.functions.decisions import (
    actual_label,
    dead_band,
    predicted_price,
    price_change,
    published_delta,
    target_weight,
    trend_label,
)
from tideline.functions.scalars import (
    area_code,
    flag_or_false,
    great_circle_m,
    half_even,
    map_link,
    ref_spread,
    scaled_coordinate,
    units,
    valid_code,
    weekday_index,
)

__all__ = [
    "actual_label", "area_code", "dead_band", "flag_or_false", "great_circle_m", "half_even", "map_link",
    "predicted_price", "price_change", "published_delta", "ref_spread", "scaled_coordinate", "target_weight",
    "trend_label", "units", "valid_code", "weekday_index",
]
