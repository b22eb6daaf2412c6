"""Column builders: every function here returns a ``Column`` (JVM-side,
codegen-friendly); none touches data."""

from shiftwise.functions.aggregates import (
    count_unless,
    count_where,
    half_hour_mean_sum,
    ratio_of_sums,
    weighted_average,
)
from shiftwise.functions.labels import label_map, relabel
from shiftwise.functions.predicates import (
    changed,
    in_range,
    nullness_changed,
    outside_bounds,
    positive,
    valid_label,
    within_interval,
    within_windows,
)
from shiftwise.functions.temporal import (
    floor_minutes,
    half_hour_floor,
    reporting_week,
    to_date_key,
)

__all__ = [
    "changed", "count_unless", "count_where", "floor_minutes", "half_hour_floor",
    "half_hour_mean_sum", "in_range", "label_map", "nullness_changed",
    "outside_bounds", "positive", "ratio_of_sums", "relabel", "reporting_week",
    "to_date_key", "valid_label", "weighted_average", "within_interval",
    "within_windows",
]
