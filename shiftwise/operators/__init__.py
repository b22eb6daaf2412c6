"""DataFrame operators: DataFrames (+ column names) in, lazy DataFrame out."""

from shiftwise.operators.bounds import (
    duplicate_keys,
    exclude_windows,
    rows_outside_stage,
    stage_bounds,
)
from shiftwise.operators.combine import backfill, enrich, full_outer_chain, union_canonical
from shiftwise.operators.ranking import latest_per_key
from shiftwise.operators.reshape import (
    explode_list,
    project_schema,
    slot_columns,
    unpack_payload,
    unpivot_slots,
)
from shiftwise.operators.rollup import half_hour_sum, reaggregate_half_hour, two_level_count
from shiftwise.operators.sync import new_rows, sync
from shiftwise.operators.validity import validity_join

__all__ = [
    "backfill", "duplicate_keys", "enrich", "exclude_windows", "explode_list", "full_outer_chain",
    "half_hour_sum", "latest_per_key", "new_rows", "project_schema",
    "reaggregate_half_hour", "rows_outside_stage", "slot_columns", "stage_bounds",
    "sync", "two_level_count", "union_canonical", "unpack_payload", "unpivot_slots",
    "validity_join",
]
