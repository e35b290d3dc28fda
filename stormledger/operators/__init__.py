from .blocks import block_join
from .joins import bounded_broadcast, skew_safe_join
from .profile import count_check, duplicate_groups, missing_values, ragged_rows
from .regions import box_regions, locate_points
from .row_ids import global_row_id, number_lines
from .staging import discard, stage, staging_area

__all__ = [
    "block_join",
    "bounded_broadcast",
    "box_regions",
    "count_check",
    "discard",
    "duplicate_groups",
    "global_row_id",
    "locate_points",
    "missing_values",
    "number_lines",
    "ragged_rows",
    "skew_safe_join",
    "stage",
    "staging_area",
]
