from .analytics import (
    FACT_REPORTS,
    max_name_counts,
    max_name_counts_from_dims,
    prepare_fact,
    top_names_by_state,
)
from .build import TABLE_PATHS, build_tables, open_table, refresh_names, stored_checks, table_paths
from .checks import (
    coordinate_check,
    landfall_completeness,
    names_completeness,
    states_completeness,
    storm_completeness,
)
from .dims import (
    names_dimension,
    parse_name_lines,
    states_dimension,
    storm_headers,
    storm_stats,
    storm_tracks,
    with_schema,
)
from .facts import landfall_fact, locate_landfalls, named_landfalls, names_by_storm

__all__ = [
    "FACT_REPORTS",
    "TABLE_PATHS",
    "build_tables",
    "coordinate_check",
    "landfall_completeness",
    "landfall_fact",
    "locate_landfalls",
    "max_name_counts",
    "max_name_counts_from_dims",
    "named_landfalls",
    "names_by_storm",
    "names_completeness",
    "names_dimension",
    "parse_name_lines",
    "open_table",
    "prepare_fact",
    "refresh_names",
    "states_completeness",
    "states_dimension",
    "storm_completeness",
    "storm_headers",
    "storm_stats",
    "storm_tracks",
    "stored_checks",
    "table_paths",
    "top_names_by_state",
    "with_schema",
]
