from .names import read_name_lines
from .regions import read_regions
from .sinks import in_ranges, preview, write_csv, write_json, write_partitioned, write_table
from .states import read_states_csv, read_states_json
from .store import expire, fork
from .tables import read_tables, wind_scale_table
from .tracks import feed_field, ingest_track_lines, read_track_csv, read_track_lines, split_lines, widen, write_track_lines

__all__ = [
    "expire",
    "feed_field",
    "fork",
    "ingest_track_lines",
    "preview",
    "read_name_lines",
    "read_regions",
    "read_states_csv",
    "read_states_json",
    "read_tables",
    "read_track_csv",
    "read_track_lines",
    "split_lines",
    "widen",
    "wind_scale_table",
    "write_csv",
    "write_json",
    "in_ranges",
    "write_partitioned",
    "write_table",
    "write_track_lines",
]
