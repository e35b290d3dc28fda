"""Schemas, code tables and the wind scale.

Row ids, line indexes and entry counts are bigint: an int stops at 2.1 billion lines.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


# ---------------------------------------------------------------- fixed values
# Storm status codes.
STATUS_LABELS = {
    "HU": "hurricane",
    "TS": "tropical storm",
    "EX": "extratropical cyclone",
    "TD": "tropical depression",
    "LO": "low pressure system",
    "DB": "disturbance",
    "SD": "subtropical depression",
    "SS": "subtropical storm",
    "WV": "tropical wave",
}

# Record identifier codes. A blank code stays blank.
RECORD_LABELS = {
    "": "",
    "L": "landfall",
    "R": "intensity details with rapid changes",
    "I": "pressure and wind intensity peak",
    "P": "min central pressure",
    "T": "clarify track detail",
    "W": "max sustained wind speed",
    "C": "approach to coast, no landfall",
    "S": "status change in system",
    "G": "genesis of the system",
}

# Wind scale: category, lowest and highest sustained wind in knots, damage text.
WIND_SCALE = [
    ("1", 64, 82, "Power outages that could last a few to several days."),
    (
        "2",
        83,
        95,
        "Near-total power loss is expected with outages that could last from several days to weeks.",
    ),
    (
        "3-MAJOR",
        96,
        112,
        "Electricity and water will be unavailable for several days to weeks after the storm passes.",
    ),
    (
        "4-MAJOR",
        113,
        136,
        "Catastrophic damage will occur; most of the area will be uninhabitable for weeks or months.",
    ),
    (
        "5-MAJOR",
        137,
        1000000,
        "Catastrophic damage will occur; most of the area will be uninhabitable for weeks or months.",
    ),
]

HEADER_MARKER = "AL"
UNNAMED_MARKER = "UNNAMED"
LANDFALL_LABEL = "landfall"
TRACK_WIDTH = 21


WIND_SCALE_SCHEMA = _struct(
    ("category", StringType()),
    ("min_sustained_wind_kt", LongType()),
    ("max_sustained_wind_kt", LongType()),
    ("brief_damage_description", StringType()),
)

# Published form of the stats table: the line index as text, category under its short name.
STORM_STATS_SCHEMA = _struct(
    ("index", StringType()),
    ("storm_date", DateType()),
    ("storm_year", IntegerType()),
    ("storm_month", IntegerType()),
    ("storm_day", IntegerType()),
    ("storm_time", StringType()),
    ("record_identifier", StringType()),
    ("storm_status", StringType()),
    ("category", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("max_sustained_wind_kt", IntegerType()),
    ("min_pressure_mbar", IntegerType()),
)

NAMES_SCHEMA = _struct(
    ("name_id", LongType()),
    ("birth_name", StringType()),
    ("birth_year", StringType()),
    ("state_code", StringType()),
    ("sex", StringType()),
    ("count", StringType()),
    ("decade", IntegerType()),
)

# ------------------------------------------------------------ end fixed values

# A region is one or more rings; a name with several rows has several parts.
REGION_SCHEMA = _struct(
    ("state", StringType()),
    ("ring", ArrayType(_struct(("lat", DoubleType()), ("lon", DoubleType())))),
)


def text_schema(names: list[str]) -> StructType:
    """All text, under these names."""
    return _struct(*((name, StringType()) for name in names))
