"""Dimension tables: DataFrames in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import (
    clean_int,
    decade_of,
    field,
    label,
    signed_degrees,
    text_date,
    wind_category,
)
from ..operators.blocks import block_join
from ..operators.row_ids import global_row_id, scan_position
from ..schemas import HEADER_MARKER, RECORD_LABELS, STATUS_LABELS, WIND_SCALE
from ..sources.tracks import feed_field

NAME_COLUMNS = ["name_id", "birth_name", "birth_year", "state_code", "sex", "count", "decade"]
TRACK_COLUMNS = [
    "storm_id",
    "basin",
    "atcf_cyclone_num",
    "storm_name",
    "storm_date",
    "storm_year",
    "storm_time",
    "record_identifier",
    "storm_status",
    "storm_category",
    "latitude",
    "longitude",
    "max_sustained_wind_kt",
    "min_pressure_mbar",
]


def with_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Apply names and types by position."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for {len(schema.fields)} fields")
    return df.select(
        *(F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields))
    )


def parse_name_lines(lines: DataFrame) -> DataFrame:
    """``value`` lines -> text fields. The name keeps its spelling; short lines give NULLs."""
    parts = F.split("value", ",")
    names = ["state_code", "sex", "birth_year", "birth_name", "count"]
    return lines.select(*(field(parts, i).alias(name) for i, name in enumerate(names)))


def finish_names(names: DataFrame) -> DataFrame:
    return names.withColumns(
        {"decade": decade_of(F.col("birth_year")), "birth_name": F.upper("birth_name")}
    )


def names_dimension(lines: DataFrame, years: list[str] | None = None, first_id: int = 1) -> DataFrame:
    """Names by state, numbered from ``first_id`` by birth year, state and the name as spelled.

    ``lines`` comes straight from a file scan: equal lines are told apart by their place. ``years``: only lines of
    these birth years count.
    """
    parsed = parse_name_lines(lines).withColumn("__place", scan_position())
    if years is not None:
        parsed = parsed.where(F.col("birth_year").isin(years))
    order = ["birth_year", "state_code", "birth_name", "sex", "count", "__place"]
    return finish_names(global_row_id(parsed, order, "name_id", first_id)).select(*NAME_COLUMNS)


def state_rows(raw: DataFrame) -> DataFrame:
    """State records under their column names, without a header line that came along as data."""
    renamed = raw.withColumnsRenamed(
        {"State": "state", "State Code": "state_code", "Region": "region", "Division": "division"}
    )
    is_header = (F.lower("state") == "state") & F.lower("state_code").isin("state code", "state_code")
    return renamed.where(~F.coalesce(is_header, F.lit(False)))


def states_dimension(raw: DataFrame) -> DataFrame:
    """State table, numbered by name and code."""
    placed = state_rows(raw).withColumn("__place", scan_position())
    order = ["state", "state_code", "region", "division", "__place"]
    return global_row_id(placed, order, "state_id").select(
        "state_id", "state_code", "state", "region", "division"
    )


def storm_headers(raw: DataFrame, marker: str = HEADER_MARKER) -> DataFrame:
    """Header lines of the track feed (``_c0`` and its fields, see ``sources.feed_field``)."""
    storm_id = F.trim(feed_field(raw, 0))
    return (
        raw.where(feed_field(raw, 0).contains(marker))
        .select(
            clean_int(F.col("_c0").cast("string"), "bigint").alias("header_id"),
            storm_id.alias("storm_id"),
            F.trim(F.upper(feed_field(raw, 1))).alias("storm_name"),
            clean_int(feed_field(raw, 2), "bigint").alias("entries"),
            F.substring(storm_id, 1, 2).alias("basin"),
            F.substring(storm_id, 3, 2).try_cast("int").alias("atcf_cyclone_num"),
            F.substring(storm_id, 5, 8).try_cast("int").alias("storm_year"),
        )
        .dropDuplicates()
    )


def storm_stats(raw: DataFrame, marker: str = HEADER_MARKER, scale=WIND_SCALE) -> DataFrame:
    """Detail lines of the track feed: parsed, labelled and categorised."""
    field_ = lambda i: feed_field(raw, i)
    parsed = raw.where(~field_(0).contains(marker)).select(
        clean_int(F.col("_c0").cast("string"), "bigint").alias("stat_id"),
        text_date(field_(0)).alias("storm_date"),
        F.trim(field_(1)).alias("storm_time"),
        label(field_(2), RECORD_LABELS).alias("record_identifier"),
        label(field_(3), STATUS_LABELS).alias("storm_status"),
        signed_degrees(field_(4), "N").alias("latitude"),
        signed_degrees(field_(5), "E").alias("longitude"),
        clean_int(field_(6)).alias("max_sustained_wind_kt"),
        clean_int(field_(7)).alias("min_pressure_mbar"),
    )
    return parsed.select(
        "stat_id",
        "storm_date",
        F.year("storm_date").alias("storm_year"),
        F.month("storm_date").alias("storm_month"),
        F.dayofmonth("storm_date").alias("storm_day"),
        "storm_time",
        "record_identifier",
        "storm_status",
        wind_category(F.col("max_sustained_wind_kt"), F.col("storm_status"), scale).alias(
            "storm_category"
        ),
        "latitude",
        "longitude",
        "max_sustained_wind_kt",
        "min_pressure_mbar",
    )


def join_tracks(headers: DataFrame, stats: DataFrame) -> DataFrame:
    """Detail rows with their storm. The year is the detail's own, not the header's."""
    return block_join(headers.drop("storm_year"), stats)


def storm_tracks(headers: DataFrame, stats: DataFrame) -> DataFrame:
    """Track table, numbered by storm id (then by header and line)."""
    joined = join_tracks(headers, stats).select(*TRACK_COLUMNS, "header_id", "stat_id")
    order = ["storm_id", "header_id", "stat_id"]
    return global_row_id(joined, order, "atl_id", costly=True).select("atl_id", *TRACK_COLUMNS)
