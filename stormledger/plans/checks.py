"""Completeness and plausibility checks: one row each, ``passed`` says how it went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.profile import count_check
from .dims import state_rows


def storm_completeness(raw: DataFrame, headers: DataFrame, tracks: DataFrame) -> DataFrame:
    """Every feed line is a header or a track row."""
    return count_check("storms", [raw], [headers, tracks])


def names_completeness(raw: DataFrame, names: DataFrame) -> DataFrame:
    """Every name line is in the table with a name and a year."""
    return count_check("names", [raw], [names], keys=["birth_name", "birth_year"])


def states_completeness(raw: DataFrame, states: DataFrame) -> DataFrame:
    """Every state record is in the table with a name and a code; a header line among the data is none."""
    return count_check("states", [state_rows(raw)], [states], keys=["state", "state_code"])


def bad_coordinates() -> tuple[Column, Column]:
    """Is a row's latitude, is its longitude absent or off the globe?"""
    bad = lambda c, limit: F.col(c).isNull() | (F.abs(c) > limit)
    return bad("latitude", 90), bad("longitude", 180)


def coordinate_check(tracks: DataFrame) -> DataFrame:
    """Coordinates that are absent or off the globe."""
    latitude, longitude = bad_coordinates()
    return tracks.agg(
        F.count_if(latitude).alias("bad_latitude"), F.count_if(longitude).alias("bad_longitude")
    ).withColumn("passed", (F.col("bad_latitude") == 0) & (F.col("bad_longitude") == 0))


def landfall_completeness(landfalls: DataFrame, located: DataFrame) -> DataFrame:
    """Landfalls in a state and landfalls in none add up to the landfalls before the lookup."""
    before = landfalls.agg(F.count("*").alias("total")).select(
        "total", F.lit(0).alias("in_region"), F.lit(0).alias("no_region")
    )
    after = located.agg(
        F.count("state").alias("in_region"), F.count_if(F.col("state").isNull()).alias("no_region")
    ).select(F.lit(0).alias("total"), "in_region", "no_region")
    sums = before.unionByName(after).agg(
        *(F.sum(c).alias(c) for c in ("total", "in_region", "no_region"))
    )
    return sums.withColumn("passed", F.col("in_region") + F.col("no_region") == F.col("total"))
