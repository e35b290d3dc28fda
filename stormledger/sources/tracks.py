"""Storm tracks: header and detail lines of different lengths in one feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import field
from ..operators.row_ids import number_lines
from ..operators.staging import staging_area
from ..schemas import TRACK_WIDTH, text_schema


def feed_field(feed: DataFrame, position: int) -> Column:
    """A field of a track feed in either form: an array ``fields``, or columns ``0``, ``1``, ...; NULL if absent or empty."""
    if "fields" in feed.columns:
        return F.nullif(field(F.col("fields"), position), F.lit(""))
    return F.col(f"`{position}`")


def read_track_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw track text -> ``_c0`` (line index) and ``fields``, an array as long as its line.

    Fields are read by position when they are asked for, so no pass over the feed looks for its longest line, and
    lines may have any number of fields.
    """
    return number_lines(spark.read.text(path)).select("_c0", F.split("value", ",").alias("fields"))


def write_track_lines(spark: SparkSession, path: str, to: str) -> None:
    """:func:`read_track_lines`, written as Parquet; no other copy of the lines stays."""
    with staging_area():
        read_track_lines(spark, path).write.mode("overwrite").parquet(to)


def widest(feed: DataFrame) -> int:
    """Fields of the longest line; never fewer than the published ``TRACK_WIDTH``."""
    return max(TRACK_WIDTH, feed.agg(F.max(F.size("fields"))).first()[0] or 0)


def widen(feed: DataFrame, width: int | None = None) -> DataFrame:
    """``fields`` -> columns ``0`` .. ``width-1``, for files with a header; without a ``width`` the feed is read once for its longest line.

    Absent and empty fields are NULL. An empty field in a CSV file reads back as NULL, so both forms agree.
    """
    others = [c for c in feed.columns if c != "fields"]
    positions = range(width or widest(feed))
    return feed.select(*others, *(feed_field(feed, i).alias(str(i)) for i in positions))


def split_lines(lines: DataFrame, width: int | None = None) -> DataFrame:
    """``value`` -> text columns ``0`` .. ``width-1``."""
    others = [c for c in lines.columns if c != "value"]
    return widen(lines.select(*others, F.split("value", ",").alias("fields")), width)


def ingest_track_lines(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    """Raw track text -> ``_c0`` (line index) and text fields; the form :func:`read_track_csv` reads."""
    return widen(read_track_lines(spark, path), width)


def read_track_csv(spark: SparkSession, path: str) -> DataFrame:
    """Text columns under the names of the file's header. A file with another header raises."""
    names = spark.read.csv(path, header=True).columns
    return spark.read.schema(text_schema(names)).csv(path, header=True, enforceSchema=False)
