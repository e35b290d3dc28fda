"""Raw feeds in the shapes the library reads, derived from the driver's tables.

* storm tracks: a header line per part, a detail line per line item of the part
* name lines: one per part
* states: nations (for landfalls) or customers (for the state file formats)
* regions: one box per nation, its north-east corner cut off

The track feed and the built tables are written once per application, as the raw
files and the stored tables are that a step of the job reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.operators.staging import scratch_path
from stormledger.plans import build_tables, open_table
from stormledger.sources import read_tables, widen, write_csv, write_track_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hemisphere_text(tenths, letter):
    return F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), letter
    )


def track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` lines, with the columns (``block``, ``kind``) that put them in feed order."""
    part = table(spark, sf_dir, "part")
    item = table(spark, sf_dir, "lineitem")
    text = lambda c: c.cast("string")
    sizes = item.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    overstated = F.when(F.col("p_type") == "SMALL", 2).otherwise(0)
    entries = F.coalesce("n", F.lit(0)) + overstated
    headers = part.join(sizes, "p_partkey", "left").select(
        F.col("p_partkey").alias("block"),
        F.lit(0).alias("kind"),
        F.concat(
            F.lit(" AL"),
            F.lpad(text(F.col("p_partkey") % 100), 2, "0"),
            text(F.col("p_size") + 1900),
            F.lit(" ,  "),
            F.when(F.col("p_type") == "STANDARD", "UNNAMED").otherwise(F.col("p_name")),
            F.lit(", "),
            text(entries),
            F.lit(","),
        ).alias("value"),
    )
    qty = F.col("l_quantity").cast("bigint")
    line = F.col("l_linenumber")
    status = F.element_at(F.array(*map(F.lit, ["HU", "TS", "EX", "TD", "LO", "WV", "XX"])), line)
    flags = F.concat("l_returnflag", "l_linestatus")
    record = (
        F.when((flags == "RF") & (F.col("l_tax") >= 0.07), "L")
        .when(F.col("l_returnflag") == "N", "I")
        .when(flags == "AF", "Z")
        .otherwise("")
    )
    lat = (F.col("l_suppkey") * 37 + F.col("l_partkey") * 11 + qty * 53) % 900
    lon = (F.col("l_partkey") * 29 + F.col("l_suppkey") * 7 + qty * 101) % 1900
    details = item.select(
        F.col("l_partkey").alias("block"),
        F.lit(1).alias("kind"),
        F.concat_ws(
            ", ",
            F.date_format("l_shipdate", "yyyyMMdd"),
            F.lpad(text(line * 300), 4, "0"),
            record,
            status,
            _hemisphere_text(lat, F.when(F.col("l_discount") >= 0.08, "S").otherwise("N")),
            _hemisphere_text(lon, F.when(F.col("l_discount") <= 0.01, "W").otherwise("E")),
            F.when(line == 7, "n/a")
            .when(line == 4, F.concat(text(qty + line * 20), F.lit(".0")))
            .otherwise(text(qty + line * 20)),
            F.when(F.col("l_discount") == 0, "-999").otherwise(text(qty + 880)),
            # wind radii and more: some lines are longer than the published width
            F.when(line == 5, ", ".join(str(i) for i in range(9, 26))),
        ).alias("value"),
    )
    return headers.unionByName(details)


def blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of nothing but blanks after the details of every seventh part; no reader counts them."""
    part = table(spark, sf_dir, "part").where("p_partkey % 7 = 0")
    return part.select(F.col("p_partkey").alias("block"), F.lit(2).alias("kind"), F.lit("  \t ").alias("value"))


def write_track_text(spark: SparkSession, sf_dir: str) -> str:
    """The feed as text files, in feed order."""
    text = scratch_path(spark, "tracks-text")
    every = track_lines(spark, sf_dir).unionByName(blank_lines(spark, sf_dir))
    every.orderBy("block", "kind", "value").select("value").write.text(text)
    return text


def write_track_feed(spark: SparkSession, sf_dir: str) -> str:
    """The text's lines, numbered and split. Returns the path of the Parquet."""
    feed = scratch_path(spark, "tracks")
    write_track_lines(spark, stored(write_track_text, spark, sf_dir, anew=True), feed)
    return feed


def write_track_csv(spark: SparkSession, sf_dir: str) -> str:
    """The numbered feed as CSV, as wide as its longest line. Returns the path."""
    csv = scratch_path(spark, "tracks-csv")
    write_csv(widen(raw_tracks(spark, sf_dir)), csv)
    return csv


_written: dict[tuple, str] = {}


def stored(make, spark: SparkSession, sf_dir: str, anew: bool = False) -> str:
    """Path of what ``make`` writes; later calls in the same application get the same path.

    ``anew``: write it again, and hand that out from now on.
    """
    key = (make.__name__, spark.sparkContext.applicationId, sf_dir)
    if anew or key not in _written:
        _written[key] = make(spark, sf_dir)
    return _written[key]


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored track feed."""
    return read_tables(spark, stored(write_track_feed, spark, sf_dir))


def write_all_tables(spark: SparkSession, sf_dir: str) -> str:
    """The whole job. Returns the folder of the tables."""
    out = scratch_path(spark, "tables")
    build_tables(
        spark,
        raw_tracks(spark, sf_dir),
        name_lines(spark, sf_dir),
        nation_states(spark, sf_dir),
        nation_regions(spark, sf_dir),
        out,
    )
    return out


def built(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table."""
    return open_table(spark, stored(write_all_tables, spark, sf_dir), name)


def name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = (F.col("p_size") + 1900).cast("string")
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        F.concat_ws(",", "p_brand", "p_type", year, "p_name", key).alias("value")
    )


def nation_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known states: nations outside AFRICA."""
    region = table(spark, sf_dir, "region").where(F.col("r_name") != "AFRICA")
    nation = table(spark, sf_dir, "nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("State"),
        F.col("n_nationkey").cast("string").alias("State Code"),
        F.col("r_name").alias("Region"),
        F.col("n_nationkey").cast("string").alias("Division"),
    )


def customer_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("State"),
        F.col("c_custkey").cast("string").alias("State Code"),
        F.col("c_mktsegment").alias("Region"),
        F.col("c_nationkey").cast("string").alias("Division"),
    )


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of 18 x 36 degrees without their corner beyond 2 * dlat + dlon = 60.05."""
    south = F.floor(F.col("n_nationkey") / 5) * 18
    west = (F.col("n_nationkey") % 5) * 36
    corners = [(0, 0), (0, 36), (12.025, 36), (18, 24.05), (18, 0)]
    vertex = lambda dlat, dlon: F.struct(
        (south + F.lit(float(dlat))).alias("lat"), (west + F.lit(float(dlon))).alias("lon")
    )
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("state"), F.array(*(vertex(*c) for c in corners)).alias("ring")
    )
