"""One query per operator group, on whole tables. Keys match ``oracles.SQL``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions import decade_of, label, signed_degrees, wind_category
from stormledger.operators import block_join, duplicate_groups, global_row_id, missing_values
from stormledger.operators.profile import ragged_count
from stormledger.operators.staging import scratch_path, stage
from stormledger.plans import (
    coordinate_check,
    landfall_completeness,
    landfall_fact,
    locate_landfalls,
    max_name_counts,
    max_name_counts_from_dims,
    named_landfalls,
    names_by_storm,
    names_completeness,
    names_dimension,
    open_table,
    parse_name_lines,
    refresh_names,
    states_completeness,
    states_dimension,
    storm_completeness,
    storm_headers,
    storm_stats,
    storm_tracks,
    stored_checks,
    table_paths,
    top_names_by_state,
)
from stormledger.plans.dims import finish_names
from stormledger.sources import (
    fork,
    preview,
    read_name_lines,
    read_states_csv,
    read_states_json,
    read_tables,
    read_track_csv,
    widen,
    wind_scale_table,
    write_json,
    write_partitioned,
)

from .feeds import (
    built,
    customer_states,
    name_lines,
    nation_regions,
    raw_tracks,
    stored,
    table,
    write_all_tables,
    write_track_csv,
    write_track_feed,
)


def wind_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Track points per storm category, with the scale's damage text."""
    counts = (
        storm_stats(raw_tracks(spark, sf))
        .groupBy("storm_category")
        .agg(F.count("*").alias("n"))
    )
    scale = wind_scale_table(spark).withColumnRenamed("category", "storm_category")
    return counts.join(F.broadcast(scale), "storm_category", "left")


def name_lines_parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Name files written, found by pattern, and parsed."""
    path = scratch_path(spark, "names")
    name_lines(spark, sf).write.text(path)
    return finish_names(parse_name_lines(read_name_lines(spark, path, "*.txt"))).withColumnRenamed(
        "count", "name_count"
    )


def name_ids(spark: SparkSession, sf: str) -> DataFrame:
    return names_dimension(name_lines(spark, sf)).withColumnRenamed("count", "name_count")


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Records under lower-case keys, the header among the data, read without naming a key."""
    path = scratch_path(spark, "states")
    records = customer_states(spark, sf).toDF("state", "state_code", "region", "division")
    header = spark.range(1).select(
        F.lit("State").alias("state"),
        F.lit("State Code").alias("state_code"),
        F.lit("Region").alias("region"),
        F.lit("Division").alias("division"),
    )
    write_json(records.unionByName(header), path)
    return states_dimension(read_states_json(spark, path))


def headers(spark: SparkSession, sf: str) -> DataFrame:
    return storm_headers(raw_tracks(spark, sf)).orderBy("header_id")


def details(spark: SparkSession, sf: str) -> DataFrame:
    return storm_stats(raw_tracks(spark, sf))


def code_map(spark: SparkSession, sf: str) -> DataFrame:
    table_ = {"P": "min central pressure", "F": "final"}
    padded = F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))
    return table(spark, sf, "orders").select("o_orderkey", label(padded, table_).alias("label"))


def coords(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = lambda modulus, letter: F.concat(
        F.floor(key % modulus / 10).cast("string"), F.lit("."), (key % 10).cast("string"), letter
    )
    lat = text(900, F.when(F.col("c_acctbal") < 0, "S").otherwise("N"))
    lon = text(1800, F.when(F.col("c_mktsegment") == "MACHINERY", "E").otherwise("W"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        signed_degrees(lat, "N").alias("latitude"),
        signed_degrees(lon, "E").alias("longitude"),
    )


def category(spark: SparkSession, sf: str) -> DataFrame:
    item = table(spark, sf, "lineitem").select(
        F.when(
            F.col("l_linenumber") != 7, F.col("l_quantity").cast("int") + F.col("l_linenumber") * 20
        ).alias("wind"),
        F.when(F.col("l_returnflag") == "R", "tropical storm")
        .when(F.col("l_returnflag") == "A", "disturbance")
        .alias("status"),
    )
    return (
        item.groupBy("wind", "status", wind_category(F.col("wind"), F.col("status")).alias("category"))
        .agg(F.count("*").alias("n"))
    )


def block_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every (header, detail) pair of the overlapping blocks."""
    raw = raw_tracks(spark, sf)
    return block_join(
        storm_headers(raw).select("header_id", "storm_name", "entries"),
        storm_stats(raw).select("stat_id", "max_sustained_wind_kt"),
    )


def track_ids(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_tracks(spark, sf)
    return storm_tracks(storm_headers(raw), storm_stats(raw))


def under_query_names(wide: DataFrame) -> DataFrame:
    fields = [F.col(f"`{c}`").alias(f"field_{c}") for c in wide.columns if c != "_c0"]
    return wide.select(F.col("_c0").cast("bigint").alias("line_id"), *fields)


def track_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Text feed written, its lines indexed, split and written; every field read back by its position."""
    feed = read_tables(spark, stored(write_track_feed, spark, sf, anew=True))
    return under_query_names(widen(feed))


def track_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The feed written as CSV with a header and read back."""
    return under_query_names(read_track_csv(spark, write_track_csv(spark, sf)))


def landfall_points(spark: SparkSession, sf: str) -> DataFrame:
    """Landfalls of named storms with the known state they lie in, before anything is dropped."""
    landfalls = named_landfalls(built(spark, sf, "atlantic_storms"))
    states_ = built(spark, sf, "state_data")
    return locate_landfalls(landfalls, states_, nation_regions(spark, sf)).select(
        "storm_id", "storm_name", "storm_date", "storm_time", "latitude", "longitude", "state"
    )


def landfall_ids(spark: SparkSession, sf: str) -> DataFrame:
    tracks, states_ = built(spark, sf, "atlantic_storms"), built(spark, sf, "state_data")
    return landfall_fact(tracks, states_, nation_regions(spark, sf))


def fact_join(spark: SparkSession, sf: str) -> DataFrame:
    """Names joined with stored landfalls, and numbered."""
    landfalls = built(spark, sf, "storms_with_us_landfall")
    names = names_dimension(name_lines(spark, sf))
    return names_by_storm(names, landfalls, wind_scale_table(spark))


def fact_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Row id in the order of a count kept as text."""
    part = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("name_count"), "p_name"
    )
    return global_row_id(part, ["name_count", "p_name"], "bsn_id").select(
        "bsn_id", "name_count", F.col("name_count").try_cast("int").alias("name_count_int")
    )


def fact_max(spark: SparkSession, sf: str) -> DataFrame:
    """One storm name, year and state; four birth years (the report's shape)."""
    return max_name_counts(
        built(spark, sf, "names_by_person_and_storm"),
        storm_name="HOT RING",
        storm_year=2001,
        state_code="7",
        birth_years=[1903, 1904, 1906, 1910],
    )


def fact_max_storm(spark: SparkSession, sf: str) -> DataFrame:
    """One storm name and year in all states; three birth years."""
    return max_name_counts(
        built(spark, sf, "names_by_person_and_storm"),
        storm_name="HOT BOLT",
        storm_year=1999,
        birth_years=[1906, 1911, 1933],
    )


def fact_max_all_states(spark: SparkSession, sf: str) -> DataFrame:
    """The whole fact, no condition."""
    return max_name_counts(built(spark, sf, "names_by_person_and_storm"))


def fact_max_from_dims(spark: SparkSession, sf: str) -> DataFrame:
    """The same answer without building the fact."""
    landfalls = built(spark, sf, "storms_with_us_landfall")
    names = finish_names(parse_name_lines(name_lines(spark, sf)))
    return max_name_counts_from_dims(landfalls, names)


def missing(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of the events and of the three raw feeds: one row per feed and column."""
    events = table(spark, sf, "events").withColumns(
        {
            "event_type": F.nullif("event_type", F.lit("error")),
            "value": F.when(F.col("value") > 200, float("nan")).otherwise(F.col("value")),
        }
    )
    feeds = {
        "events": events,
        "names": parse_name_lines(name_lines(spark, sf)),
        "states": customer_states(spark, sf),
        "tracks": widen(raw_tracks(spark, sf)),
    }
    parts = []
    for feed, df in feeds.items():
        pairs = [x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`"))]
        counts = F.explode(F.create_map(*pairs)).alias("column_name", "n_missing")
        parts.append(missing_values(df).select(F.lit(feed).alias("feed"), counts))
    return reduce(DataFrame.unionByName, parts)


def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows, all columns, in a feed where some lines came twice."""
    items = table(spark, sf, "lineitem")
    return duplicate_groups(items.unionByName(items.where("l_linenumber = 2")))


def ragged(spark: SparkSession, sf: str) -> DataFrame:
    return ragged_count(widen(raw_tracks(spark, sf), 4), "3")


def check_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Fails as it should: overstated blocks make rows count twice."""
    raw = raw_tracks(spark, sf)
    heads = storm_headers(raw)
    return storm_completeness(raw, heads, block_join(heads, storm_stats(raw).select("stat_id")))


def check_names(spark: SparkSession, sf: str) -> DataFrame:
    """Feed lines against the stored table."""
    return names_completeness(name_lines(spark, sf), built(spark, sf, "names_by_state"))


def check_states(spark: SparkSession, sf: str) -> DataFrame:
    """Fails as it should: customers in debt have lost their code."""
    raw = customer_states(spark, sf)
    debts = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_name").alias("State"), F.lit(True).alias("lost"))
    coded = raw.join(debts, "State", "left").withColumn("State Code", F.when(F.col("lost").isNull(), F.col("State Code")))
    return states_completeness(raw, states_dimension(stage(coded.drop("lost"))))


def check_coords(spark: SparkSession, sf: str) -> DataFrame:
    return coordinate_check(storm_stats(raw_tracks(spark, sf)))


def check_landfall(spark: SparkSession, sf: str) -> DataFrame:
    landfalls = named_landfalls(built(spark, sf, "atlantic_storms"))
    located = locate_landfalls(
        landfalls, built(spark, sf, "state_data"), nation_regions(spark, sf)
    )
    return landfall_completeness(landfalls, located)


def top_names(spark: SparkSession, sf: str) -> DataFrame:
    names = finish_names(parse_name_lines(name_lines(spark, sf)))
    return top_names_by_state(names, 1910, 1940, 3)


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written in one folder per status and year, and read back; the year comes back as int."""
    path = scratch_path(spark, "orders-parquet")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.col("o_orderstatus").alias("state_code"),
        F.date_format("o_orderdate", "yyyy").alias("birth_year"),
    )
    write_partitioned(orders, path, ["state_code", "birth_year"])
    return read_tables(spark, path)


def text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """CSV in another column order, with an extra field in the lines of overdrawn customers -> JSON records -> table."""
    csv, json = scratch_path(spark, "states-csv"), scratch_path(spark, "states-json")
    longer = F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit(",extra"))).otherwise(F.col("c_name"))
    lines = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("Division"),
        F.col("c_custkey").alias("state_code"),
        F.col("c_mktsegment").alias("REGION"),
        longer.alias("State"),
    )
    lines.write.option("quote", "").csv(csv, header=True)  # unquoted: the extra field is one
    write_json(read_states_csv(spark, csv), json)
    return read_states_json(spark, json).withColumnsRenamed(
        {"State": "state", "State Code": "state_code", "Region": "region", "Division": "division"}
    )


def decades(spark: SparkSession, sf: str) -> DataFrame:
    year = F.date_format("o_orderdate", "yyyy")
    return (
        table(spark, sf, "orders").groupBy(decade_of(year).alias("decade")).agg(F.count("*").alias("n"))
    )


def build_all(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job from the raw feeds to written tables; returns the stored fact."""
    out = stored(write_all_tables, spark, sf, anew=True)
    return open_table(spark, out, "names_by_person_and_storm")


def stored_table(name: str, **renamed: str):
    """Query that reads a stored table back whole."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return built(spark, sf, name).withColumnsRenamed(renamed)

    return query


def fact_by_glob(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact, found by a pattern."""
    [path] = table_paths(spark, stored(write_all_tables, spark, sf), "names_by_person_and_storm")
    return read_tables(spark, f"{path.removesuffix('_and_storm_fact.parquet')}*")


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of the fact in a total order, printed and returned."""
    return preview(built(spark, sf, "names_by_person_and_storm").orderBy("bsn_id"), 25)


def stored_scale(spark: SparkSession, sf: str) -> DataFrame:
    """The stored scale next to how many stored track points each category has."""
    points = built(spark, sf, "atlantic_storms").groupBy(F.col("storm_category").alias("category")).agg(F.count("*").alias("n"))
    return built(spark, sf, "wind_scale").join(points, "category", "left")


def build_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What was counted while the tables were written. Storms and coordinates fail as they should."""
    return stored_checks(spark, stored(write_all_tables, spark, sf))


REFRESHED = ["1903", "1911", "1950"]


def write_refreshed(spark: SparkSession, sf: str) -> str:
    """The stored tables with three birth years replaced by feed lines that lack a sex."""
    out = scratch_path(spark, "refreshed")
    fork(spark, stored(write_all_tables, spark, sf), out)
    lines = name_lines(spark, sf).where(F.get(F.split("value", ","), F.lit(1)) != "SMALL")
    refresh_names(spark, out, lines, REFRESHED)
    return out


def refreshed(name: str, **renamed: str):
    """Query that reads a table back after the refresh."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return open_table(spark, stored(write_refreshed, spark, sf), name).withColumnsRenamed(renamed)

    return query


# The first two leave the feed and the tables that the others read; without them, whichever
# query needs these first writes them.
QUERIES = {
    "q_track_ingest": track_ingest,
    "q_build_all": build_all,
    "q_wind_scale": wind_scale,
    "q_name_lines": name_lines_parsed,
    "q_name_ids": name_ids,
    "q_states": states,
    "q_headers": headers,
    "q_details": details,
    "q_code_map": code_map,
    "q_coords": coords,
    "q_category": category,
    "q_block_join": block_pairs,
    "q_track_ids": track_ids,
    "q_landfall": landfall_points,
    "q_landfall_ids": landfall_ids,
    "q_fact_join": fact_join,
    "q_fact_ids": fact_ids,
    "q_fact_max": fact_max,
    "q_fact_max_storm": fact_max_storm,
    "q_fact_max_all_states": fact_max_all_states,
    "q_fact_max_from_dims": fact_max_from_dims,
    "q_missing": missing,
    "q_duplicates": duplicates,
    "q_ragged": ragged,
    "q_check_blocks": check_blocks,
    "q_check_names": check_names,
    "q_check_states": check_states,
    "q_check_coords": check_coords,
    "q_check_landfall": check_landfall,
    "q_top_names": top_names,
    "q_parquet_roundtrip": parquet_roundtrip,
    "q_text_roundtrip": text_roundtrip,
    "q_decades": decades,
    "q_stored_states": stored_table("state_data"),
    "q_stored_headers": stored_table("storm_headers"),
    "q_stored_stats": stored_table("storm_stats"),
    "q_stored_tracks": stored_table("atlantic_storms"),
    "q_stored_names": stored_table("names_by_state", count="name_count"),
    "q_stored_landfalls": stored_table("storms_with_us_landfall"),
    "q_fact_glob": fact_by_glob,
    "q_fact_first": first_rows,
    "q_track_csv": track_csv,
    "q_stored_scale": stored_scale,
    "q_build_checks": build_checks,
    "q_refresh_names": refreshed("names_by_state", count="name_count"),
    "q_refresh_fact": refreshed("names_by_person_and_storm"),
}
