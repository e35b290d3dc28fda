"""The whole job on the literal fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fixtures import BOXES, NAME_LINES, STATES_CSV, TRACK_LINES
from helpers import rows
from stormledger.operators import block_join, box_regions
from stormledger.plans import (
    FACT_REPORTS,
    TABLE_PATHS,
    build_tables,
    coordinate_check,
    landfall_completeness,
    locate_landfalls,
    max_name_counts,
    max_name_counts_from_dims,
    named_landfalls,
    names_completeness,
    open_table,
    states_completeness,
    storm_completeness,
    storm_headers,
    storm_stats,
)
from stormledger.sources import (
    ingest_track_lines,
    read_name_lines,
    read_states_csv,
    read_states_json,
    read_tables,
    read_track_csv,
    write_csv,
    write_json,
)


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    (root / "tracks.txt").write_text(TRACK_LINES)
    (root / "names" / "by_state").mkdir(parents=True)
    (root / "names" / "by_state" / "LA.TXT").write_text("".join(NAME_LINES.splitlines(True)[:2]))
    (root / "names" / "by_state" / "TX.TXT").write_text("".join(NAME_LINES.splitlines(True)[2:]))
    (root / "names" / "by_state" / "readme.pdf").write_text("not,a,name,file,1\n")
    (root / "states.csv").write_text(STATES_CSV)
    write_csv(ingest_track_lines(spark, str(root / "tracks.txt")), str(root / "tracks_csv"))
    write_json(read_states_csv(spark, str(root / "states.csv")), str(root / "states_json"))
    boxes = spark.createDataFrame(BOXES, "name string, s double, n double, w double, e double")
    return {
        "tracks": read_track_csv(spark, str(root / "tracks_csv")),
        "names": read_name_lines(spark, str(root / "names")),
        "states": read_states_json(spark, str(root / "states_json")),
        "regions": box_regions(boxes, "name", "s", "n", "w", "e"),
        "out": str(root / "out"),
    }


@pytest.fixture(scope="module")
def tables(spark, feeds):
    build_tables(
        spark, feeds["tracks"], feeds["names"], feeds["states"], feeds["regions"], feeds["out"]
    )
    return {name: open_table(spark, feeds["out"], name) for name in TABLE_PATHS}


def test_headers(tables):
    assert rows(tables["storm_headers"]) == [
        (0, "AL012001", "ALLISON", 4, "AL", 1, 2001),
        (5, "AL022001", "UNNAMED", 1, "AL", 2, 2001),
        (7, "AL032001", "IRIS", 4, "AL", 3, 2001),
        (10, "AL042001", "NOEL", 1, "AL", 4, 2001),
    ]


def test_stats(feeds):
    stats = storm_stats(feeds["tracks"])
    got = rows(stats.drop("storm_year", "storm_month", "storm_day"))
    td, ts, hu = "tropical depression", "tropical storm", "hurricane"
    assert got == [
        (1, dt.date(2001, 12, 31), "1800", "", td, td, 27.5, -94.0, 30, 1004),
        (2, dt.date(2001, 12, 31), "2300", "landfall", ts, ts, 29.9, -95.0, 63, 1000),
        (3, dt.date(2002, 1, 1), "0000", "landfall", hu, "1", 30.0, -91.0, 64, 990),
        (4, dt.date(2002, 1, 1), "0600", None, None, None, -10.0, 20.0, -99, -999),
        (6, dt.date(2001, 7, 1), "0000", "landfall", hu, "2", 28.0, -90.0, 83, 970),
        (8, dt.date(2001, 10, 8), "0000", "", hu, "4-MAJOR", 17.0, -88.0, 113, 950),
        (9, dt.date(2001, 10, 9), "0000", "landfall", hu, "5-MAJOR", 16.5, -88.5, 137, 940),
        (11, dt.date(2001, 11, 5), "0000", "", hu, "3-MAJOR", 35.0, -50.0, 96, 980),
    ]
    assert rows(stats, "stat_id", "storm_year", "storm_month", "storm_day")[0] == (1, 2001, 12, 31)


def test_published_stats_schema(tables):
    first = tables["storm_stats"].orderBy("index").first()
    assert first["index"] == "1" and first["category"] == "tropical depression"
    assert tables["storm_stats"].columns[:2] == ["index", "storm_date"]


def test_tracks(tables):
    got = rows(tables["atlantic_storms"], "atl_id", "storm_name", "max_sustained_wind_kt", "storm_year")
    assert got == [
        (1, "ALLISON", 30, 2001),
        (2, "ALLISON", 63, 2001),
        (3, "ALLISON", 64, 2002),
        (4, "ALLISON", -99, 2002),
        (5, "UNNAMED", 83, 2001),
        (6, "IRIS", 113, 2001),
        (7, "IRIS", 137, 2001),
        (8, "IRIS", 96, 2001),
        (9, "NOEL", 96, 2001),
    ]


def test_names(tables):
    assert rows(tables["names_by_state"]) == [
        (1, "ALLISON", "2000", "LA", "F", "9", 2000),
        (2, "ALLISON", "2001", "LA", "F", "10", 2000),
        (3, "ALLISON", "2001", "TX", "M", "7", 2000),
        (4, "IRIS", "2001", "TX", "F", "12", 2000),
    ]


def test_states(tables):
    assert rows(tables["state_data"]) == [
        (1, "LA", "Louisiana", "South", "West South Central"),
        (2, "TX", "Texas", "South", "West South Central"),
    ]


def test_landfalls(tables):
    assert rows(tables["storms_with_us_landfall"]) == [
        (1, "AL012001", "ALLISON", 2001, "tropical storm", "tropical storm", "TX"),
        (2, "AL012001", "ALLISON", 2002, "hurricane", "1", "LA"),
    ]


def test_fact(tables, feeds, spark):
    fact = tables["names_by_person_and_storm"]
    got = rows(fact, "bsn_id", "swl_id", "name_id", "name_count", "baby_birth_year", "state_code")
    assert got == [
        (1, 1, 2, "10", "2001", "TX"),
        (2, 2, 2, "10", "2001", "LA"),
        (3, 1, 3, "7", "2001", "TX"),
        (4, 2, 3, "7", "2001", "LA"),
        (5, 1, 1, "9", "2000", "TX"),
        (6, 2, 1, "9", "2000", "LA"),
    ]
    damage = dict(rows(fact, "swl_id", "storm_damage_description"))
    assert damage == {1: None, 2: "Power outages that could last a few to several days."}
    again = read_tables(spark, feeds["out"] + "/versions/*/*/names_by_person_and_storm_fact.parquet")
    assert rows(again.select(*fact.columns)) == rows(fact)


def test_fact_query(tables):
    fact = tables["names_by_person_and_storm"]
    got = max_name_counts(fact, "ALLISON", 2002, "LA", [2000, 2001])
    assert [tuple(r) for r in got.select("baby_birth_year", "max_name_count").collect()] == [
        ("2000", 9),
        ("2001", 10),
    ]
    assert max_name_counts(fact, **FACT_REPORTS["isaias_2020"]).count() == 0


def test_fact_query_from_dims(tables):
    direct = max_name_counts_from_dims(tables["storms_with_us_landfall"], tables["names_by_state"])
    stored = max_name_counts(tables["names_by_person_and_storm"])
    assert rows(direct) == rows(stored) and direct.columns == stored.columns
    some = max_name_counts_from_dims(
        tables["storms_with_us_landfall"], tables["names_by_state"], [2001]
    )
    assert rows(some) == rows(max_name_counts(tables["names_by_person_and_storm"], birth_years=[2001]))


def test_checks(tables, feeds):
    # IRIS claims two lines too many, so one detail row counts twice.
    check = storm_completeness(feeds["tracks"], tables["storm_headers"], tables["atlantic_storms"])
    assert tuple(check.first()) == ("storms", 12, 13, False)
    assert tuple(names_completeness(feeds["names"], tables["names_by_state"]).first()) == (
        "names", 4, 4, 0, True,
    )
    assert tuple(states_completeness(feeds["states"], tables["state_data"]).first()) == (
        "states", 2, 2, 0, True,
    )
    assert tuple(coordinate_check(tables["atlantic_storms"]).first()) == (0, 0, True)
    landfalls = named_landfalls(tables["atlantic_storms"])
    located = locate_landfalls(landfalls, tables["state_data"], feeds["regions"])
    assert tuple(landfall_completeness(landfalls, located).first()) == (3, 2, 1, True)


def test_states_header_as_data(spark, tmp_path):
    from stormledger.plans import states_dimension

    path = tmp_path / "states.json"
    path.write_text(
        '[{"state":"State","state_code":"State Code","region":"Region","division":"Division"},'
        '{"state":"Texas","state_code":"TX","region":"South","division":"West South Central"}]'
    )
    for keys in (None, ["state", "state_code", "region", "division"]):
        raw = read_states_json(spark, str(path), keys)
        states = states_dimension(raw)
        assert rows(states) == [(1, "TX", "Texas", "South", "West South Central")]
        assert tuple(states_completeness(raw, states).first()) == ("states", 1, 1, 0, True)
    nameless = states.withColumn("state", F.lit(None).cast("string"))
    assert tuple(states_completeness(raw, nameless).first()) == ("states", 1, 1, 1, False)


def test_states_with_other_keys_or_another_order(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n')
    with pytest.raises(ValueError, match="none of"):
        read_states_json(spark, str(tmp_path / "a.json"))
    (tmp_path / "b.json").write_text('{"STATE CODE": "TX", "state": "Texas"}\n{"state_code": "LA", "state": "Louisiana"}\n')
    assert rows(read_states_json(spark, str(tmp_path / "b.json"))) == [
        ("Louisiana", "LA", None, None), ("Texas", "TX", None, None),
    ]
    (tmp_path / "c.csv").write_text("Division,State Code,Region,State\nW,TX,South,Texas\n")
    assert rows(read_states_csv(spark, str(tmp_path / "c.csv"))) == [("Texas", "TX", "South", "W")]
    (tmp_path / "d.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="none of"):
        read_states_csv(spark, str(tmp_path / "d.csv"))


def test_wide_lines_lines_of_blanks_and_decimals(spark, tmp_path):
    wide = ",".join(str(i) for i in range(25))
    (tmp_path / "t.txt").write_text(f"AL012001, X, 2,\n20010101, 0000, L, HU, 1.0N, 1.0E, 64.0, 990\n  \t\n{wide}\n")
    raw = ingest_track_lines(spark, str(tmp_path / "t.txt"))
    write_csv(raw, str(tmp_path / "csv"))
    back = read_track_csv(spark, str(tmp_path / "csv"))
    assert back.columns == ["_c0", *(str(i) for i in range(25))]
    assert rows(back, "_c0", "0", "24") == [("0", "AL012001", None), ("1", "20010101", None), ("2", "0", "24")]
    assert rows(storm_stats(back), "stat_id", "max_sustained_wind_kt", "storm_category") == [(1, 64, "1"), (2, 6, None)]
    assert rows(block_join(storm_headers(back), storm_stats(back)), "stat_id") == [(1,), (2,)]


def test_dirty_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("20011399, 0000, L, HU, 28.0N, bad, x1,\n\n20010101\n")
    raw = ingest_track_lines(spark, str(tmp_path / "t.txt"))
    assert rows(raw, "_c0", "0", "3") == [(0, "20011399", " HU"), (1, "20010101", None)]
    got = storm_stats(raw).orderBy("stat_id").collect()
    assert got[0].storm_date is None and got[0].storm_year is None
    assert got[0].latitude == 28.0 and got[0].longitude is None
    assert got[0].max_sustained_wind_kt is None and got[0].storm_category == "uncategorized"
    assert got[1].record_identifier is None and got[1].latitude is None
    assert storm_headers(raw).count() == 0


def test_short_name_line(spark, tmp_path):
    from stormledger.plans import names_dimension

    (tmp_path / "x.TXT").write_text("LA,F,2000\nLA,F,2000,Ann,5\nLA,F,2000,Ann,5\n")
    got = rows(names_dimension(read_name_lines(spark, str(tmp_path))))
    assert got == [
        (1, None, "2000", "LA", "F", None, 2000),
        (2, "ANN", "2000", "LA", "F", "5", 2000),
        (3, "ANN", "2000", "LA", "F", "5", 2000),
    ]


def test_short_csv_line_is_kept(spark, tmp_path):
    (tmp_path / "s.csv").write_text("State,State Code,Region,Division\nA,AA,R,D,extra\nB,BB\n")
    assert rows(read_states_csv(spark, str(tmp_path / "s.csv"))) == [("B", "BB", None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_honest_feed_comes_through_whole(spark, tmp_path, seed):
    """Headers that count right: every line is a header or one track row, in feed order."""
    from stormledger.plans import storm_tracks

    rnd = random.Random(seed)
    lines, want = [], []
    for storm in range(40):
        n = rnd.choice([0, 1, 2, 30, 70])
        lines.append(f"AL{storm:02d}{1950 + storm}, NAME{storm}, {n},")
        for _ in range(n):
            wind = rnd.randrange(200)
            lines.append(f"20010101, 0000, , HU, 1.0N, 1.0E, {wind}, 990")
            want.append((f"AL{storm:02d}{1950 + storm}", f"NAME{storm}", wind))
    (tmp_path / "t.txt").write_text("\n".join(lines))
    raw = ingest_track_lines(spark, str(tmp_path / "t.txt"))
    headers = storm_headers(raw)
    tracks = storm_tracks(headers, storm_stats(raw))
    got = tracks.orderBy("atl_id").select("storm_id", "storm_name", "max_sustained_wind_kt")
    assert [tuple(r) for r in got.collect()] == want
    assert storm_completeness(raw, headers, tracks).first().passed
