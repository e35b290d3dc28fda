"""Versions of the tables: swapped as a whole, refreshed by year, nothing left behind."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures import BOXES, NAME_LINES, STATES_CSV, TRACK_LINES
from stormledger.operators import box_regions, discard, stage, staging_area
from stormledger.operators.staging import scratch_folder
from stormledger.plans import TABLE_PATHS, build, build_tables, open_table, refresh_names, stored_checks, table_paths
from stormledger.sources import expire, fork, ingest_track_lines, read_name_lines, read_states_csv, store


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    (root / "tracks.txt").write_text(TRACK_LINES)
    (root / "names").mkdir()
    (root / "names" / "all.TXT").write_text(NAME_LINES)
    (root / "states.csv").write_text(STATES_CSV)
    boxes = spark.createDataFrame(BOXES, "name string, s double, n double, w double, e double")
    return [
        ingest_track_lines(spark, str(root / "tracks.txt")),
        read_name_lines(spark, str(root / "names")),
        read_states_csv(spark, str(root / "states.csv")),
        box_regions(boxes, "name", "s", "n", "w", "e"),
    ]


def staged(spark):
    folder = f"{scratch_folder(spark)}/stormledger"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def files(path):
    return {
        os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names
    }


def contents(spark, out):
    return {name: sorted(map(str, open_table(spark, out, name).collect())) for name in TABLE_PATHS}


@pytest.fixture(scope="module")
def base(spark, feeds, tmp_path_factory):
    """Tables built once. Nothing staged is left of that."""
    path, before = str(tmp_path_factory.mktemp("base")), staged(spark)
    build_tables(spark, *feeds, path)
    assert staged(spark) == before
    return path


@pytest.fixture
def out(spark, base, tmp_path):
    path = str(tmp_path / "tables")
    fork(spark, base, path)
    return path


def test_nothing_staged_is_left(spark, feeds, out):
    before = staged(spark)
    refresh_names(spark, out, feeds[1], ["2000"])
    assert staged(spark) == before


def test_a_job_that_dies_leaves_the_old_tables(spark, feeds, out, monkeypatch):
    old, before = contents(spark, out), staged(spark)
    fewer = [feeds[0], feeds[1].limit(1), feeds[2].limit(1), feeds[3]]

    def die(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(build, "names_by_storm", die)  # seven of eight tables have been written by then
        with pytest.raises(RuntimeError, match="killed"):
            build_tables(spark, *fewer, out)
        assert contents(spark, out) == old and staged(spark) == before
        with pytest.raises(RuntimeError, match="killed"):
            refresh_names(spark, out, feeds[1], ["2000"])
        assert contents(spark, out) == old and staged(spark) == before
    (tmp,) = [n for n in os.listdir(f"{out}/{store.MANIFESTS}") if n.endswith("1.json")]
    with open(f"{out}/{store.MANIFESTS}/{2:012d}.json", "w") as f:
        f.write('{"tables": {"wind')  # a writer that died while it published
    assert contents(spark, out) == old and tmp
    build_tables(spark, *fewer, out)
    new = contents(spark, out)
    assert len(new["state_data"]) == 1 and len(new["names_by_state"]) == 1
    gone = expire(spark, out)
    assert len(gone) == 2 and contents(spark, out) == new
    assert len(os.listdir(f"{out}/{store.VERSIONS}")) == 1


def test_two_jobs_from_one_version(spark, out):
    number, _ = store.begin(spark, out)
    store.publish(spark, out, number, store.current(spark, out))
    with pytest.raises(Exception, match="(?i)exist"):
        store.publish(spark, out, number, store.current(spark, out))


def test_refresh_rewrites_its_year_only(spark, feeds, base, out, tmp_path):
    names = open_table(spark, out, "names_by_state")
    rows, fact = names.collect(), open_table(spark, out, "names_by_person_and_storm").collect()
    years = sorted({r.birth_year for r in rows if r.birth_year})
    year, before = years[0], files(base)
    lines = feeds[1].unionByName(feeds[1].sparkSession.createDataFrame([(f"TX,F,{year},Allison,77",)], "value string"))
    (tmp_path / "new").mkdir()
    lines.coalesce(1).write.text(str(tmp_path / "new" / "lines"))
    refresh_names(spark, out, read_name_lines(spark, str(tmp_path / "new" / "lines"), "*.txt"), [year])
    after = files(base) | files(out)
    assert {p: t for p, t in after.items() if p in before} == before
    first, second = table_paths(spark, out, "names_by_state")
    assert {d.split("birth_year=")[1].split("/")[0] for d in after if d.startswith(second) and "birth_year=" in d} == {year}
    new = open_table(spark, out, "names_by_state").collect()
    old_ids = {r.name_id for r in rows}
    assert sorted(map(str, (r for r in new if r.birth_year != year))) == sorted(map(str, (r for r in rows if r.birth_year != year)))
    fresh = sorted(r.name_id for r in new if r.birth_year == year)
    assert fresh == list(range(max(old_ids) + 1, max(old_ids) + 1 + len(fresh)))
    assert len(fresh) == 1 + sum(r.birth_year == year for r in rows)
    new_fact = open_table(spark, out, "names_by_person_and_storm").collect()
    known = {r.name_id for r in new}
    assert all(r.name_id in known for r in new_fact) and len({r.bsn_id for r in new_fact}) == len(new_fact)
    assert [r for r in new_fact if r.baby_birth_year != year] == [r for r in fact if r.baby_birth_year != year]
    # the same year once more: ids go on, rows of the first refresh are gone
    refresh_names(spark, out, feeds[1], [year, "1799"])
    again = open_table(spark, out, "names_by_state").collect()
    assert len(again) == len(rows)
    assert min(r.name_id for r in again if r.birth_year == year) == max(fresh) + 1
    assert store.current(spark, out)["next_ids"]["names_by_state"] == max(r.name_id for r in again if r.birth_year == year) + 1


def test_fork_shares_files_and_changes_alone(spark, feeds, out, tmp_path):
    old, other = contents(spark, out), str(tmp_path / "other")
    fork(spark, out, other)
    assert contents(spark, other) == old and not os.path.isdir(f"{other}/{store.VERSIONS}")
    refresh_names(spark, other, feeds[1].limit(0), ["2000"])
    assert contents(spark, out) == old
    assert not open_table(spark, other, "names_by_state").where("birth_year = '2000'").count()


def test_checks_are_observed_while_writing(spark, feeds, out):
    got = {r.check_name: r for r in stored_checks(spark, out).collect()}
    raw = feeds[0].count()
    tables = {n: open_table(spark, out, n).count() for n in ("storm_headers", "atlantic_storms", "names_by_state", "state_data")}
    assert got["storms"].expected == raw and got["storms"].actual == tables["storm_headers"] + tables["atlantic_storms"]
    assert got["names"].expected == feeds[1].count() and got["names"].actual == tables["names_by_state"]
    assert got["states"].actual == tables["state_data"]
    landed = open_table(spark, out, "atlantic_storms").where("record_identifier = 'landfall' and not storm_name like '%UNNAMED%'")
    assert got["landfalls"].expected == got["landfalls"].actual == landed.count()


def test_no_tables_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        open_table(spark, str(tmp_path), "wind_scale")
    assert expire(spark, str(tmp_path)) == []


def test_staging_areas_are_nested(spark):
    before = staged(spark)
    with staging_area():
        outer = stage(spark.range(3))
        with staging_area():
            inner = stage(spark.range(4))
            assert inner.agg(F.count("*")).first()[0] == 4 and len(staged(spark) - before) == 2
        assert len(staged(spark) - before) == 1 and outer.count() == 3
        discard(outer)
        assert staged(spark) == before
    assert staged(spark) == before


def test_names_are_written_by_every_core_in_their_order(spark):
    from stormledger.sources import in_ranges

    names = spark.range(0, 400, 1, 1).select((F.col("id") + 1).alias("name_id"), (F.col("id") % 50).alias("birth_year"))
    placed = in_ranges(names, "name_id")
    assert placed.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert [r.name_id for r in placed.collect()] == list(range(1, 401))
