"""Each operator against brute force, with its bounds forced both ways."""

import gzip
import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import nodes, rows
from stormledger.functions import label, signed_degrees, wind_category
from stormledger.operators import (
    block_join,
    box_regions,
    count_check,
    duplicate_groups,
    global_row_id,
    locate_points,
    missing_values,
    number_lines,
    ragged_rows,
    skew_safe_join,
)
from stormledger.operators import joins, row_ids, stage
from stormledger.operators.blocks import covering_nodes
from stormledger.operators.regions import CELL_DEGREES, quadtree
from stormledger.operators.profile import ragged_count, row_fingerprint
from stormledger.operators.row_ids import scan_position
from stormledger.operators.staging import scratch_folder
from stormledger.schemas import STATUS_LABELS, WIND_SCALE


@pytest.fixture
def without_adaptive(spark):
    """Plans as written: no merged partitions, no broadcast that nobody asked for."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


# ------------------------------------------------------------------ row ids
def test_row_id_equals_sort_order(spark):
    rnd = random.Random(1)
    # One leading key holds most rows, some are NULL, and a third of all rows are copies.
    data = [(rnd.choice([None, "a", "b", "b", "b"]), rnd.randrange(50)) for _ in range(4000)]
    data += [("hot", 7)] * 2000
    df = spark.createDataFrame(data, "k string, v int").repartition(7).withColumn("p", scan_position())
    got = global_row_id(df, ["k", "v", "p"], "id").select("id", "k", "v").collect()
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    assert [(r.k, r.v) for r in sorted(got, key=lambda r: r.id)] == want
    assert sorted(r.id for r in got) == list(range(1, 6001))


def test_row_id_spreads_a_hot_leading_key(spark):
    df = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id"
    )
    from stormledger.operators.staging import stage

    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        parts = stage(df.orderBy("k", "id").withColumn("p", F.spark_partition_id()))
        sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    finally:
        spark.conf.unset(conf)
    assert max(sizes) < 200_000 / 4


def test_row_id_of_nothing(spark):
    assert global_row_id(spark.createDataFrame([], "k int"), ["k"], "id").count() == 0


def test_row_id_plan_has_no_global_window_over_rows(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    plan = nodes(global_row_id(df, ["k", "id"], "n"))
    # The only window is over one row per part, below the aggregate.
    window = plan[plan.index("Window") :]
    assert "HashAggregate" in window and "BroadcastHashJoin" in plan


def test_line_numbers_across_files_and_splits(spark, tmp_path):
    want = []
    for name in ["a.txt", "b.txt", "c.txt"]:
        lines = [f"{name}-{i}" for i in range(3000)]
        (tmp_path / name).write_text("\n\n".join(lines) + "\n")
        want += lines
    packed = [f"d-{i}" for i in range(500)]
    with gzip.open(tmp_path / "d.txt.gz", "wt") as f:
        f.write("\r\n".join(packed))
    want += packed
    conf = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(conf, "4096")
    try:
        got = number_lines(spark.read.text(str(tmp_path)), "i").collect()
    finally:
        spark.conf.unset(conf)
    assert [r.value for r in sorted(got, key=lambda r: r.i)] == want
    assert sorted(r.i for r in got) == list(range(9500))


# --------------------------------------------------------------- block join
@pytest.mark.parametrize("settings", [{}, {"cell_bits": 2, "broadcast_nodes": 100, "node_blocks": 2}, {"cell_bits": 0, "broadcast_nodes": 0, "node_blocks": 1}])
def test_block_join_equals_range_test(spark, settings):
    rnd = random.Random(len(settings))
    lines = list(range(2000))
    header_ids = sorted(rnd.sample(lines, 60))
    # overlapping, overstated, empty, negative and missing entries; one block of nearly everything
    entries = [rnd.choice([0, 1, 5, 30, 200, -3, None]) for _ in header_ids]
    entries[0] = 1990
    details = [i for i in lines if i not in header_ids]
    h = spark.createDataFrame(list(zip(header_ids, entries)), "header_id bigint, entries bigint")
    d = spark.createDataFrame([(i,) for i in details], "stat_id bigint")
    got = rows(block_join(h, d, **settings), "header_id", "stat_id")
    want = sorted(
        (a, i) for a, n in zip(header_ids, entries) if n is not None for i in details if a <= i <= a + n
    )
    assert got == want


def test_block_join_survives_absurd_entries(spark):
    h = spark.createDataFrame([(0, 10**15), (7, 3), (98, 2**63 - 1), (500, 10**15)], "header_id bigint, entries bigint")
    d = spark.createDataFrame([(i,) for i in range(1, 100) if i != 7], "stat_id bigint")
    got = rows(block_join(h, d), "header_id", "stat_id")
    assert got == [(0, i) for i in range(1, 100) if i != 7] + [(7, 8), (7, 9), (7, 10)] + [
        (98, 98), (98, 99)
    ]
    assert block_join(h, d.limit(0)).count() == 0


def test_covering_nodes_hold_each_leaf_once(spark):
    pairs = [(a, a + n) for a in (0, 1, 5, 8, 1000, 2**40 - 3) for n in (0, 1, 2, 6, 7, 8, 100, 1023)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for a, b, nodes_ in df.select("a", "b", covering_nodes("a", "b")).collect():
        leaves = sorted(x for v in nodes_ for x in range((v >> 6) << (v & 63), ((v >> 6) + 1) << (v & 63)))
        assert leaves == list(range(a, b + 1))
        assert len(nodes_) <= 2 * (b - a + 1).bit_length()
    [(whole,)] = spark.sql("select 3L a, cast(pow(2, 56) as bigint) b").select(covering_nodes("a", "b")).collect()
    assert len(whole) <= 2 * 57


@pytest.mark.parametrize("bound", [200_000, 0])
def test_many_blocks_over_one_cell(spark, without_adaptive, bound):
    """100,000 blocks that all cover the same lines: no task gives twice the median of the pairs."""
    h = spark.range(100_000).select(F.col("id").alias("header_id"), (100_015 - F.col("id")).alias("entries"))
    d = spark.range(100_000, 100_032).toDF("stat_id")
    pairs = block_join(h, d, broadcast_nodes=bound, node_blocks=300)
    sizes = sorted(r[1] for r in pairs.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 100_000 * 16 and len(sizes) >= 8
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_block_join_is_an_equi_join(spark):
    h = spark.range(10).select((F.col("id") * 10).alias("header_id"), F.lit(9).cast("bigint").alias("entries"))
    plan = nodes(block_join(h, spark.range(100).toDF("stat_id")))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# -------------------------------------------------------------------- joins
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("bound, fan_out", [(1_000_000, 1_000_000), (1_000_000, 50_000), (400, 20), (3, 1)])
def test_skew_safe_join_equals_plain_join(spark, how, bound, fan_out):
    rnd = random.Random(3)
    left = [(rnd.choice(["hot", "hot", "hot", None, *"abcdefgh"]), i % 500) for i in range(1500)]
    # a key hot on both sides, with copies on both, a key with two rows, keys on one side only
    right = [(k, i) for i in range(2) for k in ["a", "b", "z", None]] + [("hot", i // 3) for i in range(60)]
    a = spark.createDataFrame(left, "k string, v int").repartition(6)
    b = spark.createDataFrame(right, "k string, w int").repartition(3)
    got = skew_safe_join(a, b, "k", how, broadcast_rows=bound, task_rows=100, fan_out=fan_out)
    want = a.join(b, "k", how)
    assert rows(got) == rows(want) and got.columns == want.columns


def _two_sided(spark):
    """Key A hot on the left with one partner, key B hot on the right with one partner, the rest unique."""
    left = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") < 50_000, "A").when(F.col("id") == 50_000, "B").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(0, 60_000, 1, 4).select(
        F.when(F.col("id") < 58_000, "B").when(F.col("id") == 58_000, "A").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("w"),
    )
    return left, right


@pytest.mark.parametrize("task_rows", [1_000, 10_000])
def test_each_hot_key_is_cut_by_its_own_counts(spark, task_rows):
    left, right = _two_sided(spark)
    grid = joins.grid_of(left, right, "k", "inner", task_rows, task_rows)
    assert rows(grid) == [("A", 50_000 // task_rows, 1), ("B", 1, -(-58_000 // task_rows))]
    a, b = joins.on_grid(left, right, grid, "k")
    # A's one partner and B's one partner are repeated, nothing else
    assert a.count() == 100_000 - 1 + -(-58_000 // task_rows)
    assert b.count() == 60_000 - 1 + 50_000 // task_rows
    cell = a.groupBy("k", "__salt", "__chunk").count().agg(F.max("count")).first()[0]
    assert cell <= 1.2 * task_rows
    got = skew_safe_join(left, right, "k", broadcast_rows=3, task_rows=task_rows)
    assert got.count() == left.join(right, "k").count()


def test_keys_that_multiply_are_cut(spark, monkeypatch):
    monkeypatch.setattr(joins, "OUT_ROWS", 1_000)
    a = spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    b = spark.range(100).select(F.lit("hot").alias("k"), F.col("id").alias("w"))
    assert rows(joins.grid_of(a, b, "k", "inner", 1_000, 1_000)) == [("hot", 30, 1)]
    assert skew_safe_join(a, b, "k", broadcast_rows=3).count() == 30_000


def test_broadcast_bound_counts_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 1_000).alias("t"), F.array(F.lit(1)).alias("a"))
    assert joins.within_bound(df, 10) and not joins.within_bound(df, 9)
    assert not joins.within_bound(df, 10, most_bytes=9_000)


@pytest.mark.parametrize("salts, chunks", [(16, 1), (8, 8)])
def test_grid_join_spreads_the_hot_key(spark, salts, chunks):
    # Copies of one row on the left.
    a = spark.range(0, 4_000, 1, 16).select(F.lit("hot").alias("k"), F.lit(0).alias("v"))
    b = spark.range(0, 100, 1, 4).select(F.lit("hot").alias("k"), F.col("id").alias("w"))
    for conf in ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]:
        spark.conf.set(conf, "false" if conf.endswith("enabled") else "-1")
    try:
        joined = joins._grid_join(a, b, "k", "inner", -(-4_000 // salts), -(-100 // chunks))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 400_000 and max(sizes) <= 200_000 and len(sizes) > 2


def test_rows_before_a_numbered_join_are_computed_once(spark):
    """A costly input is computed once per row, a plain one twice (the sort's sample)."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 1_000, 1, 4).mapInArrow(touch, "id long")
    assert global_row_id(df, ["id"], "n", costly=True).count() == 1_000 and seen.value == 1_000


def test_staged_tables_can_be_discarded(spark):
    from stormledger.operators.staging import discard, stage

    kept, gone = stage(spark.range(3)), stage(spark.range(3))
    folder = gone.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    discard(gone)
    import os

    assert not os.path.exists(folder) and kept.count() == 3


def test_a_region_without_a_name_holds_nothing(spark):
    box = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)]
    regions = spark.createDataFrame([("T", box), (None, box)], "state string, ring array<struct<lat:double,lon:double>>")
    points = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    for bound in (1_000, 0):
        assert locate_points(points, regions, broadcast_cells=bound).first().state == "T"


# ------------------------------------------------------------------ regions
def _inside(lat, lon, ring):
    odd = False
    for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _star(rnd, lat, lon, size):
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.randint(3, 12)))
    reach = [size * rnd.uniform(0.3, 1) for _ in angles]
    return [(lat + r * math.sin(a), lon + r * math.cos(a)) for a, r in zip(angles, reach)]


@pytest.fixture(scope="module")
def map_and_points(spark):
    rnd = random.Random(11)
    parts = [
        (rnd.choice("ABCDEFGH"), _star(rnd, rnd.uniform(-30, 30), rnd.uniform(-60, 60), rnd.uniform(0.2, 14)))
        for _ in range(25)
    ]
    parts.append(("Box", [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0)]))
    points = [(rnd.uniform(-40, 40), rnd.uniform(-70, 70)) for _ in range(1500)]
    points += [(float(y), float(x)) for y in (0, 5, 10) for x in (0, 5, 10)]
    points += [(None, 1.0), (1.0, None), (float("nan"), 1.0)] + [(5.5, 5.5)] * 700
    regions = spark.createDataFrame(parts, "state string, ring array<struct<lat:double,lon:double>>")
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, latitude double, longitude double")
    want = []
    for i, (lat, lon) in enumerate(points):
        bad = lat is None or lon is None or lat != lat
        names = [] if bad else [n for n, ring in parts if _inside(lat, lon, ring)]
        want.append((i, min(names) if names else None))
    return regions, df, want


@pytest.mark.parametrize("cell, edges, levels", [(8.0, 32, 14), (1.0, 10**9, 0), (0.7, 10**9, 0), (50.0, 6, 6), (7.0, 0, 3)])
@pytest.mark.parametrize("bound", [10**9, 0])
def test_locate_points_equals_ray_cast(map_and_points, cell, edges, levels, bound):
    regions, points, want = map_and_points
    got = locate_points(points, regions, cell=cell, broadcast_cells=bound, cell_edges=edges, levels=levels)
    assert rows(got, "id", "state") == want
    assert set(got.columns) == {*points.columns, "state"}


def test_locate_points_does_not_move_the_points(map_and_points):
    regions, points, _ = map_and_points
    plan = nodes(locate_points(points, regions))
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_level_edge_inside_a_cell(spark):
    """A border along a parallel in the middle of cells, far from any other edge."""
    wide = spark.createDataFrame([("w", 0.3, 5.5, 0.0, 90.0)], "n string, s double, t double, w double, e double")
    spots = [(0.2, 40.0), (0.3, 40.0), (0.9, 40.0), (5.4, 40.0), (5.5, 40.0), (5.6, 40.0)]
    pts = spark.createDataFrame(spots, "latitude double, longitude double")
    for cell in (1.0, 8.0):
        got = locate_points(pts, box_regions(wide, "n", "s", "t", "w", "e"), cell=cell).collect()
        assert {(r.latitude, r.state) for r in got} == {(0.2, None), (0.3, "w"), (0.9, "w"), (5.4, "w"), (5.5, None), (5.6, None)}


def test_points_move_once_and_cells_follow_the_edges(spark, without_adaptive):
    """A continent of four edges, a coast of 4000 in a corner of it: few large cells, small ones at the coast only."""
    coast = [(5 + 0.01 * math.sin(i / 300), 5 + 0.01 * math.cos(i / 300)) for i in range(1885)]
    parts = [("Land", [(-60.0, -120.0), (-60.0, 120.0), (60.0, 120.0), (60.0, -120.0)]), ("Isle", coast)]
    regions = spark.createDataFrame(parts, "state string, ring array<struct<lat:double,lon:double>>")
    leaves, cut = quadtree(regions, CELL_DEGREES, 32, 14)
    assert len(cut) > 5 and all(c.count() < 200 for c in cut)
    assert leaves.count() < 3000 and max(len(c.edges) for r in leaves.collect() for c in r["__candidates"]) < 150
    rnd = random.Random(3)
    spots = [(5 + rnd.uniform(-0.02, 0.02), 5 + rnd.uniform(-0.02, 0.02)) for _ in range(400)] + [(70.0, 0.0), (1.0, 1.0)]
    points = spark.createDataFrame(spots, "latitude double, longitude double")
    for bound in (10**9, 300):
        located = locate_points(points, regions, broadcast_cells=bound)
        got = {(r.latitude, r.longitude): r.state for r in located.collect()}
        assert got == {p: min((n for n, ring in parts if _inside(*p, ring)), default=None) for p in spots}
    plan = nodes(located)
    # the points' side: one exchange, no join with the points themselves
    assert plan.count("Exchange hashpartitioning(__cell") == 2 and plan.count("SortMergeJoin") == 1


def test_box_borders_are_half_open(spark):
    boxes = spark.createDataFrame([("w", 0, 1, 0, 1), ("e", 0, 1, 1, 2)], "n string, s int, t int, w int, e int")
    pts = spark.createDataFrame([(0.0, 0.0), (0.5, 1.0), (1.0, 0.5), (0.5, 2.0)], "latitude double, longitude double")
    got = locate_points(pts, box_regions(boxes, "n", "s", "t", "w", "e"))
    assert sorted((r.latitude, r.longitude, r.state) for r in got.collect() if r.state) == [
        (0.0, 0.0, "w"),
        (0.5, 1.0, "e"),
    ]


# ---------------------------------------------------------------- functions
def _ladder(wind, status):
    """The five passes, each over the result of the one before."""
    bands = [(c, lo, hi) for c, lo, hi, _ in WIND_SCALE]
    got = status if wind is not None and wind < bands[0][1] else "uncategorized"
    for c, lo, hi in bands[:-1]:
        if wind is not None and lo <= wind <= hi + 1:
            got = c
    return bands[-1][0] if wind is not None and wind >= bands[-1][1] else got


def test_wind_category(spark):
    winds = [None, -99, *range(0, 201), 2_000_000]
    df = spark.createDataFrame([(w, "st") for w in winds], "w int, s string")
    got = {r.w: r.c for r in df.select("w", wind_category(F.col("w"), F.col("s")).alias("c")).collect()}
    assert got == {w: _ladder(w, "st") for w in winds}


def test_wind_category_equals_band_lookup(spark):
    for wind in range(64, 201):
        assert _ladder(wind, None) == next(c for c, lo, hi, _ in WIND_SCALE if lo <= wind <= hi)


def test_label(spark):
    df = spark.createDataFrame([(" HU ",), ("??",), (None,), ("",)], "c string")
    got = [r[0] for r in df.select(label(F.col("c"), STATUS_LABELS)).collect()]
    assert got == ["hurricane", None, None, None]


def test_signed_degrees(spark):
    texts = [" 28.0N", "94.8W", "10.0S", "20.5E ", "0.0W", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    north = [r[0] for r in df.select(signed_degrees(F.col("t"), "N")).collect()]
    east = [r[0] for r in df.select(signed_degrees(F.col("t"), "E")).collect()]
    assert north == [28.0, -94.8, -10.0, -20.5, 0.0, None, None, None]
    assert east == [-28.0, -94.8, -10.0, 20.5, 0.0, None, None, None]
    assert math.copysign(1, east[4]) == 1


# ----------------------------------------------------------------- profiles
def test_missing_values(spark):
    df = spark.createDataFrame(
        [(None, None), ("a", float("nan")), ("NaN", 1.0)], "s string, d double"
    )
    assert tuple(missing_values(df).first()) == (1, 2)


def test_duplicate_groups(spark):
    df = spark.createDataFrame([(x,) for x in "aaabbc"], "x string")
    assert duplicate_groups(df).first()[0] == 2
    assert duplicate_groups(df.union(spark.createDataFrame([(None,)] * 2, "x string"))).first()[0] == 3


def test_ragged_rows(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], ["0", "3"])
    assert rows(ragged_rows(df)) == [("a", None)]
    assert tuple(ragged_count(df).first()) == (1, 2)


def test_count_check(spark):
    a, b = spark.range(3), spark.range(4)
    assert tuple(count_check("x", [a, b], [spark.range(7)]).first()) == ("x", 7, 7, True)
    assert tuple(count_check("x", [a], [b]).first()) == ("x", 3, 4, False)


# ------------------------------------------------------------- sinks, plans
def test_large_folder_is_split_and_small_ones_are_not(spark, tmp_path):
    from stormledger.sources import write_partitioned

    df = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 20).cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(conf, "1MB")
    try:
        write_partitioned(df, str(tmp_path / "t"), ["k"])
    finally:
        spark.conf.unset(conf)
    files = {f.name: len(list(f.glob("*.parquet"))) for f in (tmp_path / "t").glob("k=*")}
    assert files["k=hot"] > 2 and len(files) == 21
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 200_000 and back.where("k = 'hot'").count() == 66_667


def test_report_filters_reach_the_scan(spark, tmp_path):
    from stormledger.plans import max_name_counts
    from stormledger.plans.facts import FACT_COLUMNS

    path = str(tmp_path / "fact")
    spark.range(5).select(
        *(F.col("id").cast("int" if c == "storm_year" else "string").alias(c) for c in FACT_COLUMNS)
    ).write.parquet(path)
    fact = spark.read.parquet(path)
    for asked, pushed in [
        ({"storm_name": "1"}, "EqualTo(storm_name,1)"),
        ({"storm_year": 1}, "EqualTo(storm_year,1)"),
        ({"state_code": "1"}, "EqualTo(state_code,1)"),
        ({"birth_years": [1]}, "EqualTo(baby_birth_year,1)"),
        ({"birth_years": [1, 2]}, "In(baby_birth_year, [1,2])"),
    ]:
        plan = nodes(max_name_counts(fact, **asked))
        assert pushed in plan[plan.index("PushedFilters") :] and "swl_id" not in plan


def test_storm_filter_skips_row_groups(spark, tmp_path):
    """Sorted inside its files, the fact's row groups span few storms each."""
    import pyarrow.parquet as pq

    from stormledger.sources import write_table

    fact = spark.range(0, 40_000, 1, 1).select(
        F.sha1(F.col("id").cast("string")).alias("bsn_id"), F.format_string("S%03d", F.col("id") * 7919 % 100).alias("storm_name")
    )
    path = tmp_path / "fact"
    spark.conf.set("parquet.block.size", "100000")
    try:
        write_table(fact, str(path), sort=["storm_name"], blooms=("storm_name",))
    finally:
        spark.conf.unset("parquet.block.size")
    groups = [
        (c.statistics.min, c.statistics.max)
        for f in path.glob("*.parquet")
        for meta in [pq.ParquetFile(f).metadata]
        for g in range(meta.num_row_groups)
        for c in [meta.row_group(g).column(1)]
    ]
    assert len(groups) > 4 and sum(lo <= "S042" <= hi for lo, hi in groups) <= 2


def test_top_names_cut_groups_before_the_shuffle(spark):
    from stormledger.plans import top_names_by_state

    names = spark.createDataFrame([("LA", "A", "2000", "3")], "state_code string, birth_name string, birth_year string, count string")
    plan = nodes(top_names_by_state(names, 1999, 2001, 3))
    assert plan.count("WindowGroupLimit") == 2


def test_top_names_with_a_large_k(spark):
    from stormledger.plans import analytics

    names = spark.range(400).select(
        (F.col("id") % 3).cast("string").alias("state_code"),
        F.concat(F.lit("N"), F.col("id") % 90).alias("birth_name"),
        F.lit("2000").alias("birth_year"),
        (F.col("id") % 7).cast("string").alias("count"),
    )
    want = rows(analytics.top_names_by_state(names, 1999, 2001, 20))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        assert rows(analytics.top_names_by_state(names, 1999, 2001, 20)) == want and len(want) == 60
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_session_builder_joins_the_running_session(spark):
    from stormledger.session import COMMIT_ALGORITHM, create_session

    assert create_session(fast_commit=True, shuffle_bytes=2**40).sparkContext is spark.sparkContext
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert spark.conf.get(initial) == "8192" and spark.conf.get(COMMIT_ALGORITHM) == "2"
    finally:
        spark.conf.unset(initial)
        spark.conf.unset(COMMIT_ALGORITHM)


def test_preview(spark, capfd):
    from stormledger.sources import preview

    assert preview(spark.range(10), 3).count() == 3


def test_region_file(spark, tmp_path):
    from stormledger.sources import read_regions

    ring = '[{"lat":0,"lon":0},{"lat":0,"lon":2},{"lat":2,"lon":0}]'
    (tmp_path / "r.json").write_text(f'{{"state":"T","ring":{ring}}}\n')
    pts = spark.createDataFrame([(0.5, 0.5), (1.5, 1.5)], "latitude double, longitude double")
    got = locate_points(pts, read_regions(spark, str(tmp_path / "r.json")))
    assert rows(got, "latitude", "state") == [(0.5, "T"), (1.5, None)]


# -------------------------------------------------- rows that do not move
def test_rows_without_a_partner_are_not_shuffled(spark, without_adaptive):
    """The filter loses no partner and lets one in sixteen others pass; the join behind it is the plain one."""
    left = spark.range(100_000).select((F.col("id") % 50_000).cast("string").alias("k"), "id")
    left = left.unionByName(spark.createDataFrame([(None, 1)], "k string, id bigint"))
    right = spark.range(0, 400).select((F.col("id") * 3).cast("string").alias("k"), F.col("id").alias("w"))
    kept = joins.may_have_partner(left, right, "k")
    assert kept.join(right, "k", "left_semi").count() == left.join(right, "k", "left_semi").count() == 800
    assert 800 <= kept.count() < 800 + 100_000 / 16 * 1.3
    assert joins.may_have_partner(left, right.limit(0), "k").count() == 0
    assert joins.may_have_partner(left, right, "k", most_keys=10).count() == 100_001
    for how in ("inner", "left_semi"):
        got = skew_safe_join(left, right, "k", how, broadcast_rows=3, task_rows=1000)
        assert rows(got) == rows(left.join(right, "k", how))
        plan = nodes(got)
        assert "SortMergeJoin" in plan
        # in a printed plan a node's input stands below it: the join with the bitmap feeds the exchange
        assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(k") < plan.index("__piece")


def test_duplicate_groups_with_colliding_fingerprints(spark, without_adaptive):
    rnd = random.Random(2)
    data = [(rnd.randrange(40), rnd.choice(["x" * 200, "y" * 200, None]), rnd.choice([0.0, -0.0, float("nan"), 1.5])) for _ in range(600)]
    df = spark.createDataFrame(data, "a int, `b c` string, d double").repartition(5)
    alike = {}
    for a, b, d in data:
        key = (a, b, "nan" if d != d else d + 0.0)
        alike[key] = alike.get(key, 0) + 1
    want = sum(n > 1 for n in alike.values())
    same = lambda columns: [F.lit(7).cast("bigint").alias("__f1"), F.lit(7).cast("bigint").alias("__f2")]
    few = lambda columns: [(F.xxhash64(*columns) % 3).alias("__f1"), F.lit(0).cast("bigint").alias("__f2")]
    for fingerprint in (row_fingerprint, same, few):
        assert duplicate_groups(df, fingerprint=fingerprint).first()[0] == want
    assert duplicate_groups(df.select("a").distinct()).first()[0] == 0
    assert duplicate_groups(df.limit(0)).first()[0] == 0


# ---------------------------------------------- row ids of costly inputs
@pytest.mark.parametrize("settings", [{}, {"RANGE_ROWS": 50}, {"RANGE_ROWS": 3, "GROUP": 4, "SAMPLED": 2}, {"MOST_RANGES": 1}])
def test_costly_row_ids_by_ranges(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(row_ids, name, value)
    rnd = random.Random(8)
    data = [(rnd.choice([None, "a", "hot", "hot", "hot", ""]), rnd.choice([None, *range(5)]), i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, v int, p int").repartition(7)
    before = _staged(spark)
    got = global_row_id(df, ["k", "v", "p"], "id", 11, costly=True)
    new = [n for n in _staged(spark) - before if n.startswith(("unsorted", "sorted"))]
    assert len(new) == 1  # one copy of the rows
    low = lambda x: (x is not None, x if x is not None else 0)
    want = sorted(data, key=lambda t: ((t[0] is not None, t[0] or ""), low(t[1]), t[2]))
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r.id)] == want
    assert sorted(r.id for r in got.collect()) == list(range(11, 911))
    assert global_row_id(df.limit(0), ["k"], "id", costly=True).count() == 0
    assert [r.id for r in global_row_id(df.limit(1), ["k"], "id", costly=True).collect()] == [1]


def test_ranges_hold_about_as_many_rows(spark, without_adaptive, monkeypatch):
    """A leading value that holds nearly all rows is split by the other keys."""
    monkeypatch.setattr(row_ids, "RANGE_ROWS", 500)
    df = spark.range(20_000).select(F.when(F.col("id") % 20 == 0, "b").otherwise("a").alias("k"), F.xxhash64("id").alias("v"))
    staged = stage(df)
    bounds = row_ids.range_bounds(staged, F.struct("k", "v"), 40, 20_000).first()
    cuts = [tuple(b) for g in bounds.fine for b in g]
    assert cuts == sorted(cuts) and len(cuts) == 39 and [tuple(g[0]) for g in bounds.fine] == [tuple(c) for c in bounds.coarse]
    sizes = [0] * 40
    for r in staged.collect():
        sizes[sum(c <= (r.k, r.v) for c in cuts)] += 1
    assert max(sizes) < 2.2 * 500 and min(sizes) > 0


def test_ranges_are_found_by_binary_search(spark, monkeypatch):
    """Generated code, a few comparisons per row: no lambda walks the list of cuts. Many ranges are dealt over many tasks."""
    rnd = random.Random(5)
    data = [(rnd.choice([None, "", "10", "9", "a"]), rnd.choice([None, *range(40)])) for _ in range(600)]
    df = spark.createDataFrame(data, "k string, v int")
    monkeypatch.setattr(row_ids, "RANGE_ROWS", 20)
    numbered = global_row_id(df, ["k", "v"], "id", costly=True)
    assert "lambda" not in nodes(numbered) and numbered.rdd.getNumPartitions() == 30
    low = lambda t: ((t[0] is not None, t[0] or ""), (t[1] is not None, t[1] or 0))
    for n in (0, 1, 2, 3, 36, 64):
        cuts = sorted(set(rnd.sample(data, n)), key=low)
        literal = F.from_json(F.lit(json.dumps([{"k": k, "v": v} for k, v in cuts])), "array<struct<k: string, v: int>>")
        for r in row_ids.with_range(df, F.struct("k", "v"), literal, len(cuts)).collect():
            assert r["__part"] == sum(low(c) <= low((r.k, r.v)) for c in cuts)


def _staged(spark):
    folder = f"{scratch_folder(spark)}/stormledger"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()
