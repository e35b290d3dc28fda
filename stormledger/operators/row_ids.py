"""Global row numbers 1..n without a one-partition window.

Rows are laid out in parts (range partitions of a sort, ranges of keys, or the splits of a text
scan). A count per part, summed up in part order, gives each part's offset; the row number is offset plus
position in the part. Only that table of one row per *part* ever meets in one task.

One staged copy of the rows makes both passes (count, then number) see the same parts
even when executors are lost or the scan is planned differently the second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import bounded_broadcast
from .staging import stage

# A row per split of a text scan, slim enough to broadcast a million of them (some 200 MB).
# Past that, raise spark.sql.files.maxPartitionBytes or pay for a shuffle of the lines.
BROADCAST_SPLITS = 1_000_000

# Rows that one task should sort and number, and ranges at most: beyond that they grow.
RANGE_ROWS, MOST_RANGES = 1_000_000, 4096
SAMPLED, GROUP = 20, 64

_PART, _FILE, _BLOCK, _POS, _SHIFT, _KEY = "__part", "__file", "__block", "__pos", "__shift", "__key"


def scan_position() -> Column:
    """Tie-break for rows that may be exact copies of each other.

    Use it directly on a file scan (filters and projections in between are
    fine): there a task's row order is fixed, so a retried task repeats it.
    """
    return F.monotonically_increasing_id()


def _number_parts(staged: DataFrame, part: list[str], id_col: str, start: int, hint) -> DataFrame:
    sizes = staged.groupBy(*part).agg(F.count("*").alias("n"), F.min(_POS).alias("first"))
    before = W.orderBy(*part).rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(
        *part,
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + start).alias(_SHIFT),
    )
    numbered = staged.join(hint(shifts), part)
    return numbered.withColumn(id_col, F.col(_POS) + F.col(_SHIFT)).drop(*part, _POS, _SHIFT)


def global_row_id(
    df: DataFrame,
    order_by: list[str | Column],
    id_col: str = "row_id",
    start: int = 1,
    costly: bool = False,
) -> DataFrame:
    """``row_number()`` over one global order, as bigint ``id_col``.

    The sort splits on *all* of ``order_by``, so a leading key that holds most
    rows is spread over many tasks. ``order_by`` should be total. Where whole
    rows may be copies, end it with a column made by :func:`scan_position`.

    A sort looks at a sample of its input first, which computes the input twice, and what it gives has to be written before it can be
    counted. ``costly``: the input is more than a scan (a join that multiplies rows), so the input itself is written, once; ranges of
    keys are cut from a sample of that copy, their rows are counted exactly, and the rows are numbered range by range
    when the result is computed. ``order_by`` must then be ascending columns of text or whole numbers.
    """
    if costly:
        return _number_ranges(stage(df, "unsorted"), order_by, id_col, start)
    # A global sort numbers its partitions in key order; the id's upper bits hold that number.
    laid_out = df.orderBy(*order_by).withColumn(_POS, F.monotonically_increasing_id())
    staged = stage(laid_out, "sorted").withColumn(_PART, F.shiftright(_POS, 33))
    # One row per sort partition, so never more than spark.sql.shuffle.partitions.
    return _number_parts(staged, [_PART], id_col, start, F.broadcast)


def range_bounds(staged: DataFrame, key: Column, ranges: int, rows: int) -> DataFrame:
    """One row: ``fine``, the keys at which ranges begin, in groups of ``GROUP``, and ``coarse``, the first of each group.

    From a sample of ``SAMPLED`` keys per range, so from a bounded number of keys.
    """
    share = min(1.0, SAMPLED * ranges / max(rows, 1))
    sampled = staged.select(key.alias("k")).sample(share, seed=17).agg(F.sort_array(F.collect_list("k")).alias("keys"))
    at = lambda i: F.get("keys", F.floor(F.size("keys") * i / ranges).cast("int"))
    every = F.transform(F.sequence(F.lit(1), F.lit(max(ranges - 1, 1))), at)
    cuts = sampled.select(F.array_distinct(F.array_compact(every)).alias("cuts"))
    groups = F.sequence(F.lit(0), F.floor((F.size("cuts") - 1) / GROUP).cast("int"))
    fine = F.when(F.size("cuts") > 0, F.transform(groups, lambda g: F.slice("cuts", g * GROUP + 1, GROUP)))
    fine = F.coalesce(fine, F.array(F.slice("cuts", 1, 0)))
    return cuts.select(fine.alias("fine")).withColumn("coarse", F.transform("fine", lambda g: F.get(g, F.lit(0))))


def with_range(df: DataFrame, key: Column, cuts: Column, n: int) -> DataFrame:
    """``df`` with the number of a row's range: how many of the ``n`` sorted ``cuts`` (an array) are at most its ``key``.

    A binary search, a column per step, so that a row costs ``log2(n)`` comparisons in generated code. A step past the end finds
    no cut and is not taken.
    """
    ranged = df.withColumns({_KEY: key, _PART: F.lit(0)})
    for step in (1 << k for k in reversed(range(n.bit_length()))):
        taken = F.get(cuts, F.col(_PART) + (step - 1)) <= F.col(_KEY)
        ranged = ranged.withColumn(_PART, F.col(_PART) + F.when(taken, step).otherwise(0))
    return ranged.drop(_KEY)


def _number_ranges(staged: DataFrame, order_by: list[str | Column], id_col: str, start: int) -> DataFrame:
    spark, rows = staged.sparkSession, staged.count()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MOST_RANGES, max(-(-rows // RANGE_ROWS), min(parallel, rows), 1))
    key = F.struct(*order_by)
    bounds = range_bounds(staged, key, ranges, rows)
    # a literal of at most MOST_RANGES keys, folded once, so that no row carries it
    [[text, n]] = bounds.select(F.to_json(F.struct("fine")), F.size(F.flatten("fine"))).collect()
    cuts = F.flatten(F.from_json(F.lit(text), bounds.select("fine").schema)["fine"])
    ranged = with_range(staged, key, cuts, n)
    # a row per range: at most MOST_RANGES
    sizes = ranged.groupBy(_PART).agg(F.count("*").alias("n"))
    before = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    shifts = stage(sizes.select(_PART, (F.coalesce(F.sum("n").over(before), F.lit(0)) + start - 1).alias(_SHIFT)), "range-sizes")
    if ranges > parallel or rows > RANGE_ROWS * spark.sparkContext.defaultParallelism:
        # More than a task per core should sort: deal the ranges out over as many tasks.
        ranged = ranged.repartition(ranges, _PART)
    place = F.row_number().over(W.partitionBy(_PART).orderBy(*order_by))
    numbered = ranged.withColumn(_POS, place).join(F.broadcast(shifts), _PART)
    return numbered.withColumn(id_col, F.col(_POS) + F.col(_SHIFT)).drop(_PART, _POS, _SHIFT)


def number_lines(lines: DataFrame, id_col: str = "_c0", start: int = 0) -> DataFrame:
    """Line index over a text scan, in file and line order, skipping lines of nothing but blanks.

    ``lines`` comes straight from ``spark.read.text``. The lines are not shuffled.
    """
    laid_out = (
        lines.select(
            "value",
            F.col("_metadata.file_path").alias(_FILE),
            F.col("_metadata.file_block_start").alias(_BLOCK),
        )
        .where(F.col("value").rlike(r"[^ \t]"))
        .withColumn(_POS, F.monotonically_increasing_id())
    )
    hint = lambda shifts: bounded_broadcast(shifts, BROADCAST_SPLITS)
    return _number_parts(stage(laid_out, "lines"), [_FILE, _BLOCK], id_col, start, hint)
