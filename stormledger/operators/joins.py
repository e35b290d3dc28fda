"""Equi-joins that check the size of what they broadcast and cut keys that are hot.

``skew_safe_join`` broadcasts the side that should be small only after measuring
it up to a bound in rows and bytes. Beyond the bound it shuffles. Keys with more
rows than a task should hold are cut into a grid of their own: the rows of one
side into salts, those of the other into chunks, as many as that key's own
counts need. A key that is hot on one side only is repeated on neither side more often than
the other side is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from .staging import stage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A key with more rows than this on the broadcast side multiplies its partners too much for one task.
FAN_OUT = 1_000
# Rows of one key that one task of a shuffle join should hold.
TASK_ROWS = 1_000_000
# Rows that one cell of the grid may give.
OUT_ROWS = 10_000_000

# Distinct keys that a filter of the other side may hold: 16 bits each, so up to 32 MB.
FILTER_KEYS = 16_000_000
FILTER_BITS = 16

_SALT, _CHUNK, _SALTS, _CHUNKS = "__salt", "__chunk", "__salts", "__chunks"


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: text by its length, everything else by its printed form or 8."""
    total = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size = F.length(c.cast("string"))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0))
    return total


def within_bound(df: DataFrame, rows: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` has at most ``rows`` rows and about ``most_bytes`` bytes.

    ``take`` runs over more and more partitions until it has seen enough, so a large
    ``df`` is not scanned to its end; at most ``rows + 1`` numbers reach the driver.
    """
    sizes = df.select(row_bytes(df)).take(rows + 1)
    return len(sizes) <= rows and sum(r[0] for r in sizes) <= most_bytes


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint if ``df`` is within bounds; otherwise ``df`` as it is."""
    return F.broadcast(df) if within_bound(df, rows) else df


def spread_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Spread a small ``df`` over all cores; a large one has tasks enough and stays where it is.

    For the input of a join that multiplies rows: few rows in one task may be many rows out.
    """
    if not within_bound(df, rows):
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def key_cuts(df: DataFrame, key: str, most: int, name: str) -> DataFrame:
    """(key, ``name``): keys with more than ``most`` rows and the number of parts of ``most`` rows they need.

    Counted with a map-side combine. There are at most count / ``most`` of them.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    return counts.where(F.col("__n") > most).select(key, F.ceil(F.col("__n") / most).cast("int").alias(name))


def skew_safe_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    task_rows: int = TASK_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Join ``left`` (large, may be skewed) with ``right`` on a column both have.

    ``how``: inner, left, left_semi or left_anti. Same rows as a plain join.

    A ``right`` within ``broadcast_rows`` is broadcast and ``left`` stays where it is. Only the
    rows of keys with more than ``fan_out`` partners are shuffled (an inner join; there are
    at most ``broadcast_rows / fan_out`` such keys), so that no task multiplies its rows by thousands.

    A larger ``right`` is shuffled with those rows of ``left`` that pass a Bloom filter of its keys (inner and left_semi).
    """
    if how in ("left_semi", "left_anti"):
        right = right.select(on).distinct()
    elif how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    if within_bound(right, broadcast_rows):
        wide = [r[0] for r in key_cuts(right, on, fan_out, _CHUNKS).collect()] if how == "inner" else []
        if not wide:
            return left.join(F.broadcast(right), on, how)
        is_wide = F.coalesce(F.col(on).isin(wide), F.lit(False))
        narrow = left.where(~is_wide).join(F.broadcast(right.where(~is_wide)), on)
        left, right = left.where(is_wide), right.where(is_wide)
        return narrow.unionByName(_grid_join(left, right, on, how, task_rows, fan_out))
    if how == "left_semi":  # the keys of right are distinct; as an inner join, the filter stays below it
        return _grid_join(left, right, on, "inner", task_rows, task_rows).select(*(f"`{c}`" for c in left.columns))
    return _grid_join(left, right, on, how, task_rows, task_rows)


def _slot(df: DataFrame, slots: Column) -> Column:
    """A number below ``slots`` for a row.

    It differs between rows of a task by their values, and between copies of a row by
    their tasks. A retried task gives its rows the same numbers again.
    """
    values = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.pmod(F.xxhash64(*values) + F.spark_partition_id(), slots).cast("int")


def grid_of(left: DataFrame, right: DataFrame, on: str, how: str, left_rows: int, right_rows: int) -> DataFrame:
    """(on, salts, chunks) of the keys that are hot on a side or whose rows multiply too much for one task.

    Each side is cut by its own count of that key; where one cell would still give more than ``OUT_ROWS``
    rows, the left side is cut further. Only an inner join cuts the right side: a left row that meets some
    chunks only has no partner elsewhere.
    """
    if how != "inner":
        return key_cuts(left, on, left_rows, _SALTS).withColumn(_CHUNKS, F.lit(1))
    count = lambda df, n: df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias(n))
    both = count(left, "__l").join(count(right, "__r"), on)
    parts = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    cell = F.col("__l") * F.col("__r") / F.col(_CHUNKS) / OUT_ROWS
    return (
        both.withColumn(_CHUNKS, parts("__r", right_rows))
        .withColumn(_SALTS, F.least(F.greatest(parts("__l", left_rows), F.ceil(cell)), F.col("__l")).cast("int"))
        .where((F.col(_SALTS) > 1) | (F.col(_CHUNKS) > 1))
        .select(on, _SALTS, _CHUNKS)
    )


def on_grid(left: DataFrame, right: DataFrame, grid: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells of the grid: left rows of a hot key go to one of its salts, right rows to
    one of its chunks; each is repeated along the other axis, so every pair meets once.
    """
    hint = bounded_broadcast(grid, 4 * BROADCAST_ROWS)
    n = lambda c: F.coalesce(F.col(c), F.lit(1))
    along = lambda c: F.explode(F.sequence(F.lit(0), n(c) - 1))
    placed = []
    for side, own, own_n, other, other_n in (
        (left, _SALT, _SALTS, _CHUNK, _CHUNKS),
        (right, _CHUNK, _CHUNKS, _SALT, _SALTS),
    ):
        cut = side.withColumn("__slot", _slot(side, F.lit(2**31 - 1))).join(hint, on, "left")
        cut = cut.withColumn(own, F.pmod("__slot", n(own_n))).withColumn(other, along(other_n))
        placed.append(cut.drop("__slot", _SALTS, _CHUNKS))
    return placed[0], placed[1]


def may_have_partner(left: DataFrame, right: DataFrame, on: str, most_keys: int = FILTER_KEYS) -> DataFrame:
    """``left`` without most of the rows that have no partner in ``right``; it loses none that has one.

    A Bloom filter with one hash: the distinct keys of ``right`` set bits of a bitmap with ``FILTER_BITS`` per key, kept as 4 kB pieces by
    number, which are broadcast. A row without a partner passes if its bit is set by another key: one in ``FILTER_BITS``. With more
    than ``most_keys`` distinct keys, counted first, nothing is filtered.
    """
    keys = right.select(on).where(F.col(on).isNotNull()).distinct()
    n = keys.limit(most_keys + 1).count()
    if n > most_keys:
        return left
    if not n:
        return left.where(F.lit(False))
    bit = F.pmod(F.xxhash64(on), F.lit(FILTER_BITS * n))
    pieces = (
        keys.groupBy(F.bitmap_bucket_number(bit).alias("__piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits"))
    )
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (place % 8).cast("int")) == 1
    held = left.withColumn("__piece", F.bitmap_bucket_number(bit)).join(F.broadcast(pieces), "__piece")
    return held.where(is_set).drop("__piece", "__bits")


def _grid_join(left, right, on, how, left_rows, right_rows):
    if how == "inner":
        left = may_have_partner(left, right, on)
    grid = stage(grid_of(left, right, on, how, left_rows, right_rows), "hot-keys")
    if grid.isEmpty():
        return left.join(right, on, how)
    left, right = on_grid(left, right, grid, on)
    return left.join(right, [on, _SALT, _CHUNK], how).drop(_SALT, _CHUNK)
