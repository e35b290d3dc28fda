from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, sort: list[str] | None = None, blooms: tuple[str, ...] = ()) -> None:
    """Parquet. ``sort``: order of the rows inside each file, so that filters on the first of these columns skip
    row groups and pages; ``blooms``: columns with a bloom filter per row group. Neither moves rows.
    """
    placed = df.sortWithinPartitions(*sort) if sort else df
    writer = placed.write.mode("overwrite")
    for column in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def in_ranges(df: DataFrame, column: str) -> DataFrame:
    """``df`` in ranges of ``column``, one per core, each sorted by it: the rows keep their order, and a write
    that follows runs in as many tasks as there are cores.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(parts, column).sortWithinPartitions(column)


def write_partitioned(df: DataFrame, path: str, columns: list[str], clustered: bool = False) -> None:
    """Parquet in one folder per value of ``columns``.

    Rows are brought together by folder first, so that a folder gets few files; a
    folder too large for one task is split. ``clustered``: the rows are sorted by these
    columns already, so they are written where they are.
    """
    placed = df if clustered else df.hint("rebalance", *columns)
    placed.write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks inside fields are kept."""
    df.write.mode("overwrite").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """Print the first rows of ``df``, and return them."""
    head = df.limit(rows)
    head.show(rows, truncate=False)
    return head
