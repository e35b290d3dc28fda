from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_name_lines(spark: SparkSession, path: str, pattern: str = "*.TXT") -> DataFrame:
    """Lines of all name files at or below ``path`` (which may be a glob), as ``value``.

    Only files whose name fits ``pattern`` are read.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return reader.text(path)
