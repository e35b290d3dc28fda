from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import REGION_SCHEMA


def read_regions(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Region outlines: ``state`` and ``ring`` (vertices with ``lat`` and ``lon``)."""
    return spark.read.schema(REGION_SCHEMA).format(kind).load(path)
