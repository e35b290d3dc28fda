from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..schemas import WIND_SCALE, WIND_SCALE_SCHEMA


def wind_scale_table(spark: SparkSession, scale=WIND_SCALE) -> DataFrame:
    """The scale as a local relation: the planner knows its size, and no Python rows are scanned."""
    columns = dict(zip(WIND_SCALE_SCHEMA.names, map(list, zip(*scale))))
    return spark.createDataFrame(pa.table(columns), WIND_SCALE_SCHEMA)


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """Parquet at ``path``, which may be a glob."""
    return spark.read.parquet(path)
