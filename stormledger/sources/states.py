from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import text_schema

STATE_KEYS = ["State", "State Code", "Region", "Division"]
_CORRUPT, _OVERFLOW = "__corrupt", "__overflow"


def _plain(name: str) -> str:
    """A name without case, blanks and underscores."""
    return re.sub(r"[\s_]+", "", name).lower()


def _under_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The columns of ``df`` that are meant by ``keys``, under these names and in their order.

    Several spellings of a key (in different records) are one column; an absent key is NULL.
    """
    spellings = {k: [F.col(f"`{c}`") for c in df.columns if _plain(c) == _plain(k)] for k in keys}
    if not any(spellings.values()):
        raise ValueError(f"none of {keys} among the columns {df.columns}")
    text = F.lit(None).cast("string")
    return df.select(*(F.coalesce(*found, text).cast("string").alias(k) for k, found in spellings.items()))


def read_states_json(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """JSON records, one per line or all in one array, with the keys of the data (read once to find them).

    ``keys``: which are wanted; ``State Code``, ``state_code`` and ``STATE CODE`` are the same key.
    """
    records = spark.read.option("primitivesAsString", "true").json(path)
    return _under_keys(records, keys or STATE_KEYS)


def read_states_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV by its header. Lines with too many fields are skipped, short ones filled with NULL.

    ``columns``: which are wanted, spelled as in :func:`read_states_json`. Files with different headers raise.
    """
    names = spark.read.csv(path, header=True).columns
    schema = text_schema([*names, _CORRUPT])
    lines = spark.read.schema(schema).csv(
        path, header=True, enforceSchema=False, columnNameOfCorruptRecord=_CORRUPT
    )
    wider = ", ".join(f"f{i} string" for i in range(len(names))) + f", {_OVERFLOW} string"
    overflow = F.from_csv(_CORRUPT, wider)[_OVERFLOW]
    kept = lines.where(F.col(_CORRUPT).isNull() | overflow.isNull())
    return _under_keys(kept.drop(_CORRUPT), columns or STATE_KEYS)
