"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.operators.staging import discard, scratch_path, stage

__all__ = ["discard", "fresh_folder", "held_out", "letters", "slices", "stage", "table"]

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder nobody has used yet below ``spark.checkpoint.dir``."""
    return scratch_path(spark, name)


def unique_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}"


def held_out(doc_id, modulus: int, remainder: int):
    """True where crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(
        F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder,
        F.lit(False),
    )


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES):
    """Cut Arrow batches so that ``column`` holds about ``most`` bytes in each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        ends = byte_ends(values)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_ends(values: pa.Array):
    """Running total of the bytes of a string or binary column (null: 0)."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype("int64").cumsum()


def letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def bounded_batches(spark: SparkSession, most: int = 32 << 20) -> None:
    """Bound the Arrow batches that tasks get in bytes, unless the session bounds them already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > 1 << 30:
        spark.conf.set(key, str(most))
