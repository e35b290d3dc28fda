"""Written intermediate tables in the cluster's shared folder.

A staged table cuts lineage: what is read back is fixed, whatever executors are
lost later. ``discard`` deletes one as soon as nothing reads it any more, and a ``staging_area`` all
that were staged inside it; tables behind a result that is not computed yet stay, like Spark's own checkpoint
files, until whoever owns the folder expires them.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_paths: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()

_area: ContextVar[list | None] = ContextVar("staging_area", default=None)

_local: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a local master (one machine) gets a folder of
    its own for the application; a cluster must set it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="stormledger-")
    return _local[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_folder(spark)}/stormledger/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    path = scratch_path(df.sparkSession, name)
    area = _area.get()
    if area is not None:
        area.append((df.sparkSession, path))
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[staged] = path
    return staged


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(staged: DataFrame) -> None:
    """Delete a table that ``stage`` returned. Nothing that is still to be computed may read it."""
    path = _paths.pop(staged, None)
    if path:
        _delete(staged.sparkSession, path)


@contextmanager
def staging_area() -> Iterator[None]:
    """Tables staged inside are deleted at the end, whether it comes by an error or not. Areas may be nested.

    What is computed from them has to be written before.
    """
    held: list = []
    token = _area.set(held)
    try:
        yield
    finally:
        _area.reset(token)
        for spark, path in held:
            _delete(spark, path)
