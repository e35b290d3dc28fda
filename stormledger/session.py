"""Session builder (optional: every function also takes a session made elsewhere)."""

from __future__ import annotations

from pyspark.sql import SparkSession

COMMIT_ALGORITHM = "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version"
PARTITION_BYTES = 128 * 1024 * 1024
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def create_session(
    app_name: str = "stormledger",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    hive: bool = False,
    fast_commit: bool = False,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """Get or create a session. ``conf`` entries win over the defaults above.

    ``fast_commit`` moves output files when a task ends instead of when the job ends:
    faster where renames are slow, but a job that dies leaves some of its files behind.
    ``shuffle_bytes`` is what the largest shuffle moves: partitions start at about
    128 MB each, and adaptive execution merges those that turn out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULT_CONF, **(conf or {})}
    if fast_commit:
        settings[COMMIT_ALGORITHM] = "2"
    if shuffle_bytes:
        partitions = max(200, shuffle_bytes // PARTITION_BYTES)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
