"""Session construction and the runtime settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Every setting here can be changed on a live session. A join whose hot key
# overfills one partition is split at run time, even where the split costs one
# more shuffle (forceOptimizeSkewedJoin acts only when skew was measured). Catalogue
# tables up to the given size are broadcast; Spark compares it with the size of the
# files, or with what a shuffle measured, and sorts and merges anything larger.
RUNTIME_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


PARTITION_BYTES = 128 << 20


def partitions_for(input_bytes: int) -> int:
    """Shuffle partitions of about 128 MB; adaptive execution merges smaller ones."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app_name: str = "tallystick",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the web UI off; on a cluster leave ``master`` to spark-submit.

    ``input_bytes``, the size of the fact tables, sets the number of shuffle partitions:
    adaptive execution merges small ones but does not split those of an aggregate.
    """
    if shuffle_partitions is None and input_bytes is not None:
        shuffle_partitions = partitions_for(input_bytes)
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())
