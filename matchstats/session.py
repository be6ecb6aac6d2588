"""Runtime SQL settings the operators are designed for."""

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions, turns joins into broadcasts only after
# the real size of a side is known, and splits skewed join partitions.  The force flag lets it
# split a hot match even when an aggregation would have reused the join's partitioning.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # What a task sorts and aggregates is some forty times what it fetches, as a line becomes nine facts:
    # so much is fetched at most, whatever the size of the input.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes of stored tables for each partition that a shuffle is dealt into; small ones are merged again.
BYTES_EACH = 3 << 20


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the adaptive settings to a running session and return it.

    The number of shuffle partitions grows with ``input_bytes``, the size of the stored tables; it is the
    session's ``spark.sql.shuffle.partitions`` at least.
    """
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    wanted = input_bytes // BYTES_EACH
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(PARTITIONS, str(wanted))
    else:
        spark.conf.unset(PARTITIONS)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written intermediates, in the cluster's shared folder.

    Only a local master, where driver and executors share their disk, may do without
    ``spark.checkpoint.dir``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/matchstats-{name}-{uuid4().hex}"
