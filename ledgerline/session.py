"""Session helpers for tests, the benchmark and local runs.

On a cluster the session comes from the caller; ``ensure_checkpoint_dir``
only fills ``spark.checkpoint.dir`` when the cluster left it unset (tests and
local runs), so a shared folder named by the cluster is always used as is.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline") -> SparkSession:
    builder = SparkSession.builder
    event_dir = os.environ.get("LEDGERLINE_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings for profiling, read from files (no UI)
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_dir))
    spark = (builder.master(f"local[{cores}]").appName(app)
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(total_cores: int, fact_bytes: int) -> dict[str, str]:
    """Suggested settings for a cluster run, sized from the core count and the
    size of the transaction input.

    Shuffle partitions target ~128 MB each (never fewer than 3 per core) so a
    partition fits an executor's memory share without spilling; AQE coalesces
    small ones and splits skewed join partitions at run time.
    """
    target = 128 * 1024 * 1024
    partitions = max(3 * total_cores, fact_bytes // target + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a scratch one only when unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query ends. Else they stay until the driver
    happens to collect its garbage, and a run of many writes holds all of its shuffles on disk."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
