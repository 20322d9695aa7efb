"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Settings meant for a large cluster (100 TB inputs): AQE sizes shuffle
# partitions from measured map output, splits skewed join partitions, and
# runtime bloom filters prune the big side of selective joins.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def apply_scale_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set the cluster settings above (runtime SQL settings only)."""
    for k, v in {**SCALE_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for some statements; the session's own come back after them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "stormmart") -> SparkSession:
    """Session for local runs. On a cluster, use the cluster's own session."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster's setting wins. Only a local session without one gets a folder of
    its own: on a cluster each executor would write to its own disk, so a missing
    setting is an error there.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        current = default or os.path.join("/tmp", f"stormmart-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (staging tables, stream state)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
