"""Spark session settings every product relies on."""

from __future__ import annotations

import math
import os

from pyspark.sql import SparkSession

# Session settings the products assume: ANSI arithmetic (overflow raises, as in
# the reference's warehouse), UTC session clock, adaptive execution with skew
# splitting, and a broadcast threshold that is the size guard for dimensions.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


MAX_PARTITIONS = 32_768


def cluster_conf(input_bytes: int, buckets: int | None = None, partition_bytes: int = 256 * 1024 * 1024,
                 broadcast_bytes: int = 64 * 1024 * 1024) -> dict[str, str]:
    """Settings sized for a cluster reading ``input_bytes`` of sources.

    ``input_bytes`` is what the largest single shuffle carries, not the whole
    warehouse: one partition of it holds about ``partition_bytes`` (AQE
    coalesces small ones and splits skewed ones). More than
    ``MAX_PARTITIONS`` would mean more shuffle blocks than a cluster can track,
    so beyond that partitions grow. With the bucketed account layout there are
    exactly as many partitions as buckets: with more, Spark would exchange the
    bucketed fact to the side with more partitions; with as many, only the
    other side of an account join moves."""
    parts = min(MAX_PARTITIONS, max(200, math.ceil(input_bytes / partition_bytes)))
    if buckets:
        parts = buckets
    return {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.sources.bucketing.enabled": "true",
        # runtime bloom filters prune the account fact by a selective small
        # side (sale portfolios in D03, requests in D12, complaints in D06)
        # before any shuffle; allow creation sides up to the broadcast size
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(broadcast_bytes),
    }


def apply_conf(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline",
                driver_memory: str = "8g", warehouse_dir: str | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    for k, v in {**SESSION_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sf_dir_default() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
