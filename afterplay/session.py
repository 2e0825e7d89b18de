"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("afterplay")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All window arithmetic is on UTC days, so that a day is always 86 400 seconds."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder.

    Only a local master may fall back on a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="afterplay-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
