"""Session helpers and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app_name: str = "laptrace", cores: int | str = "*", shuffle_partitions: int = 8,
                  **extra: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the parsing plans profit from; safe on any session.

    HotSpot does not compile methods above 8000 bytes of bytecode.  Fused stages that parse
    several text columns can exceed that and then run interpreted; with this limit Spark
    compiles such a stage expression by expression instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can see, named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one temporary folder per session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_dir(spark.sparkContext.applicationId)


@cache
def _local_dir(_application: str) -> str:
    return tempfile.mkdtemp(prefix="laptrace-")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
