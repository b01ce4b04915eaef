"""Session factory and the folder that jobs may share between executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from functools import cache

from pyspark.sql import SparkSession

# Every result is defined in UTC with ANSI on; the rest keeps Spark re-planning by real sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
}


def get_spark(
    app_name: str = "millrace",
    conf: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """One session for the whole program; operators only ever receive it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def snapshot_catalog_conf(warehouse: str, catalog: str = "spark_catalog") -> dict[str, str]:
    """Settings for an Iceberg catalog kept as folders under ``warehouse``.

    Needs the public Iceberg runtime jar on the class path.
    """
    # The class names and keys the public table format documents.
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkSessionCatalog",
        f"{prefix}.type": "hadoop",
        f"{prefix}.warehouse": warehouse,
    }


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``. Only a local master, where all
    tasks live on one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
