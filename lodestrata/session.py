"""Session construction for local runs, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "lodestrata", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench, with a folder of its own for written tables.

    On a cluster, pass your own session instead.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lodestrata-"))
        .getOrCreate()
    )


def use_folder(spark: SparkSession, path: str) -> None:
    """Name the shared folder of an application whose settings do not."""
    _FOLDERS[spark.conf.get("spark.app.id", "")] = path


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``; without one it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _FOLDERS.get(spark.conf.get("spark.app.id", ""))
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{shared_folder(spark)}/lodestrata/{label}-{uuid.uuid4().hex}"
