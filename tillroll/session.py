"""Session settings, and the shared folder in which derived tables are written."""

from __future__ import annotations

import os
import re
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and measurements. On a cluster use the cluster's own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillroll")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    The folder must be visible to every executor, so that a table written there outlives the
    executors that wrote it. Only a single-machine session may go without the setting.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="tillroll-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/tillroll-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"
