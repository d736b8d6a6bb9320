"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything a job relies on; the rest is left to the cluster's own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Call-site capture of every expression, a debugging aid, costs seconds on wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "feedweave", cpus: str = "8", shared: str | None = None) -> SparkSession:
    """A single-machine session for the benchmark; ``shared`` is its folder for intermediate tables."""
    shared = shared or tempfile.mkdtemp(prefix="feedweave-")
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, the folder that driver and executors share.

    Only where driver and executors are one process may a folder of the machine stand in for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="feedweave-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
