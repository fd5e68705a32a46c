"""A session with the settings the jobs rely on (tests, bench, local runs)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(
    app: str = "deskweave", cpus: int | None = None, shared: str | None = None
) -> SparkSession:
    """A local session; `shared` sets spark.checkpoint.dir. On a cluster pass your own session."""
    cpus = cpus or os.cpu_count() or 1
    builder = SparkSession.builder
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
