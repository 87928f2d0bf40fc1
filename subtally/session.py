"""Session settings the engine relies on, and the shared folder it writes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on UTC and on ANSI casts (bad input raises instead of turning into NULL).
# forceOptimizeSkewedJoin lets AQE split a hot join key even when the next operator then needs
# one more exchange; that exchange is far cheaper than a third of all rows in one task.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parsing documents is CPU work: when a shuffle is small, spread it over the cores anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "subtally", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; cluster sizing stays with spark-submit, ``conf`` overrides for tests."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, under ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such a folder would
    exist on one machine and vanish with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="subtally-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
