"""Sync state: one tiny row per finished sync, written after all of its files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from subtally.sources.tables import versions


def save_state(spark: SparkSession, root: str, cursor: int, last_sync: str) -> None:
    """A crash before this line makes the next sync read the same window again, which is harmless."""
    row = spark.range(1).selectExpr(f"{int(cursor)}L AS cursor", f"'{last_sync}' AS last_sync")
    row.write.mode("overwrite").json(f"{root}/at={last_sync}")


def load_state(spark: SparkSession, root: str) -> dict:
    """The latest state, or {} when nothing was ever synced, which asks for a full load."""
    done = versions(spark, root, label="at")
    if not done:
        return {}
    row = spark.read.schema("cursor bigint, last_sync string").json(f"{root}/at={done[-1]}").first()
    return {"cursor": row["cursor"], "last_sync": row["last_sync"]}
