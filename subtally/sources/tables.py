"""Versioned Parquet tables: every write is a new folder, readers take the newest complete one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names inside a folder on whatever file system the path belongs to; [] when it is missing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of names, on whatever file system it belongs to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def plain_path(spark: SparkSession, folder: str) -> str:
    """The folder's absolute path without scheme, host and URL escapes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().getPath().rstrip("/")


def changed_at(spark: SparkSession, folder: str) -> dict[str, int]:
    """By name when each entry of a folder was last changed; file systems that don't keep that for folders say 0."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path)} if fs.exists(path) else {}


def object_folders(spark: SparkSession, root: str) -> list[str]:
    """Object types present under a landing root, sorted."""
    return [name for name in children(spark, root) if not name.startswith(("_", "."))]


def versions(spark: SparkSession, root: str, label: str = "version") -> list[str]:
    """Complete versions in order; a folder without the commit marker is a crashed write."""
    names = [n for n in children(spark, root) if n.startswith(f"{label}=")]
    done = [n for n in names if "_SUCCESS" in children(spark, f"{root}/{n}")]
    return [n.removeprefix(f"{label}=") for n in done]


def write_version(df: DataFrame, root: str, version: str, keep: int = 2) -> None:
    """Write a version; readers see it once the commit marker is there. Version names must sort.

    Then all but the newest ``keep`` versions go, so that a reader of the one before can finish.
    """
    df.write.mode("overwrite").parquet(f"{root}/version={version}")
    drop_versions(df.sparkSession, root, versions(df.sparkSession, root)[:-keep])


def drop_versions(spark: SparkSession, root: str, names: list[str], label: str = "version", joint: str = "=") -> None:
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{label}{joint}{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_current(spark: SparkSession, root: str, before: str | None = None) -> DataFrame | None:
    """The newest complete version (older than ``before`` when given), or None."""
    known = [v for v in versions(spark, root) if before is None or v < before]
    return spark.read.parquet(f"{root}/version={known[-1]}") if known else None


def save_mart(df: DataFrame, root: str, name: str, version: str = "only") -> DataFrame:
    """Materialise a mart and read it back, so every consumer scans columns instead of recomputing.

    A crash leaves the version before it in force.
    """
    write_version(df, f"{root}/{name}", version)
    return df.sparkSession.read.parquet(f"{root}/{name}/version={version}")


def load_marts(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    found = {name: read_current(spark, f"{root}/{name}") for name in names}
    missing = [name for name, frame in found.items() if frame is None]
    if missing:
        raise ValueError(f"never built under {root}: {missing}")
    return found


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Staging stays a view: inlined into whatever reads it."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
