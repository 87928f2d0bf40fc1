"""Tables in hash buckets, so that a write costs what it touches and not what the table holds.

    root/data/version=V/bucket=K/part-...    what a write put into the buckets that it touched
    root/manifest/version=V                  for every bucket the version that has its rows; written last, so it commits

A reader takes the newest complete manifest and lists the folders that it names. A crash leaves the manifest before it in
force. Folders that none of the newest manifests names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from subtally.session import shared_dir
from subtally.sources.tables import children, drop_versions, versions

# Buckets of a new table. One should hold about as much as a file should; a table keeps the number that it began with.
BUCKETS = 64


def bucket_of(key: str, n: int) -> Column:
    """A NULL key has a bucket like any other."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("bucket")


def manifest(spark: SparkSession, root: str, before: str | None = None) -> dict[int, str | None]:
    """By bucket the version that has its rows, None for an empty one; {} for a table that was never written."""
    known = [v for v in versions(spark, f"{root}/manifest") if before is None or v < before]
    if not known:
        return {}
    rows = spark.read.schema("bucket int, version string").json(f"{root}/manifest/version={known[-1]}")
    return {r["bucket"]: r["version"] for r in rows.collect()}  # a row per bucket


def read_buckets(
    spark: SparkSession, root: str, schema: str, before: str | None = None, only: Iterable[int] | None = None
) -> DataFrame:
    """The rows of the newest complete version (older than ``before``), of some buckets when ``only`` is given."""
    held = manifest(spark, root, before)
    wanted = held if only is None else {b: held.get(b) for b in only}
    paths = [f"{root}/data/version={v}/bucket={b}" for b, v in wanted.items() if v is not None]
    # Without a limit of none the planner would not know that there are no rows, and would shuffle and join them.
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema).limit(0)


def staged(df: DataFrame, key: str, n: int) -> tuple[DataFrame, list[int]]:
    """The rows written to the shared folder, with their column ``bucket``, and the buckets that there are.

    They are dealt by bucket when they are merged, so here every task writes one file.
    """
    path = shared_dir(df.sparkSession, "staged")
    df.withColumn("bucket", bucket_of(key, n)).write.parquet(path)
    schema = StructType([*df.schema.fields, StructField("bucket", IntegerType())])
    rows = df.sparkSession.read.schema(schema).parquet(path)
    return rows, sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # one row a bucket


def replace_buckets(root: str, version: str, rows: DataFrame, touched: Iterable[int], n: int, keep: int = 2) -> list[int]:
    """Makes ``rows``, which have a column ``bucket``, the content of the touched buckets; the others keep theirs.

    Repeating a write of the same version starts from the manifest before it. Returns the buckets written.
    """
    spark = rows.sparkSession
    touched = list(touched)
    held = manifest(spark, root, before=version) or dict.fromkeys(range(n))
    drop_versions(spark, f"{root}/manifest", [version])
    target = f"{root}/data/version={version}"
    rows.write.mode("overwrite").partitionBy("bucket").parquet(target)
    there = {int(name.removeprefix("bucket=")) for name in children(spark, target) if name.startswith("bucket=")}
    held |= {b: version if b in there else None for b in touched}
    listed = spark.createDataFrame(sorted(held.items()), "bucket int, version string")
    listed.coalesce(1).write.mode("overwrite").json(f"{root}/manifest/version={version}")
    drop_unnamed(spark, root, keep)
    return touched


def forget_after(spark: SparkSession, root: str, version: str) -> None:
    """Takes back what was written after a version, for a table that is one of several that change together."""
    newer = [v for v in versions(spark, f"{root}/manifest") if v > version]
    drop_versions(spark, f"{root}/manifest", newer)


def drop_unnamed(spark: SparkSession, root: str, keep: int) -> None:
    """Deletes manifests but the newest ``keep``, and every bucket folder that none of those names."""
    known = versions(spark, f"{root}/manifest")
    drop_versions(spark, f"{root}/manifest", known[:-keep])
    named: dict[str, set[int]] = {}
    for version in known[-keep:]:
        before = None if version == known[-1] else known[known.index(version) + 1]
        for b, v in manifest(spark, root, before).items():
            if v is not None:
                named.setdefault(v, set()).add(b)
    for name in children(spark, f"{root}/data"):
        version = name.removeprefix("version=")
        if version not in named:
            drop_versions(spark, f"{root}/data", [version])
            continue
        folders = [f.removeprefix("bucket=") for f in children(spark, f"{root}/data/{name}") if f.startswith("bucket=")]
        drop_versions(spark, f"{root}/data/{name}", [f for f in folders if int(f) not in named[version]], label="bucket")


def update_buckets(
    spark: SparkSession,
    root: str,
    version: str,
    batch: DataFrame,
    key: str,
    schema: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    n: int = BUCKETS,
) -> list[int]:
    """Merges a batch into the buckets of its keys: ``merge`` gets their old rows and the batch, both with ``bucket``.

    Its result has to be dealt by ``bucket`` for files of a good size. Returns the buckets written, all for a new table.
    """
    held = manifest(spark, root, before=version)
    n = len(held) or n
    # A new table has nothing to read; else the batch is written first, which tells the buckets that it touches.
    fresh, touched = staged(batch, key, n) if held else (batch.withColumn("bucket", bucket_of(key, n)), list(range(n)))
    old = read_buckets(spark, root, schema, before=version, only=touched).withColumn("bucket", bucket_of(key, n))
    return replace_buckets(root, version, merge(old, fresh), touched, n)
