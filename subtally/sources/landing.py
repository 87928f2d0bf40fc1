"""Landing files: what each sync leaves behind, one set of documents per object type."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subtally.functions.documents import parse_once
from subtally.sources.tables import children, plain_path

# The object types of the billing API and the folder each one lands in.
OBJECT_FOLDERS = {
    "customer": "customers",
    "subscription": "subscriptions",
    "invoice": "invoices",
    "charge": "charges",
}
# The folder name that marks the line form.
LINES = "sync_ts="
# Documents that a file of the line form holds at most; of half a kilobyte each these are what a split has of plain text.
FILE_LINES = 250_000
OBJECT_TYPES = ("charges", "customers", "events", "invoices", "subscriptions")


def in_utc(at: datetime) -> datetime:
    """A time without a zone counts as UTC."""
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def folder_stamp(at: datetime) -> str:
    """What a sync's folder or file is called: sorting by name is sorting by time, e.g. 2031-04-17T08-09-10Z."""
    return f"{in_utc(at):%Y-%m-%dT%H-%M-%SZ}"


FAIL = {"mode": "FAILFAST"}  # a document that can't be read stops the run; none is left out


def relative_file(folder: str) -> Column:
    """Path below the scanned folder, without the names of partition folders: what comes later sorts later.

    Spark reports paths with URL escapes, so they are undone first; a plus sign is one.
    """
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    path = F.regexp_replace(F.url_decode(escaped), r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "")
    root = plain_path(SparkSession.active(), folder)
    below = F.substring(path, len(root) + 2, 1 << 20)
    # A file system may answer under another root than it was asked for.
    elsewhere = F.substring_index(path, f"/{root.rsplit('/', 1)[-1]}/", -1)
    return F.regexp_replace(F.when(F.startswith(path, F.lit(f"{root}/")), below).otherwise(elsewhere), r"(^|/)\w+=", "$1")


def sync_of(file: str = "file") -> Column:
    """The sync that a file belongs to: its first folder, or in a flat layout the file itself."""
    return F.regexp_replace(F.substring_index(F.col(file), "/", 1), r"\.json$", "")


def explode_array_files(files: DataFrame) -> DataFrame:
    """(file, value = a whole JSON array) to (file, pos, data): one row per element.

    Elements stay JSON text: no schema is inferred, so a key that first appears in the last document of the last file
    survives. A file that is no whole array raises.
    """
    return files.select("file", F.posexplode(F.from_json("value", "array<string>", FAIL)).alias("pos", "data")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def with_id(rows: DataFrame) -> DataFrame:
    """Rows (file, pos, id, data) of the documents that have an id, parsed once; text that isn't a document raises."""
    parsed = parse_once(rows.select("file", "pos", "data"), "data", "struct<id:string>", "d")
    return parsed.select("file", "pos", F.col("d.id").alias("id"), "data").filter(F.col("id").isNotNull())


def array_files(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """(file, value) of every file, or of those entries of the folder that ``names`` lists, each read whole."""
    text = spark.read.option("recursiveFileLookup", True).text(paths(folder, names), wholetext=True)
    return text.select(relative_file(folder).alias("file"), "value")


def paths(folder: str, names: list[str] | None) -> list[str]:
    return [folder] if names is None else [f"{folder}/{name}" for name in names]


# Fixed value: what stands before every element but the first of an array file as syncs write it, indented by two. Text
# inside an element is indented further, and a string holds no line break.
BETWEEN = ",\n  {"


def array_elements(
    spark: SparkSession, folder: str, names: list[str] | None = None, ended: Observation | None = None
) -> DataFrame:
    """(file, pos, data) of every element of every array file; a file of the landing form is read by as many tasks as it
    has splits.

    The text between two separators is an element without its opening brace. Other forms hold no separator, so such a
    file is one row and one task. A file cut off inside an element leaves text that is no document, which raises; one cut
    off between two elements has no end, and ``ended`` observes as ``files`` how many have one. ``pos`` rises with the
    place in the file: the index in a file that is one row, else the first byte of the split and the count of elements
    in the task, which is always less than the bytes of a split.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", BETWEEN)
    count = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    text = reader.text(paths(folder, names)).select(
        relative_file(folder).alias("file"),
        F.regexp_replace("value", r"\s+$", "").alias("value"),
        (F.col("_metadata.file_block_start") + count).alias("_place"),
    )
    closes = F.endswith("value", F.lit("}\n]"))
    opens = F.startswith("value", F.lit("[\n  {"))
    # A list that opens here and isn't cut by a separator: what comes before its last bracket isn't an element's own list.
    whole = F.startswith("value", F.lit("[")) & F.col("value").rlike(r"(\n\]|[^\s\[]\]|^\[\s*\])$")
    ends = whole | (~F.startswith("value", F.lit("[")) & closes)
    if ended is not None:
        text = text.observe(ended, F.count_if(ends).alias("files"))
    begun = F.when(opens | whole, F.col("value")).otherwise(F.concat(F.lit("[{"), "value"))
    lists = text.select("file", "_place", whole.alias("_whole"), F.when(ends, begun).otherwise(F.concat(begun, F.lit("]"))).alias("value"))
    elements = lists.select("file", "_place", "_whole", F.posexplode(F.from_json("value", "array<string>", FAIL)).alias("pos", "data"))
    return elements.select("file", F.when(F.col("_whole"), F.col("pos").cast("bigint")).otherwise(F.col("_place")).alias("pos"), "data")


def raw_scan(
    spark: SparkSession, folder: str, names: list[str] | None = None, ended: Observation | None = None
) -> DataFrame:
    """Rows (file, pos, id, data) of every JSON-array file of one object type."""
    return with_id(array_elements(spark, folder, names, ended))


def files_of(spark: SparkSession, folder: str, names: list[str] | None = None) -> int:
    return len(spark.read.option("recursiveFileLookup", True).text(paths(folder, names)).inputFiles())


def write_landing(df: DataFrame, root: str, object_type: str, sync_ts: str) -> str:
    """Land (pos, data) rows of one type and one sync as JSON lines, compressed.

    Documents repeat their keys, so they take a fraction of their text. A compressed file is read by one task, so none
    holds more than ``FILE_LINES``. Overwriting the sync's own folder makes a repeated sync harmless.
    """
    path = f"{root}/{object_type}/{LINES}{sync_ts}"
    lines = df.select(F.col("pos").cast("bigint").alias("pos"), "data").write.mode("overwrite")
    lines.option("maxRecordsPerFile", FILE_LINES).json(path, compression="gzip")
    return path


def scan_landing(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Rows (file, pos, id, data) of the line form; the sync folder plays the part of the file name."""
    reader = spark.read.schema("pos bigint, data string, sync_ts string").options(basePath=folder, **FAIL)
    return with_id(reader.json(paths(folder, names)).withColumnRenamed("sync_ts", "file"))


def entries(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder of one object type: files or the folders of syncs."""
    return [name for name in children(spark, folder) if not name.startswith(("_", "."))]


def scan(
    spark: SparkSession, folder: str, names: list[str] | None = None, ended: Observation | None = None
) -> DataFrame:
    """Rows (file, pos, id, data) of a folder in either form, told apart by its entries; ``names`` picks some of these.

    ``ended`` is observed where the folder holds array files.
    """
    found = entries(spark, folder) if names is None else names
    lines = [name for name in found if name.startswith(LINES)]
    if lines and len(lines) < len(found):
        raise ValueError(f"{folder} holds both landing forms: {found[:5]}")
    return scan_landing(spark, folder, names) if lines else raw_scan(spark, folder, names, ended)
