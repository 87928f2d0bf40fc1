"""Secret scans with an incremental blob ledger.

Every text is a blob named by its content. The ledger holds the findings of each blob under each version of the rules,
so a scan reads only the blobs that this version of the rules hasn't seen, each once however many documents have it,
and joins the findings back to all documents. Everything is DataFrame expressions.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules by name, in order; the first three are the base. A rule has a pattern and, for one, the least
# size of its second group. Patterns without a group take a match whole.
RULES = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0),
    "hex": (r"[0-9a-f]{16,}", 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0),
    "slack": (r"xox[abprs]-[0-9A-Za-z-]{10,}", 0),
    "private_key": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0),
}
BASE = ("assign", "access", "hex")
SPANS = "array<struct<start:int,kind:int,end:int>>"


def rules_version(rules: dict = RULES) -> str:
    return hashlib.sha256(repr(sorted(rules.items())).encode()).hexdigest()[:16]


def blob_name(text: str = "text") -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def found_by(kind: int, pattern: str, least: int) -> Column:
    """For each match of a rule in ``text``: the size of what lies between it and the one before, its own, and if it counts."""
    p = F.lit(pattern)

    def match(gap: Column, own: Column) -> Column:
        counts = F.length(F.regexp_extract(own, pattern, 2)) >= least if least else F.lit(True)
        return F.struct(F.length(gap).alias("gap"), F.length(own).alias("size"), counts.alias("counts"))

    matches = F.zip_with(F.split("text", pattern, -1), F.regexp_extract_all("text", p, F.lit(0)), match)
    return F.when(F.col("text").rlike(pattern), F.struct(F.lit(kind).alias("kind"), matches.alias("matches")))


def findings(blobs: DataFrame, rules: dict = RULES) -> DataFrame:
    """(blob, spans) of rows (blob, text) with a finding; spans count characters, the end is exclusive.

    A match's place is the running sum of the sizes before it, so the work grows with the number of matches.
    """
    each = F.array(*(found_by(kind, pattern, least) for kind, (pattern, least) in enumerate(rules.values())))
    rows = (
        blobs.select("blob", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("rule"))
        .select("blob", F.col("rule.kind").alias("kind"), F.posexplode("rule.matches").alias("pos", "match"))
        .filter("match.size IS NOT NULL")
        .selectExpr("blob", "kind", "match.size AS size", "match.counts AS counts", "CAST(SUM(match.gap + match.size) OVER (PARTITION BY blob, kind ORDER BY pos) AS INT) AS end")
        .filter("counts")
    )
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "kind", "end")
    return rows.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))


class Ledger:
    """A table (version, blob, spans) under a path that all executors share; spans are empty where nothing was found."""

    def __init__(self, spark: SparkSession, path: str, rules: dict = RULES):
        self.spark, self.path, self.rules, self.version = spark, path.rstrip("/"), rules, rules_version(rules)

    def entries(self) -> DataFrame:
        """(blob, spans) of all blobs that this version of the rules has seen, each once: scans that overlap in time may both
        have appended a blob, with the same spans.
        """
        schema = f"blob string, spans {SPANS}, version string"
        try:
            rows = self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)  # nothing was ever scanned
        # By both columns: grouped by the blob alone, a join on it would bring a common text's rows to one task.
        return rows.filter(F.col("version") == self.version).drop("version").distinct()

    def scan(self, docs: DataFrame) -> None:
        """Scans what is unseen among the texts of ``docs`` and appends it; a run that fails appends nothing."""
        blobs = docs.select(blob_name().alias("blob"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
        unseen = blobs.join(self.entries().select("blob"), "blob", "left_anti")
        found = findings(unseen, self.rules)
        # One row per unseen blob, found or not, without carrying the texts on.
        rows = unseen.select("blob").join(found, "blob", "left")
        spans = F.coalesce("spans", F.array().cast(SPANS))
        rows.select("blob", spans.alias("spans"), F.lit(self.version).alias("version")).write.mode("append").partitionBy("version").parquet(self.path)


def with_findings(docs: DataFrame, ledger: Ledger) -> DataFrame:
    """The rows of ``docs`` with ``blob`` and ``spans`` (start, kind, end), by start and then kind.

    A null text counts as empty and has no finding. A text of any length is scanned whole, as one row. Equal texts,
    repeated rows among them, share one scan. Columns of
    ``docs`` named blob or spans are replaced.
    """
    ledger.scan(docs)
    return docs.drop("blob", "spans").withColumn("blob", blob_name()).join(ledger.entries(), "blob")


def joined_spans(spans: Column, names: tuple[str, ...] = tuple(RULES)) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, names))
    texts = F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(texts, ",")


def digest_columns(found: DataFrame) -> DataFrame:
    def of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda x: x["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *(of(kind).alias(f"n_{name}") for kind, name in enumerate(BASE)),
        F.sha2(joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def masked(found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``text`` with every finding replaced by a mark; spans that overlap are covered by one."""
    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))

    def step(state: Column, x: Column) -> Column:
        gap = F.col("text").substr(state["at"] + 1, F.greatest(x["start"] - state["at"], F.lit(0)))
        here = F.when(x["start"] >= state["at"], F.concat(gap, F.lit(mark))).otherwise("")
        return F.struct(F.concat(state["kept"], here).alias("kept"), F.greatest(state["at"], x["end"]).alias("at"))

    def finish(state: Column) -> Column:
        return F.concat(state["kept"], F.col("text").substr(state["at"] + 1, F.length("text")))

    text = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, finish)).otherwise(F.col("text"))
    return found.withColumn("text", text)
