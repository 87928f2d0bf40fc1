"""From raw documents to packed training sequences: five stages, each on all rows that the one before it kept.

Columns of documents are carried through to the last stage; n_chars follows the text where a stage changes it. Rows
with null ids or texts, repeated rows and empty tables pass through every stage with the results its operator defines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtally.llm import chunks, packing, quality, secrets, simhash
from subtally.llm.common import numbered, prepared, stored, table
from subtally.llm.queries import tokenizer
from subtally.session import shared_dir

def wrapped(docs: DataFrame) -> DataFrame:
    """(_doc, doc_id, text): the other columns in one struct, so that no name of theirs clashes with a stage's."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    return docs.select(others.alias("_doc"), "doc_id", "text")


def unwrapped(rows: DataFrame, columns: list[str], changed: bool = False) -> DataFrame:
    """The columns of documents again; n_chars, if there is one, counts the characters of a changed text."""

    def column(name: str) -> Column:
        own = F.col(f"_doc.`{name}`")
        return F.coalesce(F.length("text").cast("bigint"), own) if changed and name == "n_chars" else own

    return rows.select(*(F.col("text") if c == "text" else column(c).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. The forest and its threshold are fitted on what the stage is given."""
    own = wrapped(docs)
    statistics = stored(quality.with_statistics(own, "doc_id"), "stage-quality")
    verdict = quality.fit(statistics, table(spark, sf_dir, "labels"))
    return unwrapped(quality.passing_rows(own, verdict), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, and of rows that share it the first."""
    own = numbered(wrapped(docs))
    prints = stored(simhash.fingerprints(own, "_row", "doc_id"), "stage-prints")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")
    groups = simhash.near_duplicates(prints, by_root=True).groupBy("root")
    kept = groups.agg(F.min(order).alias("first")).select("first._row")
    return unwrapped(own.join(kept, "_row", "left_semi"), docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document, or earlier in the same one, are cut out of the text."""
    own = numbered(wrapped(docs))
    spans = stored(chunks.repeats(own, "_row"), "stage-repeats")
    return unwrapped(chunks.cut_out(own, spans, "_row"), docs.columns, changed=True)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; documents are kept."""
    ledger = secrets.Ledger(spark, shared_dir(spark, "stage-ledger"))
    found = secrets.masked(secrets.with_findings(wrapped(docs), ledger))
    return unwrapped(found, docs.columns, changed=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, as the packing operator returns them."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


# The workers of all stages live in one session, so here a batch is half of what an operator takes by itself.
STAGE_ROWS, STAGE_BYTES = "500", "8m"


def in_small_batches(spark: SparkSession) -> SparkSession:
    prepared(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", STAGE_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", STAGE_BYTES)
    return spark


def stage(function: Callable) -> Callable:
    def prepared_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = function(in_small_batches(spark), docs, sf_dir)
        in_small_batches(spark)  # reading a table sets an operator's own size again, and the rows are made after this
        return rows

    return prepared_stage


STAGES = [
    ("quality rules", stage(quality_rules)),
    ("simhash near-dedup", stage(near_duplicates)),
    ("substring dedup", stage(substring_dedup)),
    ("secret scans", stage(secret_scans)),
    ("packing", stage(packed)),
]

# A forest, XXH64 fingerprints, a rolling hash and a tokenizer: SQL can't express any stage but the scans.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written as Parquet in the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stored(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
