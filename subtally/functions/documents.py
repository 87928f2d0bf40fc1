"""Parsing billing documents, and SQL expressions that read values inside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_once(df: DataFrame, text: str, schema: str, name: str) -> DataFrame:
    """Add a parsed document as a struct column that is computed exactly once per row.

    As a plain projection, every filter on a parsed field, also those the optimizer infers from join
    keys, would move below it and parse the document again. A generator of one element is a step no
    filter passes. Text that isn't a document raises; NULL stays NULL.
    """
    parsed = F.from_json(text, " ".join(schema.split()), {"mode": "FAILFAST"})
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def epoch(text: str) -> str:
    """Epoch seconds to a UTC timestamp."""
    return f"timestamp_seconds(cast({text} AS bigint))"


def cents(text: str) -> str:
    """Integer cents to DECIMAL(12,2) without passing through a double."""
    return f"cast(cast(cast({text} AS int) AS decimal(18,2)) / 100 AS decimal(12,2))"


def first_item(items: str) -> str:
    """Element 0, or NULL for an empty or missing array (plain indexing raises under ANSI)."""
    return f"get({items}, 0)"
