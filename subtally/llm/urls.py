"""URL filters: given rules by host and path first, then association rules that FP-growth mines from what those label.

Pages that a given rule fits are the labelled ones. Their URL tokens and their verdict are the transactions; frequent
token combinations that imply a verdict become rules for the pages no given rule fits. Everything is DataFrame
expressions and Spark's own FP-growth.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtally.llm.common import stored

ALLOW, BLOCK = "allow", "block"
VERDICT = "verdict="


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Mining:
    """A mined rule must hold for this share of the labelled pages, and be right for this share of those it fits."""

    min_support: float = 0.01
    min_confidence: float = 0.95


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
    the end. Both are empty where the url is null or has no ``://``."""
    place = F.instr(F.col(url), "://")
    rest = F.when(place > 0, F.col(url).substr(place + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fitting_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule for the page's host or a domain above it whose path begins the page's; else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the last one tried wins
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = host & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens(url: str = "url") -> Column:
    """What a URL is described by: nine kinds at most, so a page has at most 512 combinations. Numbers count as one."""
    labels = F.split("host", r"\.")
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    plain = F.transform(segments, lambda x: F.regexp_replace(x, r"[0-9]+", "0"))
    query = F.regexp_extract(F.col(url), r"\?([^#]*)", 1)
    keys = F.array_sort(F.array_distinct(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))))

    def kind(name: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(name + "="), value))

    found = F.array(
        kind("scheme", F.lower(F.substring_index(F.col(url), "://", 1))),
        kind("top", F.element_at(labels, -1)),
        kind("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")),
        kind("host", F.col("host")),
        kind("first", F.get(plain, 0)),
        kind("second", F.get(plain, 1)),
        kind("depth", F.least(F.size(segments), F.lit(9)).cast("string")),
        kind("query", F.array_join(keys, "&")),
        F.when(F.instr(F.col(url), "#") > 0, "fragment"),
    )
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.filter(found, lambda x: x.isNotNull()))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(tokens, verdict, confidence, support) of the rules that FP-growth finds in rows (tokens, verdict).

    Rules below the support or the confidence go, and so does a rule of which a part already says the same as surely.
    There are at most 512 / min_support frequent combinations, whatever the size of the input.
    """
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(VERDICT), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=mining.min_support, minConfidence=mining.min_confidence).fit(baskets)
    said = F.col("consequent")[0]
    rules = stored(
        model.associationRules.filter(said.startswith(VERDICT)).select(
            F.array_sort("antecedent").alias("tokens"), F.substring(said, len(VERDICT) + 1, 99).alias("verdict"), "confidence", "support"
        ),
        "url-rules",
    )
    part = rules.select(F.col("tokens").alias("part"), F.col("verdict").alias("part_verdict"), F.col("confidence").alias("part_confidence"))
    # Parts of a rule are found by their first token among the rule's.
    beside = rules.withColumn("own", F.explode("tokens")).join(F.broadcast(part.withColumn("own", F.col("part")[0])), "own")
    said_before = (
        beside.filter("verdict = part_verdict AND part_confidence >= confidence AND size(part) < size(tokens) AND size(array_except(part, tokens)) = 0")
        .select("tokens", "verdict")
        .distinct()
    )
    return rules.join(said_before, ["tokens", "verdict"], "left_anti")


def indexed(rules: DataFrame) -> DataFrame:
    """The rules by the one of their tokens that the fewest rules have, so that a page meets few rules it doesn't fit."""
    postings = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    each = rules.select("*", F.explode("tokens").alias("token")).join(postings, "token")
    chosen = each.groupBy("tokens", "verdict").agg(F.min(F.struct("n", "token")).alias("key"), F.first("confidence").alias("confidence"), F.first("support").alias("support"))
    return chosen.select(F.col("key.token").alias("token"), F.col("tokens").alias("needed"), "verdict", "confidence", "support")


def judged(described: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined) for the distinct token lists: the verdict of the surest rule that fits, then of the best
    supported, then of the longest, then block before allow. Lists that no rule fits are left out."""
    lists = described.select("tokens").distinct()
    index = F.broadcast(indexed(rules))  # at most 512 / min_support rows
    fits = lists.select("tokens", F.explode("tokens").alias("token")).join(index, "token").filter("size(array_except(needed, tokens)) = 0")
    order = F.struct("confidence", "support", F.size("needed").alias("n"), (F.col("verdict") == BLOCK).alias("b"), "needed")
    return fits.groupBy("tokens").agg(F.max_by("verdict", order).alias("mined"))


def filter_urls(pages: DataFrame, rules: list[Rule], mining: Mining = Mining(), default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    The verdict is the fitting given rule's, else the mined rules', else the default; so it is for a null url and one
    without a host. A null page_id stays null; repeated rows are judged each; other columns are left out. A
    url of any length has nine kinds of tokens at most.
    """
    host, path = host_and_path()
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = fitting_rule(rules)
    described = stored(own.select("page_id", "host", "path", name.alias("rule"), verdict.alias("given"), tokens().alias("tokens")), "urls")
    labelled = described.filter("given IS NOT NULL").select("tokens", F.col("given").alias("verdict"))
    open_pages = described.filter("given IS NULL")
    found = judged(open_pages, mine(labelled, mining))
    verdict = F.coalesce("given", "mined", F.lit(default)).alias("verdict")
    # Pages with a given rule need no partner and would only crowd the join.
    decided = described.filter("given IS NOT NULL").select("page_id", "host", "path", "rule", F.col("given").alias("verdict"))
    return open_pages.join(found, "tokens", "left").select("page_id", "host", "path", "rule", verdict).unionByName(decided)
