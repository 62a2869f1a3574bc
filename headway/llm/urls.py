"""URL filters: pattern rules found through their rarest literal token."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class UrlRule(NamedTuple):
    """``host_path``: a literal ``host/path`` prefix rule; ``pattern``: a regular expression on the whole url.

    ``tokens`` are literals (runs of a-z, 0-9) that stand as whole tokens in any
    url which the rule fits; they may be left out for host_path rules.
    """

    action: str
    kind: str
    rule: str
    tokens: tuple[str, ...] = ()


def small(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return small(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(text: Column) -> Column:
    """Distinct runs of a-z and 0-9 of the lower-cased text."""
    return F.array_distinct(F.filter(F.split(small(text), "[^a-z0-9]+"), lambda x: x != ""))


def rule_table(spark: SparkSession, rules: Sequence[UrlRule]) -> DataFrame:
    """One row per rule: ``rule_id, action, kind, rule, rule_host, rule_path, tokens``.

    Tokens of a host_path rule: its host's labels and its whole path segments;
    the last segment without a closing ``/`` may go on in a url, so is none.
    """
    rows = []
    for i, r in enumerate(rules):
        host, slash, rest = r.rule.partition("/")
        whole = f"{host}/{rest.rpartition('/')[0]}".lower()
        tokens = list(r.tokens) or [t for t in _runs(whole) if t]
        if not tokens:
            raise ValueError(f"rule without a literal token: {r.rule}")
        rows.append((i, r.action, r.kind, r.rule, host, slash + rest, tokens))
    return spark.createDataFrame(
        rows, "rule_id int, action string, kind string, rule string, rule_host string, rule_path string, tokens array<string>"
    )


def _runs(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Verdict for every url.

    Appends ``host, path, rule, verdict, blocked_by``. Urls are taken once each.
    A rule's index token is that of its literals which the fewest urls hold
    (ties: the first in order). The tokens of each url fetch candidate rules by
    an equi-join, and only those are tested. Of the fitting host_path rules the
    one with the longest rule wins and gives ``rule`` and ``verdict``; else any
    fitting block pattern blocks (``blocked_by``, smallest rule id), else
    ``default`` holds.

    Null urls and urls without ``://`` have an empty host and path and no
    host_path rule; repeated rows get the same verdict; columns of ``pages``
    named like new ones are replaced.
    """
    new = ["host", "path", "rule", "verdict", "blocked_by"]
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new or c == url])
    urls = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("_url")).distinct()
    urls = urls.select("_url", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    tokens = urls.select("_url", "_host", "_path", F.explode(tokens_of(F.col("_url"))).alias("token"))
    literals = rules.select("rule_id", F.posexplode(F.array_sort(F.array_distinct("tokens"))).alias("at", "token"))
    held = tokens.join(literals.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literals.join(held, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "token")).alias("best"))
        .select("rule_id", F.col("best.token").alias("token"))
    )
    index = rarest.join(rules.drop("tokens"), "rule_id")
    under = (F.col("_host") == F.col("rule_host")) | F.col("_host").endswith(F.concat(F.lit("."), F.col("rule_host")))
    fits = F.when(F.col("kind") == "host_path", under & F.col("_path").startswith(F.col("rule_path"))).otherwise(
        F.expr("_url rlike rule")
    )
    chosen = (
        tokens.join(index, "token")
        .where(fits)
        .groupBy("_url")
        .agg(
            F.max(
                F.when(F.col("kind") == "host_path", F.struct(F.length("rule").alias("size"), F.col("rule").alias("rule"), F.col("action").alias("action")))
            ).alias("literal"),
            F.min(F.when((F.col("kind") == "pattern") & (F.col("action") == "block"), F.struct("rule_id", "rule"))).alias("pattern"),
        )
    )
    return (
        pages.join(chosen, pages[url] == chosen["_url"], "left")
        .select(
            *[pages[f"`{c}`"] for c in pages.columns],
            *([] if url == "host" else [host_of(pages[url]).alias("host")]),
            *([] if url == "path" else [path_of(pages[url]).alias("path")]),
            chosen["literal"]["rule"].alias("rule"),
            F.when(chosen["literal"].isNotNull(), chosen["literal"]["action"])
            .when(chosen["pattern"].isNotNull(), F.lit("block"))
            .otherwise(F.lit(default))
            .alias("verdict"),
            chosen["pattern"]["rule"].alias("blocked_by"),
        )
    )
