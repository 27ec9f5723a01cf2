"""URL filter: host and path rules found through their rarest literal token.

A rule is (verdict, host, path). It fits a URL whose host is the rule's host or a
subdomain of it and whose path starts with the rule's path. Every rule is stored as a
regular expression and indexed under one literal token, a host label or a whole path
segment: the one that fewest URLs of the table have. The tokens of a URL fetch the rules
indexed under them, and only those regular expressions run.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: from
there up to `?`, `#` or the end. A null URL or one without `://` has both empty. Where
several rules fit, the longest (host and path together) decides; of equally long ones a
blocking rule, then the first in code-point order. A URL that no rule fits gets
`default`. Repeated URLs are judged once. Only the key and URL columns are read, so
other columns may have any name; a null key stays null; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clickcohort.llm.common import lower_ascii

Rule = tuple[str, str, str]
ALLOW, BLOCK = "allow", "block"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Token that every URL has, for rules without any literal token of their own.
_ANY = "*"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_tokens(host: str, path: str) -> list[str]:
    """Literal tokens that every URL fitting the rule has."""
    labels = [f"h:{x}" for x in host.split(".") if x]
    # What follows the last slash may go on in the URL, so it is no whole segment.
    segments = [f"p:{x}" for x in path.split("/")[:-1] if x]
    return sorted({*labels, *segments}) or [_ANY]


def rule_pattern(host: str, path: str) -> str:
    """Regular expression over host and path written together."""
    quoted = re.escape(host + path)
    return rf"(?s)^(?:[^/]*\.)?{quoted}" if host else rf"(?s)^[^/]*{quoted}"


def url_tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments, F.array(F.lit(_ANY))))


def rule_index(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: its pattern under the token that fewest URLs have."""
    spark = urls.sparkSession
    facts = spark.createDataFrame(
        [(v, h, p, rule_pattern(h, p), t) for v, h, p in dict.fromkeys(rules)
         for t in rule_tokens(h, p)],
        "verdict string, rule_host string, rule_path string, pattern string, token string")
    counts = (urls.select(F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))
              .join(facts.select("token").distinct(), "token", "left_semi")
              .groupBy("token").count())
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)), F.col("token")))
    return (facts.join(counts, "token", "left")
            .groupBy("verdict", "rule_host", "rule_path", "pattern")
            .agg(rarest.alias("first"))
            .select("verdict", F.concat("rule_host", "rule_path").alias("rule"), "pattern",
                    F.col("first.token").alias("token")))


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url",
          default: str = ALLOW) -> DataFrame:
    """key, host, path, rule and verdict of every row."""
    rows = pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"),
                        path_of(F.col(url)).alias("path"))
    urls = rows.select("host", "path").distinct()
    hits = (urls.withColumn("token", F.explode(url_tokens(F.col("host"), F.col("path"))))
            .join(rule_index(urls, rules), "token")
            .where(F.regexp_like(F.concat("host", "path"), F.col("pattern"))))
    order = F.struct(-F.length("rule"), F.col("verdict") != BLOCK, F.col("rule"))
    decided = hits.groupBy("host", "path").agg(
        F.min_by(F.struct("rule", "verdict"), order).alias("chosen"))
    return rows.join(decided, ["host", "path"], "left").select(
        F.col("_key").alias(key), "host", "path", F.col("chosen.rule").alias("rule"),
        F.coalesce("chosen.verdict", F.lit(default)).alias("verdict"))
