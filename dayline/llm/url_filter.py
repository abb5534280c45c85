"""URL filters with redirect equivalence.

Rules judge a URL by host and path.  Pages that redirect to each other, or name each other as
canonical, are one address under several names: connected components over those edges carry
the decisions of rules to the aliases that no rule names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.llm.common import match_rows, shared
from dayline.operators.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, ADDRESS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def resolved(target: Column, url: Column) -> Column:
    """The address a link of page ``url`` leads to; null where it names none."""
    host, folder = F.regexp_extract(url, ADDRESS, 1), F.regexp_extract(path_of(url), r"(?s)^(.*/)[^/]*$", 1)
    base = F.concat(F.lit("http://"), host)
    return (
        F.when(target.isNull() | target.rlike(r"^(#|$)"), F.lit(None))
        .when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | (host == ""), F.lit(None))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.startswith("?"), F.concat(base, path_of(url)))
        .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """``(a, b)`` addresses (host and path) joined by a canonical link or a refresh in ``pages(url, html)``."""
    tags = F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(LINK_TAG), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(
            F.regexp_extract_all("html", F.lit(REFRESH_TAG), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH_URL, 1)
        ),
    )
    links = pages.where(F.col("html").isNotNull() & F.col("url").isNotNull()).select("url", F.explode(tags).alias("to"))
    links = links.select("url", resolved(F.col("to"), F.col("url")).alias("to")).where("to IS NOT NULL")
    address = lambda c: F.concat(host_of(F.col(c)), path_of(F.col(c)))
    found = links.select(address("url").alias("a"), address("to").alias("b"))
    return found.where("a <> '' AND b <> '' AND a <> b").distinct()


def rule_of(addresses: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``addresses(address, host, path)`` with ``rule`` and ``rule_verdict`` of the longest rule that fits, or null.

    Each address asks for its host and every parent domain; a rule table of any size is joined on them.
    """
    if not rules:
        none = F.lit(None).cast("string")
        return addresses.withColumns({"rule": none, "rule_verdict": none})
    table = addresses.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path"), F.lit(v).alias("rule_verdict")) for v, h, p in rules
    ])))
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    asked = addresses.select("address", "path", F.explode(parents).alias("rule_host"))
    fits = asked.join(table, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), F.col("rule_verdict").alias("v"))).alias("_best")
    chosen = fits.groupBy("address").agg(best).select("address", "_best.rule", F.col("_best.v").alias("rule_verdict"))
    return match_rows(addresses, chosen, ["address"], "left")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, edges: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, via)`` per row of ``pages(page_id, url, html)``.

    A URL that a rule fits gets the verdict of the longest.  Any other takes that of its
    component: allow where a rule allows any address in it, else block where a rule blocks
    one, else allow.  ``edges(a, b)`` may name more aliases by address.  A null URL, or one
    without ``://``, has an empty host and path, and no rule fits it; null html has no links.  Repeated
    rows are judged alike; an empty table gives no rows; other columns are not read.
    """
    links = alias_edges(pages)
    if edges is not None:
        links = links.unionByName(edges.select("a", "b").where("a <> b")).distinct()
    links = shared(links)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = shared(rows.withColumn("address", F.concat("host", "path")))
    ends = links.select("a").union(links.select("b")).distinct().select(
        F.col("a").alias("address"), F.regexp_extract("a", r"(?s)^([^/]*)", 1).alias("host"),
        F.regexp_extract("a", r"(?s)^[^/]*(.*)$", 1).alias("path"),
    )
    known = rule_of(rows.select("address", "host", "path").union(ends).distinct(), rules)
    known = shared(known.select("address", "rule", "rule_verdict"))
    if links.isEmpty():
        decided = known.withColumn("component_verdict", F.lit(None).cast("string"))
    else:
        members = connected_components(links).select(F.col("node").alias("address"), "component")
        with_rule = match_rows(members, known.where("rule IS NOT NULL"), ["address"])
        verdicts = with_rule.groupBy("component").agg(
            F.when(F.bool_or(F.col("rule_verdict") == "allow"), F.lit("allow")).otherwise(F.lit("block")).alias("component_verdict")
        )
        alias = match_rows(members, verdicts, ["component"]).select("address", "component_verdict")
        decided = match_rows(known, alias, ["address"], "left")
    return match_rows(rows, decided, ["address"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", "component_verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").when(F.col("component_verdict").isNotNull(), "alias").otherwise("default").alias("via"),
    )
