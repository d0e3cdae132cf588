"""URL filtering by rules, with block decisions carried over to aliases; DataFrame functions only.

A rule (verdict, host, path) fits its host and all subdomains where the url's path starts with the rule's; the longest
rule wins, an allow before a block of the same length. Pages are aliases when they have one key (scheme, fragment,
tracking parameters and closing slash aside), or when a chain of redirects and canonical links joins their keys:
``<link rel=canonical>``, ``<meta http-equiv=refresh>`` and redirect targets in the query string. Components of that
graph come from joins and aggregates. A page without a rule of its own is blocked when a rule blocks one of its
aliases or a url that one leads to, else allowed; a page's own rule, an explicit allow above all, stands whatever its aliases are.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule and no alias: allowed; null and
empty pages have no links; repeated rows are judged alike; an empty table gives no rows. Extra columns are ignored.
The rules stand as literals in the plan: a list for people to write, not a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.graph import components
from ledgerlens.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
# A tag ends at the next angle bracket of either kind, so unclosed tags are read once.
CANONICAL = r"""(?is)<link\b(?=[^<>]*\brel\s*=\s*["']?canonical\b)[^<>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^<>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^<>]*?\burl\s*=\s*["']?([^"'\s>;]+)"""
TARGET = r"(?i)[?&](?:url|redirect|redirect_url|redirect_uri|next|target|goto|dest)=(https?(?::|%3a)(?:/|%2f)(?:/|%2f)[^&#]+)"
TRACKING = r"(?i)(^|&)(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def key_of(url: Column) -> Column:
    """host/path?query as aliases share it; null without a host."""
    query = F.regexp_replace(F.regexp_replace(F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")), TRACKING, ""), "^&+", "")
    key = F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host_of(url) != "", key)


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (size, allowed, rule, verdict) of the rule that wins, null where none fits."""
    fitting = []
    for verdict, rule_host, rule_path in rules:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.struct(
            F.lit(len(rule_host) + len(rule_path)).alias("size"),
            F.lit(verdict == "allow").alias("allowed"),
            F.lit(rule_host + rule_path).alias("rule"),
            F.lit(verdict).alias("verdict"),
        )
        fitting.append(F.when(fits, rule))
    return F.array_max(F.array_compact(F.array(*fitting)))


def absolute(target: Column, url: Column) -> Column:
    """A link's target as a whole url; relative ones start from ``url``."""
    start = F.concat(F.regexp_extract(url, r"(?s)^(.*?://)", 1), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(start, target))
        .otherwise(F.concat(start, F.when(folder == "", "/").otherwise(folder), target))
    )


def links_of(pages: DataFrame) -> DataFrame:
    """(a, b, target): the keys that a redirect or a canonical link joins, and the url it leads to."""
    html, url = F.coalesce("html", F.lit("")), F.col("url")
    found = F.concat(
        F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(1)),
        F.regexp_extract_all(html, F.lit(REFRESH), F.lit(1)),
        F.transform(F.regexp_extract_all(url, F.lit(TARGET), F.lit(1)), lambda t: F.coalesce(F.try_url_decode(t), t)),
    )
    rows = pages.where("url IS NOT NULL").select(url, F.explode(found).alias("target"))
    rows = rows.select(key_of(url).alias("a"), absolute(F.col("target"), url).alias("target"))
    return rows.select("a", key_of(F.col("target")).alias("b"), "target").where("a IS NOT NULL AND b IS NOT NULL").distinct()


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, url, host, path, rule and verdict for each row of (page_id, url, html)."""
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key"))
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    links = written(links_of(pages), "links")
    named = written(components(links).toDF("node", "component"), "aliases")
    led_to = links.select(F.col("b").alias("key"), best_rule(host_of(F.col("target")), path_of(F.col("target")), rules).alias("best"))

    def placed(part: DataFrame) -> DataFrame:
        return part.join(named, F.col("key") == F.col("node"), "left").withColumn("alias", F.coalesce("component", "key"))

    blocked_keys = rows.select("key", "best").union(led_to).where("best.verdict = 'block' AND key IS NOT NULL").select("key").distinct()
    blocked = placed(blocked_keys).select(F.col("alias").alias("blocked")).distinct()
    own = rows.where("best IS NOT NULL").select("page_id", "url", "host", "path", "best.rule", "best.verdict")
    others = placed(rows.where("best IS NULL")).join(blocked, F.col("alias") == F.col("blocked"), "left")
    verdict = F.when(F.col("blocked").isNotNull(), "block").otherwise("allow")
    return own.union(others.select("page_id", "url", "host", "path", F.lit(None).cast("string"), verdict))
