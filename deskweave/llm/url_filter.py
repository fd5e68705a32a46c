"""URL rules with redirect equivalence (native).

A URL is judged by the longest rule that fits it. URLs without a rule take the decision of
their aliases: URLs connected by redirects and canonical links form components, and a
decision of one URL reaches all URLs of its component that have no rule of their own. An
explicit allow goes first, both for a URL itself and inside a component; without any decision
a URL is allowed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored
from .components import components


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host(url: Column) -> Column:
    """Lower-cased (A-Z) part between the first `://` and `/`, `?`, `#` or the end."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """Part between the host and `?`, `#` or the end."""
    text = F.coalesce(url, F.lit(""))
    return F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fitting(rules: tuple[Rule, ...]) -> Column:
    """(rule, verdict) of the longest fitting rule, null if none fits; longer hosts win ties."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(order):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        named = F.struct(
            F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict")
        )
        found = F.when(fits & F.col("path").startswith(rule.path), named).otherwise(found)
    return found


def node(url: Column) -> Column:
    """URL without its fragment, as redirects and canonical links name it."""
    return F.regexp_replace(url, r"(?s)#.*$", "")


def html_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Alias links (a, b) of pages: canonical links and refresh redirects in their html.

    Targets are resolved against the page's URL. Pages without URL or html have none.
    """
    page = pages.select(F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    page = page.where("html rlike '(?i)canonical|http-equiv' and contains(url, '://')")
    tags = F.regexp_extract_all("html", F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"))
    tag = page.select("url", F.explode(tags).alias("tag"))
    value = r"""(?is)\b%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    given = lambda name: F.concat(
        *[F.regexp_extract("tag", value % name, i) for i in (1, 2, 3)]
    )
    canonical = F.when(F.lower(given("rel")) == "canonical", given("href"))
    refresh = F.when(
        F.lower(given("http-equiv")) == "refresh",
        F.regexp_extract(given("content"), r"(?is)\burl\s*=\s*['\"]?([^'\"]*)", 1),
    )
    target = F.replace(F.trim(F.coalesce(canonical, refresh)), F.lit("&amp;"), F.lit("&"))
    found = tag.select("url", target.alias("to")).where("to <> ''")
    scheme = F.regexp_extract("url", r"(?s)^(.*?):", 1)
    origin = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace("url", r"(?s)[?#].*$", ""), r"(?s)(?<=[^/]/)[^/]*$", "")
    resolved = (
        F.when(F.col("to").contains("://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), "to"))
        .when(F.col("to").startswith("/"), F.concat(origin, "to"))
        .otherwise(F.concat(folder, "to"))
    )
    return found.select(node(F.col("url")).alias("a"), node(resolved).alias("b"))


def _judged(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    parts = urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    return parts.withColumn("own", _fitting(rules))


def judge(
    pages: DataFrame,
    links: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Per row of `pages`: page_id, host, path, rule, verdict ('allow' or 'block').

    `links` (a, b) are redirects and canonical links; links with a null end are ignored. A null
    URL or one without `://` has an empty host and path, fits no rule, has no alias and is
    allowed. Repeated rows are judged alike; other columns are ignored.
    """
    members = stored(components(links.select("a", "b")), "aliases")
    decisions = (
        _judged(members.withColumnRenamed("node", "url"), rules)
        .groupBy("root")
        .agg(
            F.max(F.col("own.verdict") == "allow").alias("allowed"),
            F.max(F.col("own.verdict") == "block").alias("blocked"),
        )
        .where("blocked and not coalesce(allowed, false)")
    )
    blocked = members.join(decisions, "root").select(F.col("node").alias("r_node"), "blocked")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"))
    verdict = F.when(F.col("blocked"), "block").otherwise("allow")
    return (
        _judged(rows, rules)
        .join(blocked, node(F.col("url")) == F.col("r_node"), "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("own.rule").alias("rule"),
            F.coalesce("own.verdict", verdict).alias("verdict"),
        )
    )
