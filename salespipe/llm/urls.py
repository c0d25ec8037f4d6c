"""Block and allow rules on pages, carried to their aliases.

A page takes the verdict of its own longest rule. A page without one takes the
verdict of its aliases: pages joined to it by canonical links or redirects, of
which a page may hold many, complete or relative to it or its base, in any
number of steps. If a rule allows one of them the page is allowed; else it
is blocked if a rule blocks one of them; else allowed.

Two urls are the same address if they differ only in scheme, fragment, a slash
at the end, or parameters that track visits. NULL and malformed urls have no
host, fit no rule and are nobody's alias. Repeated pages get equal verdicts; an
empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespipe.llm.components import components
from salespipe.llm.store import written


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
# Query parameters that track a visit and name no other page.
TRACKING = r"(?i)(?<=[?&])(utm_[a-z]+|ref|gclid|fbclid|sessionid)=[^&#]*&?"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
BASE = r"""(?is)<base\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, group), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return _part(url, 2)


def address(url: Column) -> Column:
    """What names the page; NULL without a host."""
    asked = F.regexp_replace(F.regexp_replace(_part(url, 3), TRACKING, ""), r"[?&]$", "")
    return F.when(host(url) != "", F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), asked))


def _folded(at: Column) -> Column:
    """A path from the root on without its ``.`` and ``..``."""
    steps = F.slice(F.split(at, "/"), 2, 1 << 30)
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda before, step: F.when(step == ".", before)
        .when(step == "..", F.slice(before, 1, F.greatest(F.size(before) - 1, F.lit(0))))
        .otherwise(F.concat(before, F.array(step))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolved(link: Column, page: Column) -> Column:
    """The url a link of a page leads to; NULL for links that name no page, as ``mailto:`` does."""
    link = F.regexp_replace(link, "&amp;", "&")
    root = F.concat(F.regexp_extract(page, r"(?s)^(.*?)://", 1), F.lit("://"), host(page))
    at, asked = F.regexp_extract(link, r"(?s)^[^?#]*", 0), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(path(page), "[^/]*$", ""), "^/", ""))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(page, r"(?s)^(.*?)://", 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, _folded(at), asked))
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("?"), F.concat(root, path(page), link))
        .when(~link.startswith("#"), F.concat(root, _folded(F.concat(folder, at)), asked))
    )


def target(link: Column, page: Column) -> Column:
    """The address a link of a page leads to."""
    return address(resolved(link, page))


def longest_rule(rules: Sequence[Rule], at_host: Column, at_path: Column) -> Column:
    """The longest rule that fits, as struct (length, rule, verdict); NULL if none does. ``rules`` is a short list."""
    fits = [
        F.when(
            ((at_host == r.host) | at_host.endswith("." + r.host)) & at_path.startswith(r.path),
            F.struct(F.lit(len(r.host + r.path)).alias("length"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def verdicts(spark: SparkSession, pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and whether the verdict came from an alias."""
    url = F.col("url").cast("string")
    html = F.col("html").cast("string")
    links = F.concat(*[F.coalesce(F.regexp_extract_all(html, F.lit(tag), F.lit(1)), F.array()) for tag in (CANONICAL, REFRESH)])
    # Links count from a page's base, if it names one.
    base = F.coalesce(resolved(F.nullif(F.regexp_extract(html, BASE, 1), F.lit("")), url), url)
    judged = written(
        spark,
        pages.select(
            "page_id", host(url).alias("host"), path(url).alias("path"), address(url).alias("address"),
            F.array_distinct(F.array_compact(F.transform(links, lambda link: target(link, base)))).alias("links"),
        ).withColumn("fit", longest_rule(rules, F.col("host"), F.col("path"))),
        "pages",
    )
    edges = judged.select(F.col("address").alias("u"), F.explode("links").alias("v"))
    groups = written(spark, components(spark, edges), "aliases")
    placed = judged.join(groups, judged.address == groups.node, "left").select(
        "page_id", "host", "path", "fit", F.coalesce("component", "address").alias("component")
    )
    placed = written(spark, placed, "placed")
    ruled = placed.where("fit is not null and component is not null").groupBy("component")
    ruled = written(spark, ruled.agg(F.min("fit.verdict").alias("by_alias")), "ruled")  # allow sorts before block
    return placed.join(ruled, "component", "left").select(
        F.col("page_id").cast("long").alias("page_id"), "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "by_alias", F.lit("allow")).alias("verdict"),
        F.expr("fit is null and by_alias is not null").alias("from_alias"),
    )
