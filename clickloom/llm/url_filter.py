"""Allow and block rules for urls, carried over to urls that lead to the same page.

A url's own longest rule decides. A url without a rule shares the fate of its aliases: pages joined by
``<link rel="canonical">`` and ``<meta http-equiv="refresh">`` form classes (connected components over urls
without scheme and fragment, an empty path as ``/``, dot segments resolved). A class with a blocked url is blocked, unless a rule explicitly allows one of its
urls: an explicit allow takes precedence over the block. Everything else is allowed. Targets count whether or not
they are pages of the table.

Edge cases: null urls and urls without ``://`` have an empty host and path, no rule and no aliases, and are
allowed; null html has no links; repeated pages are judged each for itself; no pages give no rows.
Column expressions only.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import connected_components
from clickloom.session import materialise

Rule = tuple[str, str]  # ("allow" or "block", "host/path")

LINK_TAG = r"(?i)<link\b[^>]*>"
META_TAG = r"(?i)<meta\b[^>]*>"
IS_CANONICAL = r"""(?i)(?<![\w-])rel\s*=\s*("([^"]*\s)?canonical(\s[^"]*)?"|'([^']*\s)?canonical(\s[^']*)?'|canonical(?=[\s/>]))"""
IS_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?i)(?<![\w-])href\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?\s*([^"'\s>]+)"""
AMPERSAND = r"(?i)&(amp|#38|#x26);"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
DOTS = r"/\.\.?(/|$)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` segments resolved, ``/`` if empty."""
    parts = F.split(path, "/")  # the first is empty, as a path begins with a slash
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.concat(done, F.array(part))),
    )
    ends_in_folder = path.rlike(r"/\.\.?$") & (F.size(kept) > 0)
    whole = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends_in_folder, "/").otherwise(""))
    return F.when(path == "", "/").when(path.rlike(DOTS), whole).otherwise(path)


def address(url: Column) -> Column:
    """Host, path and query: what makes two urls the same page; null without a host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, without_dots(path_of(url)), F.regexp_extract(_rest(url), r"^[^?#]*([^#]*)", 1)))


def resolved(target: Column, host: Column, path: Column) -> Column:
    """The address of a link target found on the page at ``host`` and ``path``; null for one that is no page."""
    folder = F.regexp_replace(path, r"[^/]*$", "")
    site = F.concat(F.lit("http://"), host)
    whole = (
        F.when(target.rlike(SCHEME + "//"), target)
        .when(target.rlike(SCHEME) | target.startswith("#"), F.lit(None))
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )
    return address(whole)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits; both null without one."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):  # the last to fit wins
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(action)
    return rule, action


def link_targets(html: Column) -> Column:
    """Targets of canonical links and of refreshes, as written."""
    found = F.concat(
        F.transform(F.filter(F.regexp_extract_all(html, F.lit(LINK_TAG), 0), lambda t: t.rlike(IS_CANONICAL)), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(F.filter(F.regexp_extract_all(html, F.lit(META_TAG), 0), lambda t: t.rlike(IS_REFRESH)), lambda t: F.regexp_extract(t, REFRESH_URL, 1)),
    )
    return F.transform(F.filter(found, lambda t: t != ""), lambda t: F.regexp_replace(t, AMPERSAND, "&"))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(source, target) addresses of pages (url, html) that lead to another one."""
    linked = pages.where(F.col("html").rlike(r"(?i)canonical|refresh")).select(
        address(F.col("url")).alias("source"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.explode(link_targets(F.col("html"))).alias("to"),
    )
    return linked.select("source", resolved(F.col("to"), F.col("host"), F.col("path")).alias("target")).where("source <> target")


def _judged(address_col: Column, rules: Sequence[Rule]) -> Column:
    url = F.concat(F.lit("http://"), address_col)
    return longest_rule(host_of(url), path_of(url), rules)[1]


def judge_urls(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None) -> DataFrame:
    """``pages`` (url, html) plus host, path, rule and verdict; columns of these names are replaced.

    ``edges`` (source, target addresses) may add redirects known otherwise.
    """
    links = alias_edges(pages)
    links = materialise(links if edges is None else links.unionByName(edges.select("source", "target")), "aliases")
    classes = connected_components(links, "source", "target").withColumn("own", _judged(F.col("node"), rules))
    fate = classes.groupBy("component").agg(
        F.max(F.coalesce(F.col("own") == "block", F.lit(False))).alias("has_block"),
        F.max(F.coalesce(F.col("own") == "allow", F.lit(False))).alias("has_allow"),
    )
    blocked = classes.join(fate.where("has_block and not has_allow"), "component").select(F.col("node").alias("_node"), F.lit(True).alias("_blocked"))
    url = F.col("url")
    rule, action = longest_rule(host_of(url), path_of(url), rules)
    judged = pages.withColumns({"host": host_of(url), "path": path_of(url), "rule": rule, "_action": action})
    # only urls without a rule are looked up; the others get a key of their own, so that they spread
    key = F.when(F.col("_action").isNull(), address(url))
    judged = judged.withColumn("_node", F.coalesce(key, F.concat(F.lit(" "), F.xxhash64("url", "path", F.monotonically_increasing_id()).cast("string"))))
    judged = judged.join(blocked, "_node", "left")
    verdict = F.coalesce("_action", F.when(F.col("_blocked"), "block"), F.lit("allow"))
    return judged.withColumn("verdict", verdict).drop("_node", "_action", "_blocked")
