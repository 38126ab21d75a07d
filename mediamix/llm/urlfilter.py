"""URL filters over redirect equivalence.

Rules of host and path decide urls. Urls that redirect to each other, or name each other as
canonical, are one resource: the edges' connected components are found by joins, and a
block of any member goes to the members that no rule fits. An explicit allow comes first: a
url that a rule allows stays allowed, and so do the aliases of a resource with both.

Edges are what a page declares (canonical link, refresh), redirects given as a table, and
the redirects that sites usually have: from http to https, from ``www.`` and ``m.``, and to
the path without tracking parameters, fragment, ``.html`` or a last slash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamix.llm.common import free_name
from mediamix.llm.components import components
from mediamix.session import cut_lineage, release

#: Contract values: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Parameters that don't name another resource.
TRACKING = r"(?i)^(utm_\w*|ref|fbclid|gclid)(=|$)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    """Between the first ``?`` before a ``#`` and that or the end; else empty."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^?#]*\?([^#]*)", 1)


def address(host: Column, path: Column, query: Column) -> Column:
    """Node of a url: host, path and query; null without a host."""
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def usual(host: Column, path: Column, query: Column) -> tuple[Column, Column, Column]:
    """Host, path and query that a site usually redirects to."""
    kept = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)))
    plain = F.regexp_replace(path, r"(/index)?\.html?$", "")
    return F.regexp_replace(host, r"^(www|m)\.(?=[^.]+\.)", ""), F.regexp_replace(plain, r"/+$", ""), F.array_join(kept, "&")


def declared(html: Column) -> Column:
    """Addresses that a page names as its canonical one or forwards to, as written."""
    plain = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")
    link = F.regexp_extract(plain, r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    refresh = F.regexp_extract(plain, r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\bcontent\s*=\s*(\"[^\"]*\"|'[^']*')", 1)
    forward = F.regexp_extract(refresh, r"(?is);\s*url\s*=\s*(.*)", 1)
    bare = lambda c: F.replace(F.trim(F.regexp_replace(c, r"[\"']", "")), F.lit("&amp;"), F.lit("&"))
    found = F.filter(F.array(bare(link), bare(forward)), lambda x: x != "")
    return F.when(html.rlike("(?i)canonical|refresh"), found).otherwise(F.array().cast("array<string>"))


def resolved(base: Column, link: Column) -> Column:
    """Url of a link as written on the page ``base``."""
    root = F.concat(F.regexp_extract(base, r"^(.*?)://", 1), F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), r"^.*/", 0)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^(.*?)://", 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path_of(base), link))
        .when(link.startswith("#"), base)
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), F.regexp_replace(link, r"^(\./)+", "")))
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows of rules."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def ruled(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct places that a rule fits.

    A rule fits its host and all its subdomains where the path starts with the rule's. The
    longest fitting rule wins; of equally long ones an allow, then the first in order of
    text. A place is looked up by the ends of its host and, for each, by the path lengths
    that rules of that host have, so the number of rules doesn't multiply rows.
    """
    own = rules.select(F.col("host").alias("end"), F.col("path").alias("head"), "verdict").distinct()
    lengths = own.select("end", F.length("head").alias("size")).distinct()
    labels = F.split("host", r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = places.select("host", "path").where("host <> ''").distinct().select("host", "path", F.explode(F.array_distinct(ends)).alias("end"))
    tried = tried.join(lengths, "end").where(F.length("path") >= F.col("size")).withColumn("head", F.expr("left(path, size)"))
    fits = tried.join(own, ["end", "head"])
    rule = F.concat("end", "head")
    least = F.struct((-F.length(rule)).alias("size"), "verdict", rule.alias("rule"))  # allow comes before block
    return fits.groupBy("host", "path").agg(F.min(least).alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url: str = "url", html: str | None = "html") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) added.

    The verdict is that of the longest fitting rule. Where none fits, a url of a resource
    with a blocked address and no allowed one is blocked, else it is allowed. ``redirects``
    (source, target: urls) are edges beside those of the pages; they may name urls that are
    no pages, which rules judge too.

    A url that is null or has no ``://`` has an empty host and path, fits no rule, is alias
    of nothing and is allowed; a null html declares nothing; repeated rows are judged alike
    and all kept; an empty table gives no rows. Columns that are called like a new one stay,
    and the new one's name is lengthened by ``_``.
    """
    names = {}
    for c in ("host", "path", "rule", "verdict"):
        names[c] = free_name(pages, c)
    key = free_name(pages, "__address")
    own = F.col(f"`{url}`")
    whole = lambda u: (host_of(u), path_of(u), query_of(u))
    links = F.transform(declared(F.coalesce(F.col(f"`{html}`"), F.lit(""))), lambda x: resolved(own, x)) if html else F.array().cast("array<string>")
    seen = pages.select(own.alias("source"), links.alias("targets"))
    found = cut_lineage(seen.where("source IS NOT NULL").distinct())
    pairs = found.select("source", F.explode_outer("targets").alias("target"))
    if redirects is not None:
        pairs = pairs.union(redirects.select("source", "target"))
    places, edges = [], []
    for side in ("source", "target"):
        parts = whole(F.col(side))
        plain = usual(*parts)
        places += [pairs.select(h.alias("host"), p.alias("path"), address(h, p, q).alias("node")) for h, p, q in (parts, plain)]
        edges.append(pairs.select(address(*parts).alias("a"), address(*plain).alias("b")))
    edges.append(pairs.select(address(*whole(F.col("source"))).alias("a"), address(*whole(F.col("target"))).alias("b")))
    every = places[0].union(places[1]).union(places[2]).union(places[3]).where("node IS NOT NULL").distinct()
    nodes = cut_lineage(every)
    links = edges[0].union(edges[1]).union(edges[2])
    decided = cut_lineage(ruled(nodes, rules))
    members = cut_lineage(components(links))
    verdicts = nodes.join(decided, ["host", "path"], "left").groupBy("node").agg(F.max(F.col("verdict") == "block").alias("block"), F.max(F.col("verdict") == "allow").alias("allow"))
    of_root = verdicts.join(members, "node").groupBy("root").agg(F.max("block").alias("block"), F.max("allow").alias("allow"))
    spread = cut_lineage(members.join(of_root.where("block AND NOT coalesce(allow, false)").select("root"), "root").select(F.col("node").alias(key), F.lit("block").alias("__spread")))
    release(found, nodes, members)
    host, path = host_of(own), path_of(own)
    judged = pages.withColumns({names["host"]: host, names["path"]: path, key: address(host, path, query_of(own))})
    fixed = decided.select(F.col("host").alias("__h"), F.col("path").alias("__p"), F.col("rule").alias("__rule"), F.col("verdict").alias("__verdict"))
    judged = judged.join(fixed, (F.col(names["host"]) == F.col("__h")) & (F.col(names["path"]) == F.col("__p")), "left").join(spread, key, "left")
    verdict = F.coalesce("__verdict", "__spread", F.lit("allow"))
    return judged.select(*(F.col(f"`{c}`") for c in pages.columns), names["host"], names["path"], F.col("__rule").alias(names["rule"]), verdict.alias(names["verdict"]))
