"""URL rules, and block decisions carried to a page's aliases; DataFrame functions only.

A rule (host, path, verdict) fits its host and all subdomains if the url's path
starts with the rule's; the longest fitting rule wins.  Urls are joined to rules
on each suffix of their host.

Redirects (``meta refresh``) and canonical links found in the pages, and any
redirect log given, are edges between urls.  Urls that differ only in scheme,
fragment or a slash at the end are the same node.  Connected components of the
edges are groups of aliases.  Links are read as a browser does: character
references decoded, then resolved against the page's url, dot segments
included; links of schemes without a host are none.  A url without a rule takes its group's decision:
allowed if an alias has an allow rule, else blocked if one has a block rule,
else allowed.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule and no aliases, and is allowed; null html has no edges; a null page_id
stays null; repeated rows are judged alike; extra columns are not read; no rows
give no rows; no edges give every url its own decision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.components import components

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict)
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def without_dots(url: Column) -> Column:
    """The url with the dot segments of its path resolved."""
    path = path_of(url)
    segments = F.split(path, "/")
    resolved = F.aggregate(
        F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0))),
        F.lit(""),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.regexp_replace(done, "/[^/]*$", ""))
        .otherwise(F.concat(done, F.lit("/"), s)),
    )
    closed = F.when(path.rlike(r"/\.\.?$"), F.concat(resolved, F.lit("/"))).otherwise(resolved)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^?#]*([?#].*)$", 1)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(site, closed, rest)).otherwise(url)


_REFERENCE = r"&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"
#: Named references of the characters that markup needs; the ampersand last.
_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def decoded(text: Column) -> Column:
    """Text of an attribute with its character references decoded."""

    def character(reference: Column) -> Column:
        hexed = F.regexp_extract(reference, r"[xX]([0-9a-fA-F]+)", 1)
        code = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(F.regexp_extract(reference, r"([0-9]+)", 1))
        code = code.cast("long")
        known = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        code = F.when(known, code).otherwise(F.lit(0xFFFD).cast("long"))
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    references = F.array_distinct(F.regexp_extract_all(text, F.lit(_REFERENCE), 0))
    numbered = F.aggregate(references, text, lambda done, r: F.replace(done, r, character(r)))
    out = F.when(text.contains("&#"), numbered).otherwise(text)
    for name, plain in _NAMED:
        out = F.replace(out, F.lit(name), F.lit(plain))
    return out


def node_of(url: Column) -> Column:
    """The url as a node: host, path without a slash at the end, and query; null without a host."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), query))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict`` of the different hosts and paths of ``urls`` that a rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))),
    )
    asked = urls.where("host <> ''").select("host", "path").distinct()
    met = asked.withColumn("rule_host", F.explode_outer(suffixes)).join(rules, "rule_host").where(
        F.col("path").startswith(F.col("rule_path"))
    )
    rule = F.concat("rule_host", "rule_path")
    longest = F.struct(F.length(rule).alias("length"), rule.alias("rule"), F.col("rule_verdict"))
    return met.groupBy("host", "path").agg(F.max(longest).alias("best")).select(
        "host", "path", "best.rule", "best.rule_verdict"
    )


def _absolute(base: Column, link: Column) -> Column:
    """A link as an absolute url, resolved against the page's; null for a scheme without a host."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    target = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, path_of(base), link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, "(?s)^([^#]*)", 1), link))
        .otherwise(
            F.concat(
                site, F.coalesce(F.nullif(F.regexp_extract(path_of(base), "(?s)^(.*/)", 1), F.lit("")), F.lit("/")), link
            )
        )
    )
    return target


def _alone(rows: DataFrame) -> DataFrame:
    """A step of its own: later expressions take the columns' values, not their whole expressions."""
    return rows.select(F.explode_outer(F.array(F.struct("*"))).alias("r")).select("r.*")


def tidy_edges(edges: DataFrame) -> DataFrame:
    """``source, target`` with the dot segments of both resolved."""
    ends = [without_dots(F.col(c)).alias(c) for c in ("source", "target")]
    return _alone(edges.select(*ends))


def page_edges(pages: DataFrame) -> DataFrame:
    """``source, target`` urls: canonical links and refreshes stated in the pages."""
    tags = F.concat(F.regexp_extract_all("html", F.lit(_LINK), 0), F.regexp_extract_all("html", F.lit(_REFRESH), 0))
    found = (
        pages.where(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)canonical|http-equiv"))
        .select("url", F.explode_outer(tags).alias("tag"))
        .where("tag is not null")
    )
    link = F.coalesce(
        F.nullif(F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract("tag", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")),
    )
    linked = _alone(_alone(found.select("url", link.alias("link"))).withColumn("link", decoded(F.col("link"))))
    edges = linked.select(F.col("url").alias("source"), _absolute(F.col("url"), F.col("link")).alias("target"))
    # a page's own url stays as it is
    resolved = _alone(edges).select("source", without_dots(F.col("target")).alias("target"))
    return _alone(resolved).where("target is not null")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; ``redirects`` (source, target) add edges."""
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    edges = tidy_edges(edges)
    nodes = edges.select(node_of(F.col("source")).alias("u"), node_of(F.col("target")).alias("v"))
    aliases = components(nodes.where("u is not null and v is not null"))

    asked = _alone(pages.select("page_id", "url", without_dots(F.col("url")).alias("tidy"))).select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        node_of(F.col("tidy")).alias("node"),
    )
    ends = edges.select("source").union(edges.select("target")).withColumnRenamed("source", "url")
    known = asked.select("host", "path").union(ends.select(host_of(F.col("url")), path_of(F.col("url"))))
    ruled = judge_urls(known, rules)
    at = ["host", "path"]

    group = (
        ends.select(node_of(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .unionByName(asked.select("node", "host", "path"))
        .distinct()
        .join(aliases, "node")
        .join(ruled, at)
        .groupBy("root")
        .agg(F.min("rule_verdict").alias("group_verdict"))  # "allow" comes before "block"
    )
    inherited = aliases.join(group, "root").select("node", "group_verdict")
    return (
        asked.join(ruled, at, "left")
        .join(inherited, "node", "left")
        .select(
            F.col("page_id").cast("long").alias("page_id"),
            "host",
            "path",
            "rule",
            F.coalesce("rule_verdict", "group_verdict", F.lit(ALLOW)).alias("verdict"),
        )
    )
