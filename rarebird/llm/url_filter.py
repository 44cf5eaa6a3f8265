"""URL rules with redirect equivalence.

A rule is (host, path, verdict): it fits its host and every subdomain when the URL's path starts
with the rule's path; the longest fitting rule (host and path together) decides, a tie goes to the
rule that sorts first. Redirect and canonical-link edges join URLs into classes (distributed
connected components). A URL that no rule fits takes its class's decision: *allow* if a member is
explicitly allowed, else *block* if a member is blocked, else *allow*.

Edges of a page are its first canonical link and its first refresh without a delay. Comments, scripts,
styles, templates and text areas are not read; character references are decoded and targets resolved
against the page's ``base`` as RFC 3986 has it (a small helper in Arrow batches, for the pages with
such a link alone). A few rules become one expression; many, or a table of them, are joined by the
host's suffixes and those prefixes of the path whose lengths the suffix has rules of.

Edge cases: a null URL, or one without ``://``, has an empty host and path and is allowed; a
fragment never makes another URL; null or empty html has no edges; repeated rows are judged alike;
an empty table gives an empty result; only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rarebird.llm.common import Scratch, lower_ascii
from rarebird.llm.components import connected_components

#: (rule as written, verdict)
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block")]
#: more rules than this are joined as a table instead of travelling inside the plan
MAX_RULES = 200

Rules = Sequence[tuple[str, str]] | DataFrame

_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea)\b.*?(?:</\1\s*>|\z)"
_TAG = r"(?is)<(?:link|meta|base)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_key(url: Column) -> Column:
    """The URL without its fragment, scheme and host in lower case; null without ``://``."""
    bare = F.regexp_extract(url, "^[^#]*", 0)
    at = F.locate("://", bare)
    rest = F.substring(bare, at + 3, F.length(bare))
    host = F.regexp_extract(rest, "^[^/?]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.when(at > 0, F.concat(lower_ascii(F.substring(bare, F.lit(1), at + 2)), lower_ascii(host), tail))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    chain = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r)):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain


def with_rule(urls: DataFrame, rules: Rules, out: str) -> DataFrame:
    """``urls`` with ``out``, the struct(rule, verdict) that fits its columns ``host`` and ``path``.

    ``rules``: pairs, or a table (rule, verdict) of any size. A rule without a slash fits every path.
    """
    if not isinstance(rules, DataFrame):
        if len(rules) <= MAX_RULES:
            return urls.withColumn(out, fitting_rule(F.col("host"), F.col("path"), rules))
        rules = urls.sparkSession.createDataFrame(list(rules), "rule string, verdict string")
    r, v = rules.columns
    table = rules.select(F.col(r).alias("rule"), F.col(v).alias("verdict")).where("rule is not null").groupBy("rule").agg(F.min("verdict").alias("verdict"))
    table = table.select("rule", "verdict", F.substring_index("rule", "/", 1).alias("rh"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rp"))
    lengths = table.groupBy("rh").agg(F.collect_set(F.length("rp")).alias("lengths"))  # as many as the longest path at most
    labels = F.split("host", "\\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = urls.select("host", "path").distinct()
    heads = known.select("host", "path", F.explode(F.array_distinct(ends)).alias("rh")).join(lengths, "rh").select(
        "host", "path", "rh", F.explode("lengths").alias("n")).where(F.length("path") >= F.col("n"))
    fits = heads.withColumn("rp", F.expr("substring(path, 1, n)")).join(table, ["rh", "rp"])
    best = fits.groupBy("host", "path").agg(F.min_by(
        F.struct("rule", "verdict"), F.struct(-F.length("rule"), F.col("rule"))).alias(out))
    return urls.join(best, ["host", "path"], "left")


@F.pandas_udf(StringType())
def _resolved(page: pd.Series, base: pd.Series, target: pd.Series) -> pd.Series:
    def one(u: str, b: str, t: str) -> str | None:
        try:
            t = "".join(c for c in unescape(t).strip() if c not in "\t\n\r")
            return urljoin(urljoin(u, unescape(b).strip()), t) if t else None
        except ValueError:  # a host that is no valid address
            return None
    return pd.Series([one(*x) for x in zip(page, base, target, strict=True)], dtype=object)


def _attribute(tag: Column, name: str) -> Column:
    pattern = f"(?is)(?<![\\w\\-]){name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>\"']+))"
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def html_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of canonical links and refreshes without a delay, resolved."""
    told = F.col(html).rlike("(?i)canonical|refresh")
    read = F.regexp_replace(F.col(html), F.lit(_UNREAD), F.lit(" "))
    tags = pages.where(F.col(url).isNotNull() & told).select(
        F.col(url).alias("u"), F.regexp_extract_all(read, F.lit(_TAG), F.lit(0)).alias("tags"))
    named = lambda name: F.filter("tags", lambda t: t.rlike(f"(?i)^<{name}\\b"))
    nonempty = lambda values: F.coalesce(F.get(F.filter(values, lambda t: t != ""), F.lit(0)), F.lit(""))
    hrefs = lambda tags: F.transform(tags, lambda t: _attribute(t, "href"))
    canonical = F.filter(named("link"), lambda t: _attribute(t, "rel").rlike("(?i)(?:^|\\s)canonical(?:\\s|$)"))
    refresh = F.filter(named("meta"), lambda t: _attribute(t, "http-equiv").rlike("(?i)^\\s*refresh\\s*$"))
    at_once = "(?is)^\\s*(?:0+(?:\\.[0-9.]*)?|\\.[0-9.]+)\\s*[;,\\s]\\s*(?:url\\s*=)?\\s*['\"]?([^'\"]+)"
    targets = F.transform(refresh, lambda t: F.regexp_extract(_attribute(t, "content"), at_once, 1))
    found = tags.select("u", nonempty(hrefs(named("base"))).alias("base"), F.explode(F.array(
        nonempty(hrefs(canonical)), nonempty(targets))).alias("t")).where("t <> ''")
    return found.select(F.col("u").alias("url"), _resolved("u", "base", "t").alias("target")).where("target is not null")


def judge_urls(pages: DataFrame, rules: Rules = RULES, edges: DataFrame | None = None,
               id_col: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    ``edges``: further (from URL, to URL) rows, as from a crawl's redirect log.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    links = None
    if html is not None:
        links = html_edges(pages, url, html)
    if edges is not None:
        a, b = edges.columns
        more = edges.select(F.col(a).alias("url"), F.col(b).alias("target"))
        links = more if links is None else links.union(more)
    judged = pages.select(F.col(id_col), F.col(url).alias("__url"), url_host(F.col(url)).alias("host"),
                          url_path(F.col(url)).alias("path"))
    judged = with_rule(judged, rules, "__rule")
    if links is not None:
        keys = links.select(url_key(F.col("url")).alias("u"), url_key(F.col("target")).alias("v")).where("u <> v")
        nodes = connected_components(scratch.keep(keys, "edges"), scratch)
        own = with_rule(nodes.withColumns({"host": url_host(F.col("node")), "path": url_path(F.col("node"))}), rules, "rule")
        own = own.withColumn("r", F.col("rule.verdict"))
        decided = own.groupBy(F.col("component").alias("c")).agg(
            F.max(F.col("r") == "allow").alias("a"), F.max(F.col("r") == "block").alias("b"))
        by_class = F.when(F.col("a"), F.lit("allow")).when(F.col("b"), F.lit("block")).otherwise("allow")
        alias = scratch.keep(nodes.join(decided, F.col("component") == F.col("c"))
                             .select(F.col("node"), by_class.alias("__class")), "alias")
        judged = judged.join(alias, url_key(F.col("__url")) == F.col("node"), "left")
    else:
        judged = judged.withColumn("__class", F.lit(None).cast("string"))
    return judged.select(id_col, "host", "path", F.col("__rule.rule").alias("rule"),
                         F.coalesce(F.col("__rule.verdict"), F.col("__class"), F.lit("allow")).alias("verdict"))
