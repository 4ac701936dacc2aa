"""URL filters with redirect equivalence (DataFrame functions only).

Rules name a host and a path; a rule fits its host and all subdomains when the
url's path starts with the rule's, and the longest rule that fits decides.
Pages no rule fits are judged through their aliases: redirects and canonical
links are edges between urls, connected components of those edges are aliases
of one page, and a block of any of them propagates to the others. An explicit
allow always stays: a page that a rule allows is never blocked by an alias.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetlake.llm.common import connected_components, narrow, written

#: up to so many rules are compared inline; more are looked up by joins
INLINE_RULES = 1000
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
# what a browser does not read as tags, and attributes, which follow blank space
_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style|template|noscript)\b.*?(?:</(?:script|style|template|noscript)\s*>|\z)"
_TAGS = {"link": r"(?is)<link\s[^>]*>", "meta": r"(?is)<meta\s[^>]*>"}
_CANONICAL = r"""(?is)[\s"']rel\s*=\s*["']?\s*canonical(?![^\s"'>])"""
_REFRESH = r"""(?is)[\s"']http-equiv\s*=\s*["']?\s*refresh(?![^\s"'>])"""
_HREF = r"""(?is)[\s"']href\s*=\s*["']?\s*([^"'\s>]+)"""
_TARGET = r"""(?is)[\s"']content\s*=\s*(?:"[^">]*?|'[^'>]*?)\burl\s*=\s*["']?\s*([^"'\s>]+)"""
_AMPERSAND = r"(?i)&(?:amp|#38|#x26);"
_PARTS = r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def node_of(url: Column) -> Column:
    """A url's key in the graph: host, path and query, without scheme and
    fragment; null without a host."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 3)
    key = F.concat(host_of(url), F.when(path_of(url) == "", "/").otherwise(path_of(url)),
                   F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host_of(url) != "", key)


def resolved(base: Column, link: Column) -> Column:
    """A link as an absolute url, seen from the page ``base``; ``.`` and ``..``
    are taken out of its path."""
    root = F.concat(F.lit("http://"), host_of(base))
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    target = (F.when(link.rlike("(?i)^[a-z][a-z0-9+.-]*://"), link)
              .when(link.startswith("//"), F.concat(F.lit("http:"), link))
              .when(link.startswith("/"), F.concat(root, link))
              .when(link.startswith("?"), F.concat(root, path_of(base), link))
              .when(link.rlike("(?i)^([a-z][a-z0-9+.-]*:|#)"), F.lit(None))
              .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link)))
    return F.concat(F.regexp_extract(target, _PARTS, 1), _without_dots(F.regexp_extract(target, _PARTS, 2)),
                    F.regexp_extract(target, _PARTS, 3))


def _without_dots(path: Column) -> Column:
    """A path from ``/`` with its dot segments removed."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.array_append(done, part)))
    clean = F.concat(F.lit("/"), F.array_join(kept, "/"),
                     F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), clean).otherwise(path)


def with_rule(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) plus ``found``: struct (size, allow,
    rule, verdict) of the longest fitting rule, or null. Between equal lengths
    ``allow`` wins.

    Up to ``INLINE_RULES`` rules are compared inline. More are a table: the
    suffixes of a host that have rules, with the few lengths that their paths
    have, say which prefixes of the path to look up, so a url costs a handful
    of look-ups however many rules there are.
    """
    host, path = F.col("host"), F.col("path")
    if len(rules) <= INLINE_RULES:
        known = F.array(*[F.struct(
            F.lit(len(h) + len(p)).alias("size"), F.lit(v == "allow").alias("allow"), F.lit(h + p).alias("rule"),
            F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for h, p, v in rules])
        fits = F.filter(known, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"])))
                        & path.startswith(r["path"]))
        return urls.withColumn("found", F.array_max(fits))
    table = urls.sparkSession.createDataFrame(list(dict.fromkeys(rules)), "suffix string, prefix string, verdict string")
    table = table.withColumn("cut", F.length("prefix"))
    best = table.groupBy("suffix", "prefix", "cut").agg(F.max(F.struct(
        (F.length("suffix") + F.col("cut")).alias("size"), (F.col("verdict") == "allow").alias("allow"),
        F.concat("suffix", "prefix").alias("rule"), "verdict")).alias("one"))
    cuts = table.groupBy("suffix").agg(F.collect_set("cut").alias("cuts"))
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = urls.select("host", "path").distinct()
    tried = (asked.select("host", "path", F.explode(suffixes).alias("suffix")).join(cuts, "suffix")
             .select("host", "path", "suffix", F.explode("cuts").alias("cut")).filter(F.col("cut") <= F.length("path"))
             .withColumn("prefix", F.expr("substring(path, 1, cut)")))
    found = tried.join(best, ["suffix", "prefix", "cut"]).groupBy("host", "path").agg(F.max("one").alias("found"))
    return urls.join(found, ["host", "path"], "left")


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b, url): redirect and canonical-link edges of ``pages`` (url, html)
    between url keys, with the target's url."""
    read = F.regexp_replace("html", _UNREAD, " ")

    def tags(kind: str, test: str, value: str) -> Column:
        found = F.filter(F.regexp_extract_all(read, F.lit(_TAGS[kind]), F.lit(0)), lambda t: t.rlike(test))
        return F.filter(F.transform(found, lambda t: F.regexp_replace(F.regexp_extract(t, value, 1), _AMPERSAND, "&")),
                        lambda x: x != "")

    links = F.concat(tags("link", _CANONICAL, _HREF), tags("meta", _REFRESH, _TARGET))
    targets = pages.filter(F.col("html").isNotNull() & F.col("url").isNotNull()).select(
        "url", F.explode(links).alias("link")).select("url", resolved(F.col("url"), F.col("link")).alias("target"))
    return targets.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"),
                          "url", "target").na.drop()


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every row.

    ``rule`` is the longest fitting rule (like ``net/es/``) and decides. Other
    pages get ``block`` when an alias (over redirects and canonical links) is
    blocked by a rule, else ``allow``. A null url or one without ``://`` has an
    empty host and path and no alias. Null html has no links; null and repeated
    ids, and repeated urls, are judged row by row; very long urls and pages like
    others; extra columns are ignored; an empty table gives no row. Any number of
    rules is judged exactly. Tags inside comments and scripts are not read.
    """
    rules = RULES if rules is None else rules
    base = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    edges = written(alias_edges(base.select("url", "html")).distinct(), "url-edges")
    ends = edges.select(F.col("a").alias("node"), "url").union(edges.select(F.col("b").alias("node"), F.col("target").alias("url")))
    ends = ends.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    blocked = with_rule(ends, rules).filter("found.verdict = 'block'")
    groups = connected_components(edges.select("a", "b"), "url-components")
    bad = groups.join(blocked.select("node").distinct(), "node").select("component").distinct()
    aliases = groups.join(bad, "component", "left_semi").select("node", F.lit(True).alias("by_alias"))

    judged = base.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                         node_of(F.col("url")).alias("node"))
    return (with_rule(judged, rules).join(aliases, "node", "left")
            .select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.verdict", F.when(F.col("by_alias"), "block"), F.lit("allow")).alias("verdict")))
