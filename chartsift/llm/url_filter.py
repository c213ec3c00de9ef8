"""URL filters with redirect equivalence.

Rules on hosts and paths judge urls; pages that redirect to each other, or name a canonical page, are one component of
the link graph, and a decision on one member reaches those that no rule fits: an explicit allow goes before a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, lower_ascii, table

#: (rule, verdict): a host with everything below it, and a path's beginning.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)"
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*['\"]?([^\"'\s>]+)"


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 3)


def node(url: Column) -> Column:
    """A url's node in the link graph: host, path without a closing slash, and query; scheme and fragment don't count.
    Null where there is no host."""
    own = F.concat(host(url), F.regexp_replace(path(url), "/+$", ""), F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 4))
    return F.when(host(url) != "", F.md5(own.cast("binary")))


def rule_of(h: Column, p: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none: the rule's host is the url's or a parent of
    it, and the url's path starts with the rule's. Among equal rules the first counts."""
    out = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        top, slash, rest = rule.partition("/")
        fits = ((h == top) | F.endswith(h, F.lit("." + top))) & F.startswith(p, F.lit(slash + rest))
        out.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*out) if out else F.lit(None).cast("struct<rule:string,verdict:string>")


def _without_dots(p: Column) -> Column:
    """A path with its ``.`` and ``..`` parts taken away."""
    parts = F.split(p, "/", -1)
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(x))),
    )
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(F.contains(p, F.lit("/.")), F.array_join(closed, "/")).otherwise(p)


def absolute(target: Column, url: Column) -> Column:
    """A link's target as a url of its own: as it is, on the page's host, beside the page, or the page with another query.
    Null where it only names a place in the page."""
    site = F.concat(F.regexp_extract(url, _PARTS, 1), F.lit("://"), F.regexp_extract(url, _PARTS, 2))
    own, rest = F.regexp_extract(target, "^[^?#]*", 0), F.regexp_extract(target, "[?#].*$", 0)
    return (
        F.when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(F.contains(own, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(url, _PARTS, 1), F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, _without_dots(own), rest))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path(url), target))
        .otherwise(F.concat(site, _without_dots(F.concat(F.regexp_replace(F.concat(F.lit("/"), F.ltrim(path(url), F.lit("/"))), "[^/]*$", ""), own)), rest))
    )


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst, target)``: all redirects and canonical links between nodes; pages without either cost one search."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.col(url_col)
    none = F.array().cast("array<string>")
    every = [F.when(F.lower(html).contains(word), F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).otherwise(none) for word, pattern in (("canonical", CANONICAL), ("refresh", REFRESH))]
    found = pages.select(url.alias("url"), F.explode(F.filter(F.concat(*every), lambda x: x != "")).alias("t")).select("url", absolute(F.replace(F.col("t"), F.lit("&amp;"), F.lit("&")), F.col("url")).alias("target"))
    return found.select(node(F.col("url")).alias("src"), node(F.col("target")).alias("dst"), "target", "url").where("src IS NOT NULL AND dst IS NOT NULL")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for each row of ``pages``.

    A rule's verdict stands. Else a page takes its component's: allow if a rule allows any member, block if one blocks
    any (every page of a node counts, and so do targets of links though they are no pages), allow if neither. ``edges`` may give further
    ``(url, target)`` pairs, such as HTTP redirects seen while crawling. Urls that are null or have no ``://`` have
    empty host and path, fit no rule and have no links: allow. Rows that repeat a url are judged alike; an empty table
    gives an empty one. The components are computed with a table of nodes in the shared folder; only nodes with links
    are joined back.
    """
    found = links(pages, url_col, html_col)
    if edges is not None:
        found = found.unionByName(edges.select(node(F.col("url")).alias("src"), node(F.col("target")).alias("dst"), "target", "url").where("src IS NOT NULL AND dst IS NOT NULL"))
    found = cut(found)
    judged = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"), node(F.col(url_col)).alias("node")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    ends = found.select(F.col("src").alias("node"), "url").unionByName(found.select(F.col("dst").alias("node"), F.col("target").alias("url")))
    of = components(found)
    # A node's pages may be written otherwise than at the links' ends (a closing slash), and fit other rules.
    ruled = judged.select("node", F.col("r.verdict").alias("v")).where("v IS NOT NULL AND node IS NOT NULL")
    spoken = ends.select("node", rule_of(host(F.col("url")), path(F.col("url")), rules)["verdict"].alias("v")).where("v IS NOT NULL").unionByName(ruled)
    said = spoken.groupBy("node").agg(F.max((F.col("v") == "allow").cast("int")).alias("a"))
    whole = cut(of.join(said, "node").groupBy("component").agg(F.max("a").alias("a")))
    alias = of.join(whole, "component").select(F.col("node").alias("n"), F.when(F.col("a") == 1, "allow").otherwise("block").alias("shared"))
    out = judged.join(alias, F.col("node") == F.col("n"), "left")
    return out.select("id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "shared", F.lit("allow")).alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query: every row of ``pages``."""
    return judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


_FIT = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN {{'rule': '{r}', 'verdict': '{v}'}}" for r, v in sorted(RULES, key=lambda r: -len(r[0]))
)
#: Links are few in the given pages, so plain reachability does in SQL.
ORACLE_SQL = rf"""
WITH RECURSIVE p AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)', 3) AS path, regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 4) AS query, html FROM pages),
j AS (SELECT *, host || regexp_replace(path, '/+$', '') || query AS node, CASE {_FIT} END AS r FROM p),
t AS (SELECT node, unnest([regexp_extract(x, '(?is)href\s*=\s*["'']?([^"''\s>]+)', 1) FOR x IN regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*>') IF regexp_matches(x, '(?is)\brel\s*=\s*["'']?canonical\b')]) AS target FROM j WHERE host <> ''),
q AS (SELECT node AS src, translate(regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)', 3) AS path, regexp_extract(target, '(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 4) AS query FROM t),
e AS (SELECT src, host || regexp_replace(path, '/+$', '') || query AS dst, CASE {_FIT} END AS r FROM q WHERE host <> ''),
ways AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
reach AS (SELECT a AS node, a AS other FROM ways UNION SELECT reach.node, ways.b FROM reach JOIN ways ON reach.other = ways.a),
said AS (SELECT node, r.verdict AS v FROM j WHERE r IS NOT NULL UNION ALL SELECT dst, r.verdict FROM e WHERE r IS NOT NULL),
shared AS (SELECT reach.node, CASE WHEN bool_or(v = 'allow') THEN 'allow' ELSE 'block' END AS v FROM reach JOIN said ON said.node = reach.other GROUP BY reach.node)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, shared.v, 'allow') AS verdict FROM j LEFT JOIN shared ON j.node = shared.node AND j.host <> ''
"""
