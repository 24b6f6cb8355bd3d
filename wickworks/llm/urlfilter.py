"""URL filters: host and path rules, and redirect equivalence that carries their decisions to aliases.

A rule has a host and a path; it fits that host and its subdomains where the url's path starts with the rule's, and the longest
fitting rule decides. Pages without a fitting rule take the decision of their aliases: redirects (meta refresh) and canonical links
make edges between addresses, distributed connected components join them, and a component with an explicitly allowed address is
allowed, one with a blocked and no allowed address is blocked, any other is allowed.

A page's first canonical link and first refresh count; a link is resolved against the page's address as a relative reference (dot segments,
query-only and fragment-only links included; a page's base element and entities but &amp; are not looked at).

An address's node is its host and path without dot segments and a last slash and its query, without fragment and scheme, as a 64-bit hash (at 10^10
addresses some three pairs would share one). A node has the decisions of all addresses of pages and links that it stands for, so an
address that redirects to itself with a slash, or links to one that differs by a slash from a page's, takes that page's. Null urls and urls without :// have empty host and path, fit no rule, make no edges and
are allowed; null or empty html makes no edges. Repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.llm.common import connected_components, table


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\s(?:[^>]*[\s"'])?rel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\s(?:[^>]*[\s"'])?http-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)[\s"']href\s*=\s*["']?([^"'\s>]+)"""
GOTO = r"""(?is)[\s"';,]url\s*=\s*["']?([^"'\s>]+)"""


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def without_dots(path: Column) -> Column:
    """A path without its segments . and .., as a link's target is resolved."""

    def add(acc: Column, segment: Column) -> Column:
        return F.when(segment == ".", acc).when(segment == "..", F.regexp_replace(acc, "/[^/]*$", "")).otherwise(F.concat(acc, F.lit("/"), segment))

    segments = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.concat(F.aggregate(segments, F.lit(""), add), F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"^/(?:.*/)?\.\.?(?:/|$)"), kept).otherwise(path)


def query(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)


def node(url: Column) -> Column:
    """The 64-bit hash of an address without scheme, fragment, dot segments and last slash; null for no address."""
    return F.when(host(url) != "", F.xxhash64(F.concat(host(url), F.regexp_replace(without_dots(path(url)), "/$", ""), query(url))))


def ruled(url: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host(url) == r.host) | F.endswith(host(url), F.lit(f".{r.host}"))) & F.startswith(path(url), F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def absolute(url: Column, link: Column) -> Column:
    """A link of a page as an address: a reference resolved against the page's own address, dot segments removed."""
    link = F.regexp_replace(link, "&amp;", "&")
    scheme, site = F.substring_index(url, "://", 1), F.regexp_extract(url, "^([^:]*://[^/?#]*)", 1)
    own = F.when(path(url) == "", F.lit("/")).otherwise(path(url))
    folder = F.regexp_replace(own, "[^/]*$", "")
    whole = (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link)).when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, own, link)).when(F.startswith(link, F.lit("#")), F.concat(site, own, query(url))).otherwise(F.concat(site, folder, link))
    )
    return F.when(F.contains(whole, F.lit("://")), F.concat(F.regexp_extract(whole, "^([^:]*://[^/?#]*)", 1), without_dots(path(whole)), query(whole))).otherwise(whole)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row."""
    url, html = F.col("url"), F.coalesce("html", F.lit(""))
    canonical = F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1)
    goto = F.regexp_extract(F.regexp_extract(html, REFRESH, 0), GOTO, 1)
    linked = pages.where(url.contains("://")).select("url", F.explode(F.filter(F.array(canonical, goto), lambda x: x != "")).alias("link"))
    linked, _ = table(linked.withColumn("to", absolute(url, F.col("link"))).select("url", "to"), "links")
    ends = linked.select("url").union(linked.select("to"))
    edges = linked.select(node(url).alias("src"), node(F.col("to")).alias("dst")).where("src is not null and dst is not null")
    # A node whose only links are to itself is a component too.
    components = ends.select(node(url).alias("node")).where("node is not null").distinct().join(connected_components(edges, "aliases"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = ends.union(pages.select("url")).select(node(url).alias("node"), ruled(url, rules)["verdict"].alias("verdict")).where("verdict is not null and node is not null").distinct()
    decided = components.join(known, "node").groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allowed"))
    aliases = components.join(decided.where(~F.col("allowed")), "component").select("node", F.lit("block").alias("alias"))
    own = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), ruled(url, rules).alias("own"), node(url).alias("node"))
    # Pages without a node would meet in one task: a salt deals them out.
    own = own.withColumn("salt", F.when(F.col("node").isNull(), F.pmod(F.xxhash64("page_id", "own"), F.lit(64))).otherwise(0).cast("int"))
    out = own.join(aliases.withColumn("salt", F.lit(0)), ["node", "salt"], "left")
    return out.select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", "alias", F.lit("allow")).alias("verdict"))


_FITS = "CASE " + " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{{r.verdict}|{r.host + r.path}}}"
    for r in sorted(RULES, key=lambda r: -len(r.host + r.path))
) + " END"


def _case(pick: int) -> str:
    import re

    return re.sub(r"\{([^|}]*)\|([^}]*)\}", lambda m: f"'{m[pick]}'", _FITS)


def _dots(path: str) -> str:
    """without_dots() in DuckDB SQL."""
    kept = f"list_reduce(list_prepend('', string_split({path}[2:], '/')), lambda acc, x: CASE x WHEN '.' THEN acc WHEN '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END)"
    return f"(CASE WHEN regexp_matches({path}, '^/(?:.*/)?\\.\\.?(?:/|$)') THEN {kept} || CASE WHEN regexp_matches({path}, '/\\.\\.?$') THEN '/' ELSE '' END ELSE {path} END)"


#: judge() in DuckDB SQL over the default rules; components by a recursive walk.
JUDGE_SQL = rf"""
WITH RECURSIVE parsed_ AS (SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
links_ AS (SELECT page_id, url, unnest([
  regexp_extract(regexp_extract(coalesce(html, ''), '(?is)<link\s(?:[^>]*[\s"''])?rel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)[\s"'']href\s*=\s*["'']?([^"''\s>]+)', 1),
  regexp_extract(regexp_extract(coalesce(html, ''), '(?is)<meta\s(?:[^>]*[\s"''])?http-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)[\s"'';,]url\s*=\s*["'']?([^"''\s>]+)', 1)]) AS link FROM parsed_ WHERE strpos(url, '://') > 0),
whole_ AS (SELECT url, replace(link, '&amp;', '&') AS link, split_part(url, '://', 1) AS scheme, regexp_extract(url, '^([^:]*://[^/?#]*)', 1) AS site, regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query FROM links_ WHERE link <> ''),
joined_ AS (SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN link WHEN link[1:2] = '//' THEN scheme || ':' || link WHEN link[1] = '/' THEN site || link WHEN link[1] = '?' THEN site || coalesce(nullif(path, ''), '/') || link
  WHEN link[1] = '#' THEN site || coalesce(nullif(path, ''), '/') || query ELSE site || regexp_replace(coalesce(nullif(path, ''), '/'), '[^/]*$', '') || link END AS t FROM whole_),
cut_ AS (SELECT url, t, regexp_extract(t, '^([^:]*://[^/?#]*)', 1) AS site, regexp_extract(t, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(t, '^[^:]*://[^?#]*(\?[^#]*)', 1) AS query FROM joined_),
to_ AS (SELECT url, CASE WHEN strpos(t, '://') = 0 THEN t ELSE site || {_dots("path")} || query END AS target FROM cut_),
urls_ AS (SELECT url FROM parsed_ WHERE url IS NOT NULL UNION SELECT target FROM to_),
rests_ AS (SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls_),
known_ AS (SELECT url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM rests_),
nodes_ AS (SELECT url, host, path, CASE WHEN host <> '' THEN host || regexp_replace({_dots("path")}, '/$', '') || query END AS node, {_case(2)} AS rule, {_case(1)} AS own FROM known_),
edges_ AS (SELECT a.node AS src, b.node AS dst FROM to_ t JOIN nodes_ a ON t.url = a.url JOIN nodes_ b ON t.target = b.url WHERE a.node <> b.node),
both_ AS (SELECT src, dst FROM edges_ UNION SELECT dst, src FROM edges_),
reach_ AS (SELECT DISTINCT n.node, n.node AS at_ FROM nodes_ n JOIN (SELECT url FROM to_ UNION SELECT target FROM to_) u ON n.url = u.url WHERE n.node IS NOT NULL UNION SELECT r.node, b.dst FROM reach_ r JOIN both_ b ON r.at_ = b.src),
alias_ AS (SELECT r.node, bool_or(n.own = 'allow') AS allowed, bool_or(n.own = 'block') AS blocked FROM reach_ r JOIN nodes_ n ON r.at_ = n.node GROUP BY r.node)
SELECT p.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, n.rule, coalesce(n.own, CASE WHEN a.blocked AND NOT a.allowed THEN 'block' END, 'allow') AS verdict
FROM parsed_ p LEFT JOIN nodes_ n ON p.url = n.url LEFT JOIN alias_ a ON n.node = a.node
"""
