"""Operator 2 -- URL rules carried over redirect equivalence.

A rule (host, path, verdict) fits a url whose host is the rule's or one of its
subdomains and whose path starts with the rule's; the longest rule wins.  A
url without a rule takes the decision of its aliases: urls are nodes, redirects and canonical links are
edges, and a distributed connected-components job finds what is one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.llm.util import checked_broadcast, connected_components, table
from farsight.session import saved

#: Rules of the registered query: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"(?i)<link\s[^>]*rel\s*=\s*[\"']?canonical[^>]*>"
REFRESH = r"(?i)<meta\s[^>]*http-equiv\s*=\s*[\"']?refresh[^>]*>"
HREF = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)"
GOES = r"(?i)url\s*=\s*[\"']?([^\"'\s>]+)"


def parsed(rows: DataFrame, url: str) -> DataFrame:
    """Add host, path and node of the column named ``url``.

    node is what a url names after the redirects that every site serves: the
    same for http and https, with and without www., a last slash, a fragment
    or utm_ parameters.  It is null if the url has no host.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1), r"(^|&)utm_[^&]*", ""), r"^&", "")
    node = F.concat("_bare", F.regexp_replace("path", r"/$", ""),
                    F.when(F.col("_query") != "", F.concat(F.lit("?"), "_query")).otherwise(""))
    return (rows.withColumn("_rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), _UPPER, _LOWER))
            .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
            .withColumn("_query", query).withColumn("_bare", F.regexp_replace("host", r"^www\.", ""))
            .withColumn("node", F.when(F.col("_bare") != "", node))
            .drop("_rest", "_query", "_bare"))


def _absolute(link: Column, url: Column, path: Column) -> Column:
    """``link`` as found on the page ``url``."""
    scheme = F.regexp_extract(url, r"^([^:/?#]*):", 1)
    site = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return (F.when(link.contains("://"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule for each distinct (host, path) of ``urls`` that has
    one: host, path, rule, verdict.  Equi-joins each suffix of the host and
    each prefix of the path, of the lengths that rules have, with the rules."""
    spans = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    rules = checked_broadcast(rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict",
        F.concat("host", "path").alias("rule")), 256)
    labels = F.split("host", "[.]")
    prefixes = F.array(F.lit(""), *[F.substring("path", 1, n) for n in spans if n])
    return (urls.select("host", "path").distinct().where("host <> ''")
            .withColumn("labels", labels)
            .withColumn("rule_host", F.explode(F.expr(
                "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")))
            .withColumn("rule_path", F.explode(F.array_distinct(prefixes)))
            .join(rules, ["rule_host", "rule_path"])
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes: canonical links and refresh redirects."""
    tags = lambda kind, goes: F.transform(
        F.regexp_extract_all("html", F.lit(kind), 0), lambda t: F.regexp_extract(t, goes, 1))
    linked = (pages.select("url", "path", "node", F.explode(F.concat(tags(CANONICAL, HREF), tags(REFRESH, GOES))).alias("link"))
              .where("link <> '' and node is not null")
              .select(F.col("node").alias("a"), _absolute(F.col("link"), F.col("url"), F.col("path")).alias("target")))
    return parsed(linked, "target").where("node is not null and a <> node").select("a", F.col("node").alias("b")).distinct()


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path,
    rule, verdict, reason.

    reason is rule, alias or default.  An explicit rule always holds for its
    own url.  A url without one is allowed if any alias is explicitly
    allowed, else blocked if any alias is blocked, else allowed.
    ``redirects`` (from_url, to_url) adds edges, as from a crawl's 30x answers.  A null url, or one
    without ``://``, has empty host and path, no rule, no alias, and is
    allowed; a null html has no links; repeated rows are judged alike; other columns are not read; an empty
    table gives no rows; without rules every url is allowed.
    """
    read = parsed(pages.select("page_id", "url", "html"), "url")
    links = link_edges(read)
    if redirects is not None:
        went = parsed(redirects.select("from_url", "to_url"), "from_url").select(F.col("node").alias("a"), "to_url")
        went = parsed(went, "to_url").select("a", F.col("node").alias("b"))
        links = links.unionByName(went.where("a is not null and b is not null and a <> b")).distinct()
    links = saved(links, "links")
    found = best_rules(read, rules)
    rows = saved(read.drop("html", "url").join(found, ["host", "path"], "left"), "judged")
    if links.isEmpty():
        groups = rows.withColumn("group", F.col("node"))
    else:
        same = connected_components(links)
        groups = rows.join(same, "node", "left").withColumn("group", F.coalesce("label", "node"))
    blocked = (groups.where("group is not null").groupBy("group")
               .agg(F.expr("bool_or(verdict = 'allow')").alias("allowed"), F.expr("bool_or(verdict = 'block')").alias("denied"))
               .where("denied and not coalesce(allowed, false)").select("group", F.lit(True).alias("denied")))
    blocked = checked_broadcast(blocked, F.octet_length("group") + 16)
    return (groups.join(blocked, "group", "left")
            .select("page_id", "host", "path", "rule",
                    F.when(F.col("rule").isNotNull(), F.col("verdict"))
                    .when(F.col("denied"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
                    F.when(F.col("rule").isNotNull(), F.lit("rule"))
                    .when(F.col("denied"), F.lit("alias")).otherwise(F.lit("default")).alias("reason")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(verdict, host, path)")
    return judge(table(spark, sf_dir, "pages"), rules)


def _duck_url(url: str) -> dict[str, str]:
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"
    host = f"translate(regexp_extract(coalesce({rest}, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}')"
    path = f"regexp_extract(coalesce({rest}, ''), '^[^/?#]*([^?#]*)', 1)"
    query = (f"regexp_replace(regexp_replace(regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1), "
             f"'(^|&)utm_[^&]*', '', 'g'), '^&', '')")
    bare = f"regexp_replace({host}, '^www\\.', '')"
    node = (f"CASE WHEN {bare} <> '' THEN {bare} || regexp_replace({path}, '/$', '') || "
            f"CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END")
    return {"host": host, "path": path, "node": node}


def _op2_sql() -> str:
    u, v = _duck_url("url"), _duck_url("target")
    values = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)
    quoted = {k: x.replace("'", "''") for k, x in (("c", CANONICAL), ("r", REFRESH), ("h", HREF), ("g", GOES))}
    return f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {values}),
p AS (SELECT page_id, url, html, {u['host']} AS host, {u['path']} AS path, {u['node']} AS node FROM pages),
links AS (
  SELECT url, node, path, regexp_extract(tag, '{quoted['h']}', 1) AS link
  FROM (SELECT url, node, path, unnest(regexp_extract_all(html, '{quoted['c']}')) AS tag FROM p)
  UNION ALL
  SELECT url, node, path, regexp_extract(tag, '{quoted['g']}', 1)
  FROM (SELECT url, node, path, unnest(regexp_extract_all(html, '{quoted['r']}')) AS tag FROM p)),
targets AS (
  SELECT node, CASE WHEN contains(link, '://') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(url, '^([^:/?#]*):', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '^[^:/?#]*://[^/?#]*') || link
    ELSE regexp_extract(url, '^[^:/?#]*://[^/?#]*')
      || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || link END AS target
  FROM links WHERE link <> '' AND node IS NOT NULL),
half AS (SELECT node AS a, {v['node']} AS b FROM targets),
edges AS (SELECT a, b FROM half WHERE b IS NOT NULL AND a <> b UNION SELECT b, a FROM half WHERE b IS NOT NULL AND a <> b),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
label AS (SELECT a AS node, least(a, min(b)) AS label FROM reach GROUP BY a),
best AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS ruled
  FROM (SELECT DISTINCT host, path FROM p WHERE host <> '') q
  JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path),
judged AS (
  SELECT p.page_id, p.host, p.path, best.rule, best.ruled, coalesce(label, p.node) AS grp
  FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path LEFT JOIN label ON p.node = label.node),
denied AS (
  SELECT grp FROM judged WHERE grp IS NOT NULL GROUP BY grp
  HAVING coalesce(bool_or(ruled = 'block'), false) AND NOT coalesce(bool_or(ruled = 'allow'), false))
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN ruled WHEN d.grp IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN d.grp IS NOT NULL THEN 'alias' ELSE 'default' END AS reason
FROM judged j LEFT JOIN denied d ON j.grp = d.grp
"""


OP2_SQL = _op2_sql()
