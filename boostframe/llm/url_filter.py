"""URL block lists with redirect equivalence (operator 13).

A url is judged by the longest rule that fits it. Urls that are one page under several names (a redirect, a canonical
link, another spelling) form an alias class: connected components over link edges, of the canonical spellings of both
ends. A block of any member holds for all members that no rule of their own allows: an explicit allow takes precedence.

Everything is joined on urls, hosts and rule keys, never on texts: rules are found by host suffix and path length, so
neither the number of rules nor that of urls meets in one task, and only edges (not all urls) enter the components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, components, cut, prepare, table

ALLOW, BLOCK = "allow", "block"
#: Longest host name that a rule can have (the limit of the domain name system).
MAX_HOST = 253
#: Query parameters that only say where a visitor came from (fixed values).
TRACKING = ("fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
#: Host labels of other editions of a site (fixed values).
EDITIONS = ("m", "mobile", "www")
#: The rules of the registered query (fixed values): verdict, host, path.
RULES = [(ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1"), (ALLOW, "com", "/fr/"),
         (BLOCK, "com", "/de/")]


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def spelling(url: Column) -> Column:
    """One name for the spellings of a url: no scheme, no ``www.`` or ``m.``, no fragment, no tracking parameters, no
    slash at the end. Urls without ``://`` stay as they are."""
    host = F.regexp_replace(host_of(url), f"^({'|'.join(EDITIONS)})[.]", "")
    query = F.regexp_extract(_after_scheme(url), "^[^?#]*[?]([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&", -1), lambda x: ~F.split_part(x, F.lit("="), F.lit(1)).isin(*TRACKING, "")), "&")
    name = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.instr(url, "://") > 0, name).otherwise(url)


_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(value, r"""^["']|["']$""", "")


def resolve(base: Column, link: Column) -> Column:
    """``link`` as found in the page ``base``: absolute, ``//host/...``, ``/path`` or relative to the page's folder."""
    link = F.regexp_replace(F.btrim(link, F.lit(" \t\n\x0b\x0c\r")), "(?i)&amp;", "&")
    scheme = F.split_part(base, F.lit("://"), F.lit(1))
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(base), "^.*/", 0), F.lit("")), F.lit("/"))
    return (F.when(link == "", None).when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(site, link))
            .when(F.startswith(link, F.lit("?")), F.concat(site, path_of(base), link))
            .when(F.startswith(link, F.lit("#")), base)
            .otherwise(F.concat(site, folder, link)))


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (src, dst, kind) that the pages themselves state: ``<link rel=canonical href>`` (kind ``canonical``) and
    ``<meta http-equiv=refresh content="..url=..">`` (kind ``redirect``), outside comments, scripts and styles.

    Relative links are resolved against the page's url. Pages without url or html, and urls without ``://``, give none.
    Repeated pages repeat their edges; columns other than ``url`` and ``html`` are ignored.
    """
    rows = (pages.select("url", "html").where(F.instr("url", "://") > 0)
            .where(F.col("html").rlike("(?i)canonical|refresh"))
            .select("url", F.regexp_replace("html", _HIDDEN, "").alias("html")))
    tags = rows.select("url", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))).alias("tag"))
    words = F.split(F.lower(_attribute(F.col("tag"), "rel")), r"\s+")
    content = F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)^[^;,]*[;,]\s*url\s*=\s*(.*)$", 1)
    canonical = F.when(F.array_contains(words, "canonical"), _attribute(F.col("tag"), "href"))
    redirect = F.when(F.lower(_attribute(F.col("tag"), "http-equiv")) == "refresh",
                      F.regexp_replace(content, r"""^["']|["']$""", ""))
    return (tags.select(F.col("url").alias("src"), F.coalesce(canonical, redirect).alias("link"),
                        F.when(canonical.isNotNull(), F.lit("canonical")).otherwise("redirect").alias("kind"))
            .select("src", resolve(F.col("src"), F.col("link")).alias("dst"), "kind").where("dst is not null"))


def _host_suffixes(host: Column) -> Column:
    """The host and what follows each of its dots, up to MAX_HOST characters."""
    tail = F.right(host, F.lit(MAX_HOST + 1))
    after = F.filter(F.sequence(F.lit(2), F.length(tail) + 1), lambda i: F.substring(tail, i - 1, F.lit(1)) == ".")
    rest = F.transform(after, lambda i: F.substring(tail, i, F.length(tail)))
    return F.when(F.length(host) == 0, F.array(F.lit(""))).when(F.length(host) > MAX_HOST, rest).otherwise(
        F.concat(F.array(host), rest))


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct ``url`` with ``host`` and ``path``) with ``rule`` and ``said`` of the longest rule that fits,
    null where none does. Rules of one length: an allow before a block, then the smallest rule text."""
    rules = (rules.where("host is not null and path is not null").where(F.col("verdict").isin(ALLOW, BLOCK))
             .select(F.col("verdict").alias("said"), F.translate("host", UPPER, UPPER.lower()).alias("rule_host"),
                     F.col("path").alias("rule_path")))
    lengths = rules.select("rule_host", F.length("rule_path").alias("n")).distinct()
    hosts = (urls.select("host").distinct().select("host", F.explode(_host_suffixes(F.col("host"))).alias("rule_host"))
             .join(lengths, "rule_host"))
    rank = F.struct(F.length("rule"), F.col("said") == ALLOW)
    fits = (urls.join(hosts, "host").where(F.length("path") >= F.col("n"))
            .withColumn("rule_path", F.expr("left(path, n)")).join(rules, ["rule_host", "rule_path"])
            .select("url", F.concat("rule_host", "rule_path").alias("rule"), "said")
            .groupBy("url").agg(F.max(F.struct(rank.alias("rank"), F.struct("rule", "said").alias("best"))).alias("top")))
    return urls.join(fits.select("url", "top.best.rule", "top.best.said"), "url", "left")


def url_verdicts(urls: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """url, host, path, rule and verdict of every distinct ``url`` of ``urls``.

    ``rules`` has verdict (``allow`` or ``block``), host and path; a rule fits its host and all subdomains where the
    url's path starts with its path, and the longest rule (host and path) wins. ``edges`` has src and dst: urls that are
    one page. A url without a rule is blocked if any member of its alias class, in ``urls`` or only in ``edges``, is
    blocked by a rule; else it is allowed. A url's own rule always decides for itself, so an explicit allow stands
    beside a blocked alias.

    Null or empty urls, and urls without ``://``, have an empty host and path, fit no rule of a host and are aliases of
    nothing but what an edge names; null ends of edges are ignored, repeated ones count once. Rules with a null part or
    another verdict are ignored, and so are hosts of rules beyond 253 characters. Extra columns are ignored.
    """
    spark = urls.sparkSession
    prepare(spark)
    url = F.col("url")
    edges = cut(edges.where("src is not null and dst is not null").select("src", "dst").distinct(), "links")
    ends = edges.select(F.col("src").alias("url")).union(edges.select(F.col("dst").alias("url")))
    named = (urls.select("url").withColumn("asked", F.lit(True)).union(ends.withColumn("asked", F.lit(False)))
             .groupBy("url").agg(F.max("asked").alias("asked"))
             .select("url", "asked", host_of(url).alias("host"), path_of(url).alias("path"), spelling(url).alias("name")))
    judged = cut(rule_of(cut(named.where("url is not null"), "urls"), rules), "ruled")
    classes = components(edges.select(spelling(F.col("src")).alias("a"), spelling(F.col("dst")).alias("b")), "a", "b")
    judged = (judged.join(classes.select(F.col("node").alias("name"), "component"), "name", "left")
              .withColumn("class", F.coalesce("component", "name")))
    blocked = judged.where(F.col("said") == BLOCK).select("class").distinct().withColumn("tainted", F.lit(True))
    verdict = F.coalesce("said", F.when(F.col("tainted"), F.lit(BLOCK)), F.lit(ALLOW))
    known = judged.where("asked").join(blocked, "class", "left").select("url", "host", "path", "rule", verdict.alias("verdict"))
    nameless = urls.select("url").where("url is null").distinct().select(
        "url", F.lit("").alias("host"), F.lit("").alias("path"), F.lit(None).cast("string").alias("rule"),
        F.lit(ALLOW).alias("verdict"))
    return known.union(nameless)


def judge_pages(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every row of ``pages`` (page_id, url, html): `url_verdicts` under
    the edges that the pages state and ``edges`` (src, dst), such as the redirects of a crawl log."""
    links = page_links(pages).select("src", "dst")
    links = links if edges is None else links.union(edges.select("src", "dst"))
    rows = pages.select("page_id", "url")
    found = url_verdicts(rows, rules, links).withColumnRenamed("url", "_u")
    return rows.join(found, F.col("url").eqNullSafe(F.col("_u")), "left").drop("_u")


def rule_table(spark: SparkSession, rules=tuple(RULES)) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def query(spark, sf_dir):
    return judge_pages(table(spark, sf_dir, "pages"), rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)


def _sql_parts(url: str) -> dict[str, str]:
    rest = f"CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"
    host = f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}'), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    asked = f"regexp_extract({rest}, '^[^?#]*[?]([^#]*)', 1)"
    lost = ", ".join(f"'{x}'" for x in (*TRACKING, ""))
    kept = f"array_to_string(list_filter(string_split({asked}, '&'), lambda x: split_part(x, '=', 1) NOT IN ({lost})), '&')"
    name = (f"CASE WHEN strpos({url}, '://') > 0 THEN regexp_replace({host}, '^({'|'.join(EDITIONS)})[.]', '') || "
            f"regexp_replace({path}, '/+$', '') || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END ELSE {url} END")
    return {"host": host, "path": path, "name": name}


_S = _sql_parts("url")
#: The tables hold no page that states a canonical link or a refresh, so the SQL needs spellings alone as aliases.
SQL = rf"""
WITH rules(said, rule_host, rule_path) AS (VALUES {_VALUES}),
u AS (SELECT DISTINCT url, {_S['host']} AS host, {_S['path']} AS path, {_S['name']} AS name FROM pages),
fits AS (SELECT u.url, max_by(struct_pack(rule := rule_host || rule_path, said := said),
                              2 * length(rule_host || rule_path) + (said = 'allow')::INT) AS best
         FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
         GROUP BY u.url),
j AS (SELECT u.*, best.rule AS rule, best.said AS said FROM u LEFT JOIN fits ON u.url = fits.url),
b AS (SELECT DISTINCT name FROM j WHERE said = 'block')
SELECT p.page_id, j.host, j.path, j.rule,
       CASE WHEN said IS NOT NULL THEN said WHEN b.name IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM pages p JOIN j ON p.url IS NOT DISTINCT FROM j.url LEFT JOIN b ON j.name = b.name
"""
