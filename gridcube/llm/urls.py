"""URL filter with redirect equivalence.

A URL that a rule fits takes the longest fitting rule's verdict. Redirects and
canonical links join URLs into components; a blocked URL blocks its whole
component, except URLs that a rule allows explicitly. Everything else is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcube.llm.components import connected_components
from gridcube.llm.names import by_place, named

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
_URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    return F.coalesce(_ascii_lower(F.regexp_extract(url, _URL, 2)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 3), F.lit(""))


def _fits(h: Column, p: Column, rule_host: str, rule_path: str) -> Column:
    return ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)


def longest_rule(h: Column, p: Column, rules=RULES, verdict: bool = False) -> Column:
    """The longest fitting rule as host and path (its verdict if asked), or NULL.
    ``rules``: a list of (allow or block, host, path), part of the plan."""
    out = F.lit(None).cast("string")
    for action, rh, rp in sorted(rules, key=lambda r: len(r[1] + r[2])):
        out = F.when(_fits(h, p, rh, rp), F.lit(action if verdict else rh + rp)).otherwise(out)
    return out


def rules_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the distinct (host, path) rows of ``urls`` that
    a rule of the table (action, host, path) fits: the longest, of equally long ones
    the last in code point order. Of two rules for one host and path, block counts.

    A block list of any length is joined, not written into the plan: a url is
    looked up under each of its host's suffixes and each length that rule paths have
    (a short list of numbers), so every lookup is an equality and meets one rule."""
    kept = rules.select("host", "path", "action").where("host is not null and path is not null").groupBy("host", "path").agg(F.max("action").alias("action"))
    lengths = [r.n for r in kept.select(F.length("path").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        return urls.select("host", "path").limit(0).withColumns({"rule": F.lit(""), "action": F.lit("")})
    labels = F.split("host", "[.]", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")), lambda n: F.left("path", n))
    asked = urls.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("h")).select("host", "path", "h", F.explode(heads).alias("p"))
    found = asked.join(kept.select(F.col("host").alias("h"), F.col("path").alias("p"), "action"), ["h", "p"])
    longest = F.max(F.struct(F.length(F.concat("h", "p")).alias("n"), F.concat("h", "p").alias("rule"), "action")).alias("best")
    return found.groupBy("host", "path").agg(longest).select("host", "path", "best.rule", "best.action")


def _ruled(urls: DataFrame, rules) -> DataFrame:
    """``urls`` (with host and path) and their rule and its action as ``__own``."""
    if isinstance(rules, DataFrame):
        found = rules_of(urls, rules).withColumnRenamed("action", "__own")
        return urls.join(found, ["host", "path"], "left")
    return urls.withColumns({"rule": longest_rule(F.col("host"), F.col("path"), rules), "__own": longest_rule(F.col("host"), F.col("path"), rules, verdict=True)})


def node(url: Column) -> Column:
    """A URL as a node: scheme and host in lower case, without its fragment.
    NULL for what is not a URL."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?]*(.*)$", 1)
    return F.when(bare.contains("://"), F.concat(_ascii_lower(F.regexp_extract(bare, r"(?s)^(.*?)://", 1)), F.lit("://"), host(bare), rest))


def link_targets(html: Column, url: Column) -> Column:
    """Absolute targets of a page's canonical links and meta refresh redirects;
    ``&amp;`` is read as &, and relative targets follow the page's ``<base>`` if it
    has an absolute one."""
    href = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
    goto = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""
    canonical = F.transform(F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*+>"), F.lit(0)),
                                     lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?canonical\b""")), lambda t: F.regexp_extract(t, href, 1))
    refresh = F.transform(F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*+>"), F.lit(0)),
                                   lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b""")), lambda t: F.regexp_extract(t, goto, 1))
    base = F.replace(F.regexp_extract(F.regexp_extract(html, r"(?is)<base\b[^>]*+>", 0), href, 1), F.lit("&amp;"), F.lit("&"))
    url = F.when(base.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), base).otherwise(url)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^?#]*/)", 1)
    absolute = lambda t: F.when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), t).when(t.startswith("//"), F.concat(scheme, t)) \
        .when(t.startswith("/"), F.concat(site, t)).otherwise(F.concat(F.when(folder == "", F.concat(site, F.lit("/"))).otherwise(folder), t))
    return F.transform(F.filter(F.concat(canonical, refresh), lambda t: t != ""), lambda t: absolute(F.replace(t, F.lit("&amp;"), F.lit("&"))))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b) between the nodes of pages and of their link targets."""
    html, url = F.col(f"`{html_col}`"), F.col(f"`{url_col}`")
    some = pages.where(html.rlike("(?i)canonical|http-equiv") & url.contains("://")).select(url.alias("u"), html.alias("h"))
    return some.select(node(F.col("u")).alias("a"), F.explode(link_targets(F.col("h"), F.col("u"))).alias("t")) \
        .select("a", node(F.col("t")).alias("b")).where("b is not null")


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` and host, path, rule, verdict. ``rules`` is a short list of (allow
    or block, host, path), which becomes part of the plan, or a table (action, host,
    path) of any length, which is joined.

    Edges come from the pages' html and from ``redirects`` (from_url, to_url)
    if given, such as a crawl's redirect log. A NULL url, or one without ://,
    has an empty host and path, fits no rule and is allowed. Repeated pages are
    judged alike; NULL html has no links; no rows give no rows. Columns of
    ``pages`` with the names added are replaced, others may have any name."""
    pages, at = by_place(pages.drop("host", "path", "rule", "verdict"))
    url = F.col(at[url_col])
    edges = page_links(pages, at[url_col], at[html_col]) if html_col else None
    if redirects is not None:
        more = redirects.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b"))
        edges = more if edges is None else edges.union(more)
    own = _ruled(pages.withColumns({"host": host(url), "path": path(url)}), rules).withColumn("__node", node(url))
    shown = [*named(at), "host", "path", "rule"]
    if edges is None:
        return own.select(*shown, F.coalesce("__own", F.lit("allow")).alias("verdict"))
    groups = connected_components(edges)
    bad = _ruled(groups.withColumns({"host": host(F.col("node")), "path": path(F.col("node"))}), rules).where(F.col("__own") == "block").select("root").distinct()
    blocked = groups.join(bad, "root").select(F.col("node").alias("__node"), F.lit("block").alias("__alias"))
    return own.join(blocked, "__node", "left").select(*shown, F.coalesce("__own", "__alias", F.lit("allow")).alias("verdict"))
