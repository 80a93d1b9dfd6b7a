"""URL rules, and block decisions that follow redirect and canonical links to all aliases of a page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkweave.llm.common import ascii_lower, broadcast_within
from sparkweave.sources.files import stored

_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
_TAG = rf"(?i)<(?:link|meta)\b{_ATTRIBUTES}>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_key(url: Column) -> Column:
    """Identity of a URL in the link graph: host, path and query without scheme and fragment; null if there is no host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``rule, action`` from ``(action, "host/path")`` pairs; longer lists can be read as a table of the same form."""
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(a).alias("action")) for a, r in rules]
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.range(0).selectExpr("'' AS rule", "'' AS action")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, action`` for each distinct pair of ``urls(host, path)`` that a rule fits.

    Each host is looked up under all its parent domains, so the work is labels times pages and not rules
    times pages. The longest rule wins; of equal rules that disagree, ``allow``.
    """
    names = rules.filter("rule IS NOT NULL AND action IN ('allow', 'block')").select(
        F.lower(F.regexp_extract("rule", r"(?s)^([^/]*)", 1)).alias("_parent"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("_start"), "rule", "action",
    )
    pairs = urls.select("host", "path").filter("host <> ''").distinct()
    labels = pairs.withColumn("_labels", F.split("host", r"\.", -1))
    parents = labels.withColumn("_parent", F.explode(F.expr(
        "transform(sequence(1, size(_labels)), i -> array_join(slice(_labels, i, size(_labels)), '.'))"
    ))).drop("_labels")
    fits = parents.join(broadcast_within(names), "_parent").filter(F.col("path").startswith(F.col("_start")))
    rank = F.struct(F.char_length("rule"), F.col("action") == "allow", F.col("rule"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), rank).alias("_best"))
    return best.select("host", "path", "_best.rule", "_best.action")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted or not; empty if it is missing."""
    pattern = rf"(?i)[\s\"'/]{name}{_VALUE}"
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def _resolved(href: Column, url: Column) -> Column:
    """An href as an absolute URL of the page's host."""
    link = F.trim(F.replace(href, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(url, r"(?s)^(.*?://)", 1)
    root, path = F.concat(scheme, host_of(url)), path_of(url)
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path, link))
        .when(link.startswith("#") | (link == "") | link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .otherwise(F.concat(root, F.regexp_extract(path, r"(?s)^(.*/)?", 1), F.when(path == "", "/").otherwise(""), link))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``url, target``: canonical links and refresh redirects of each page, comments and scripts left out."""
    some = pages.select(F.col(url).alias("url"), F.col(html).alias("_html")).filter(
        F.col("url").contains("://") & F.col("_html").rlike("(?i)canonical|refresh")
    )
    tags = some.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("_html", _HIDDEN, " "), F.lit(_TAG), F.lit(0))).alias("_tag"))
    tag = F.col("_tag")
    canonical = tag.rlike(r"(?i)^<link") & _attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = tag.rlike(r"(?i)^<meta") & F.lower(F.trim(_attribute(tag, "http-equiv"))).eqNullSafe("refresh")
    to = F.regexp_extract(_attribute(tag, "content"), r"""(?i)url\s*=\s*["']?([^"']*)""", 1)
    href = F.when(canonical, _attribute(tag, "href")).when(refresh, to)
    links = tags.withColumn("_href", href).filter(F.trim("_href") != "")
    return links.select("url", _resolved(F.col("_href"), F.col("url")).alias("target")).filter("target IS NOT NULL").distinct()


def alias_classes(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node) for every node of ``links(a, b)``, by hooking and shortcuts.

    Every class hangs itself below the least class that a link of one of its nodes leads to, and then every node points
    to what its class points to. Minima are summed up before they are shuffled, joins are ones that adaptive execution
    splits at a hub, and each turn is written to the shared folder. Turns grow with the logarithm of the longest way.
    Nulls and links to the node itself are dropped; no links give no rows.
    """
    one = links.select("a", "b").filter("a <> b").distinct()
    both = stored(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "alias-links")
    low = both.groupBy("a").agg(F.min("b").alias("_b"))
    now = stored(low.select(F.col("a").alias("node"), F.least("a", "_b").alias("component")), "alias-classes")
    while True:
        met = both.join(now.select(F.col("node").alias("b"), F.col("component").alias("_c")), "b").groupBy("a").agg(F.min("_c").alias("_c"))
        hooks = now.join(met, F.col("node") == F.col("a")).groupBy("component").agg(F.min("_c").alias("_c"))
        hung = stored(now.join(hooks, "component").select("node", F.least("component", "_c").alias("component")), "alias-hooks")
        on = hung.select(F.col("node").alias("component"), F.col("component").alias("_next"))
        after = stored(hung.join(on, "component").select("node", F.col("_next").alias("component")), "alias-classes")
        moved = after.join(now.withColumnRenamed("component", "_old"), "node").filter("component <> _old")
        if moved.isEmpty():
            return after
        now = after


def judge_pages(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict``, one row per page.

    A page that a rule fits gets that rule's verdict. Every other page is blocked if a chain of redirect or
    canonical links, in either direction, joins it to a URL that a rule blocks; else it is allowed. Only blocks
    spread; an explicit allow rule of a page always stands against a block that would reach it.
    ``redirects(url, target)`` may add links that a crawler saw; they need not be pages.

    Defined cases: null url or one without ``://``: empty host and path, no rule, allowed. Null html: no links.
    Pages with equal URLs share their decision. No pages: no rows. No rules: all allowed.
    """
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    links = stored(links.filter("url IS NOT NULL AND target IS NOT NULL").distinct(), "links")
    members = alias_classes(links.select(url_key(F.col("url")).alias("a"), url_key(F.col("target")).alias("b")))

    ends = links.select("url").unionByName(links.select(F.col("target").alias("url")))
    ends = ends.select(url_key(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).distinct()
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    base = base.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "_node": url_key(F.col("url"))})
    decided = stored(judge(base.select("host", "path").unionByName(ends.select("host", "path")), rules), "decided")

    blocked = ends.join(decided.filter("action = 'block'"), ["host", "path"]).select("node").distinct()
    bad = members.join(blocked, "node").select("component").distinct()
    aliases = stored(members.join(bad, "component").select(F.col("node").alias("_node")).distinct(), "blocked-aliases")
    own = base.join(broadcast_within(decided), ["host", "path"], "left")
    reached = own.join(broadcast_within(aliases).withColumn("_reached", F.lit(True)), "_node", "left")
    verdict = F.coalesce("action", F.when(F.col("_reached"), "block").otherwise("allow"))
    return reached.select("page_id", "url", "host", "path", "rule", verdict.alias("verdict"))
