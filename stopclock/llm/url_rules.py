"""URL filters: allow and block rules, carried over redirects and canonical links.

A rule names a host with all its subdomains and the beginning of a path; of the rules that
fit, the longest wins.  Pages without a rule take the decision of their equivalence class:
redirects and canonical links are edges between addresses, and the class is the connected
component.  An explicit rule of the page itself always stands; within a class an explicit
allow goes before a block; without either the page is allowed.

Results in special cases: a null url, or one without ``://``, has an empty host and path, no
rule and no edges, and is allowed; repeated pages are judged row by row; null html has no
links; relative links are resolved against the page's address, links of schemes without
``//`` and mere fragments name no address; an empty table gives an empty result.  Input columns other than ``page_id``, ``url``
and ``html`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopclock.llm.common import cut
from stopclock.llm.graph import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Tags in which a page names another address of its own.
TAG = r"(?i)<(?:link|meta)\b[^<>]*>"
CANONICAL = r"""(?i)^<link\b[^<>]*[\s"'/]rel\s*=\s*(?:"[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"""
REFRESH = r"""(?i)^<meta\b[^<>]*[\s"'/]http-equiv\s*=\s*["']?\s*refresh\b"""
OG_URL = r"""(?i)^<meta\b[^<>]*[\s"'/](?:property|name)\s*=\s*["']?\s*og:url\b"""
#: Value of an attribute, quoted or not: one of three groups.
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
HREF, CONTENT = r"""(?i)[\s"'/]href""" + VALUE, r"""(?i)[\s"'/]content""" + VALUE
REFRESH_TO = r"""(?i)\burl\s*=\s*['"]?([^'"\s]+)"""
#: A redirecting address carries its whole target in the query, often percent-encoded.
REDIRECT = r"[?&](?:url|redirect|target|dest)=([^&#]+)"
ABSOLUTE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
BAD_ESCAPE = r"%(?:[^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)"
OTHER_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


def _rest(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.expr("substring(__url, locate('://', __url) + 3)"))


def with_address(df: DataFrame, url: str) -> DataFrame:
    """Add host, path and ``address`` (host, path and query; null without ``://``)."""
    df = df.withColumn("__url", F.col(url))
    df = df.withColumn("__rest", _rest(F.col("__url")))
    host = F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), UPPER, LOWER)
    return (
        df.withColumn("host", F.coalesce(host, F.lit("")))
        .withColumn("path", F.coalesce(F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1), F.lit("")))
        .withColumn("address", F.concat(host, F.regexp_extract("__rest", r"^[^/?#]*([^#]*)", 1)))
        .drop("__url", "__rest")
    )


def fitting(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict of the distinct (host, path) pairs that some rule fits.

    ``rules``: rule_host, rule_path, verdict.  Every suffix of a host at a dot is looked up
    by equality; Spark broadcasts the rules if they are small.
    """
    pairs = addresses.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return (
        pairs.withColumn("rule_host", F.explode(suffixes))
        .join(rules, "rule_host")
        .filter(F.col("path").startswith(F.col("rule_path")))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct("rule", "verdict"), F.struct(F.length("rule"), F.length("rule_host"), "verdict")
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )


def _attribute(tag: Column, pattern: str) -> Column:
    """Value of an attribute of a tag; empty without it."""
    value = F.concat(*(F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)))
    return F.trim(F.replace(value, F.lit("&amp;"), F.lit("&")))


def _decoded(value: Column) -> Column:
    """Percent-escapes resolved, a plus sign kept; a value with a broken escape as it is."""
    plain = F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(value.rlike(BAD_ESCAPE), value).otherwise(F.coalesce(plain, value))


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of a path resolved."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    closed = F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    kept = F.aggregate(
        F.slice(closed, 2, F.greatest(F.size(closed) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolved(link: Column, host: Column, path: Column) -> Column:
    """The whole address that a link on a page means; null where it names none."""
    file = F.regexp_extract(link, r"^[^?#]*", 0)
    rest = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    whole = F.when(link.startswith("/"), file).otherwise(F.concat(folder, file))
    return (
        F.when(link.rlike(ABSOLUTE), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when((link == "") | link.startswith("#") | link.rlike(OTHER_SCHEME), F.lit(None))
        .when(file == "", F.concat(F.lit("http://"), host, path, rest))
        .otherwise(F.concat(F.lit("http://"), host, _without_dots(whole), rest))
    )


def links(pages: DataFrame) -> DataFrame:
    """Edges u, v between addresses: each page's and those that it names as its own, in the
    query of its url, by canonical links, refreshes and ``og:url``; all of them count."""
    tags = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(TAG), F.lit(0))

    def of_tags(kind: str, read) -> Column:
        return F.transform(F.filter(tags, lambda t: t.rlike(kind)), read)

    targets = F.transform(F.regexp_extract_all("url", F.lit(REDIRECT), F.lit(1)), _decoded)
    found = F.concat(
        F.filter(targets, lambda t: t.rlike(ABSOLUTE)),
        of_tags(CANONICAL, lambda t: _attribute(t, HREF)),
        of_tags(REFRESH, lambda t: F.regexp_extract(_attribute(t, CONTENT), REFRESH_TO, 1)),
        of_tags(OG_URL, lambda t: _attribute(t, CONTENT)),
    )
    rows = with_address(pages, "url").filter("address IS NOT NULL")
    rows = rows.select("host", "path", F.col("address").alias("u"), F.explode(found).alias("link"))
    whole = resolved(F.col("link"), F.col("host"), F.col("path"))
    rows = rows.select("u", whole.alias("link")).filter("link IS NOT NULL")
    return with_address(rows, "link").select("u", F.col("address").alias("v"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, component (null outside every class)."""
    rows = with_address(pages.select("page_id", "url"), "url").select("page_id", "host", "path", "address")
    edges = links(pages.select("url", "html")).filter("u <> v")
    classes = cut(components(edges), "url-classes")
    known = with_address(
        classes.select("node", "component", F.concat(F.lit("http://"), "node").alias("link")), "link"
    )
    ruled = fitting(rows.select("host", "path").union(known.select("host", "path")), rules)
    ruled = cut(ruled, "url-rules")
    decided = (
        known.join(ruled, ["host", "path"])
        .groupBy("component")
        .agg(F.min("verdict").alias("class_verdict"))  # allow sorts before block
    )
    own = classes.join(decided, "component", "left").select(
        F.col("node").alias("address"), "component", "class_verdict"
    )
    # Both tables grow with the pages.  Their files are far smaller than their rows, so Spark
    # would take them for small ones and send them to every executor.
    return (
        rows.join(ruled.hint("merge"), ["host", "path"], "left")
        .join(own.hint("merge"), "address", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("verdict", "class_verdict", F.lit("allow")).alias("verdict"),
            "component",
        )
    )
