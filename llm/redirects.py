"""URL rules with redirect equivalence.

Urls are aliases when one redirects to the other or names it as canonical.  Distributed connected components join
aliases into classes; a block rule that fits any url of a class, a page's own or one it only points to, blocks the
class's urls that no rule of their own decides.  A url's own rule always comes first, so an explicit allow stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import only, staged
from llm.components import components

SITE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains and for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(*listed: tuple[str, str]) -> list[Rule]:
    """Rules from ``(verdict, "host/path")``."""
    return [Rule(v, t[: t.index("/")], t[t.index("/") :]) for v, t in listed]


def host(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: F.Column) -> F.Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(urls: DataFrame, listed: list[Rule]) -> DataFrame:
    """``urls`` with ``host``, ``path`` and the longest fitting rule's ``rule`` and ``rule_verdict``.

    The rules are a short list that becomes one expression; of two equal rules the first counts.
    """
    rows = urls.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(listed, key=lambda r: -len(r.text))[::-1]:
        fits = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        fits &= F.col("path").startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    rows = rows.withColumn("found", found)
    return rows.withColumn("rule", F.col("found.rule")).withColumn("rule_verdict", F.col("found.verdict")).drop("found")


def node(url: F.Column) -> F.Column:
    """The url by which aliases meet: scheme and host in lower case, no fragment; a url without both stays as it is."""
    site = F.regexp_extract(url, SITE, 1)
    rest = F.regexp_extract(F.substr(url, F.length(site) + 1), r"(?s)^([^#]*)", 1)
    return F.when(site != "", F.concat(F.translate(site, UPPER, LOWER), rest)).otherwise(url)


def without_dots(path: F.Column) -> F.Column:
    """A path that begins with ``/`` without its ``.`` and ``..`` segments."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    ends = F.element_at(parts, -1).isin(".", "..")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x))),
    )
    whole = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(ends & (F.size(kept) > 0), F.concat(whole, F.lit("/"))).otherwise(whole)


def resolved(base: F.Column, target: F.Column) -> F.Column:
    """``target`` without fragment as seen from the page ``base``; null for schemes without a host and for pages without one."""
    page = F.regexp_extract(base, r"(?s)^([^#]*)", 1)
    site = F.regexp_extract(page, SITE, 1)
    scheme = F.regexp_extract(site, r"^([^:]*:)", 1)
    own = F.regexp_extract(F.substr(page, F.length(site) + 1), r"(?s)^([^?]*)", 1)
    # "http:page" on a page of the same scheme is relative, too.
    again = F.lower(target).startswith(F.lower(scheme)) & ~target.rlike(r"^[^:]*://")
    near = F.when(again, F.substr(target, F.length(scheme) + 1)).otherwise(target)
    near = F.regexp_extract(near, r"(?s)^([^#]*)", 1)
    first, query = F.regexp_extract(near, r"(?s)^([^?]*)", 1), F.regexp_extract(near, r"(?s)^[^?]*(.*)$", 1)
    folder = F.when(own == "", "/").otherwise(F.regexp_extract(own, r"(?s)^(.*/)", 1))
    return (
        F.when(near.rlike(SITE), near)
        .when((site == "") | near.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(near == "", page)
        .when(near.startswith("//"), F.concat(scheme, near))
        .when(first == "", F.concat(site, own, query))
        .otherwise(F.concat(site, without_dots(F.when(first.startswith("/"), first).otherwise(F.concat(folder, first))), query))
    )


def links(pages: DataFrame) -> DataFrame:
    """Edges ``a, b`` from each page's url to the targets of all its meta redirects and canonical links.

    Relative targets are completed from the page's url, its ``<base>`` is not looked at; targets such as ``mailto:`` are no urls.
    """
    html = F.coalesce("html", F.lit(""))
    canonical = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    refresh = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*'?([^\"'\s>]+)"
    # Most pages have neither word, and a plain search passes them over.
    low = F.lower(html)
    likely = low.contains("canonical") | low.contains("http-equiv")
    rows = pages.filter("url IS NOT NULL").filter(likely)
    targets = F.explode(F.concat(F.regexp_extract_all(html, F.lit(canonical), F.lit(1)), F.regexp_extract_all(html, F.lit(refresh), F.lit(1))))
    rows = rows.select("url", targets.alias("target"))
    target = F.replace("target", F.lit("&amp;"), F.lit("&"))
    rows = rows.select(F.col("url").alias("a"), resolved(F.col("url"), target).alias("b"))
    return rows.filter("b IS NOT NULL AND a <> b")


def judge(pages: DataFrame, listed: list[Rule], more_links: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages(page_id, url, html)``.

    ``more_links(a, b)`` adds edges known from elsewhere, such as a crawl's redirect log.  Null html has no links; a
    null or malformed url has an empty host and path and is allowed; repeated rows and ids are judged one by one;
    other columns are ignored.  Urls that differ in a fragment or in capitals of scheme or host are the same ``node``.  A url without a rule of its own is blocked if its class holds a blocked url.
    """
    pages = only(pages, page_id="page_id", url="url", html="html")
    ruled = with_rule(pages.select("page_id", "url"), listed)
    edges = links(pages)
    if more_links is not None:
        edges = edges.union(more_links.select("a", "b"))
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL").select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b"))
    edges = staged(edges.filter("a <> b"), "links")
    if edges.isEmpty():
        blocked = None
    else:
        member = components(edges)
        decided = with_rule(member.withColumnRenamed("node", "url"), listed)
        bad = decided.filter("rule_verdict = 'block'").select("component").distinct()
        blocked = member.join(bad, "component", "left_semi").select(F.col("node").alias("alias"), F.lit(True).alias("by_class"))
    if blocked is None:
        verdict = F.coalesce("rule_verdict", F.lit("allow"))
    else:
        ruled = ruled.join(blocked, node(F.col("url")) == F.col("alias"), "left")
        verdict = F.coalesce("rule_verdict", F.when(F.col("by_class"), "block"), F.lit("allow"))
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
