"""URL filters: host and path rules, and redirect equivalence that carries block decisions to aliases.

All of it is DataFrame work inside the JVM. Pages are nodes named by host, path (without dot segments) and query; all canonical links and
refresh redirects in the markup are edges. Connected components come from alternating large-star and small-star
steps, whose groups are minima and so combine before the shuffle; each step is written to the shared folder.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and no aliases, and is
allowed; null markup has no edges; repeated pages and edges change nothing; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\s[^>]*?\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\s[^>]*?\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty where there is none."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits and its decision, null where none fits. ``rules``: (rule, decision); the list is a parameter, so its size is known."""
    name = verdict = F.lit(None).cast("string")
    for rule, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{rest}"))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def without_dots(path: Column) -> Column:
    """A path that starts with ``/`` without its ``.`` and ``..`` segments, as RFC 3986 removes them; other paths as they are."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x)),
    )
    # A dot segment at the end leaves a folder.
    end = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(F.startswith(path, F.lit("/")) & path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def node(url: Column) -> Column:
    """The name of a url's node: host, path without dot segments, and query, without scheme and fragment; null for an empty host."""
    host = url_host(url)
    return F.when(host != "", F.concat(host, without_dots(url_path(url)), F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)))


def resolved(link: Column, url: Column) -> Column:
    """An absolute form of a link on the page ``url``: with a scheme, of a host, of the host's root, a query of the page itself, a fragment of it, or from its folder on."""
    scheme, host = F.regexp_extract(url, r"^([^:/?#]*)://", 1), url_host(url)
    folder = F.regexp_extract(url_path(url), r"^(.*/)?", 0)
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    top = F.concat(scheme, F.lit("://"), host)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(top, link))
        .when(F.startswith(link, F.lit("?")), F.concat(top, url_path(url), link))
        .when(F.startswith(link, F.lit("#")), url)
        .otherwise(F.concat(top, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (a, b) of different nodes joined by a canonical link or a refresh redirect, of which a page may have several."""

    def of(tag: str, attribute: str) -> Column:
        return F.transform(F.regexp_extract_all(F.col(html), F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, attribute, 1))

    links = pages.filter(F.col(html).rlike(f"{CANONICAL}|{REFRESH}")).select(F.col(url).alias("url"), F.explode(F.concat(of(CANONICAL, HREF), of(REFRESH, TARGET))).alias("link"))
    ends = links.filter("link != ''").select(node(F.col("url")).alias("a"), node(resolved(F.col("link"), F.col("url"))).alias("b"))
    return ends.filter("a != b").distinct()


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, host, path, rule, verdict) for each page.

    A page that a rule fits takes that rule's verdict, so that an explicit allow holds whatever its aliases are. A page without
    a rule is blocked if any alias, that is any node of its component, is blocked by a rule, and allowed otherwise.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    name, decision = best_rule(F.col("host"), F.col("path"), rules)
    own = own.select("*", name.alias("rule"), decision.alias("own"), node(F.col("url")).alias("node"))
    linked = components(page_edges(pages, url, html))
    # A node's name starts with its host, so the rules apply to link targets whether or not they are pages themselves.
    named = F.concat(F.lit("://"), F.col("node"))
    blocked = linked.filter(best_rule(url_host(named), url_path(named), rules)[1] == "block").select("root").distinct()
    aliases = linked.join(blocked, "root", "left_semi").select("node", F.lit(True).alias("alias_blocked"))
    told = own.join(aliases, "node", "left")
    return told.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("own", F.when(F.col("alias_blocked"), "block").otherwise("allow")).alias("verdict"))


def decode_rules(block: Sequence[str], allow: Sequence[str]) -> list[tuple[str, str]]:
    """(rule, decision) pairs; an allow wins over a block of the same rule."""
    return [(r, "allow") for r in allow] + [(r, "block") for r in block if r not in set(allow)]


