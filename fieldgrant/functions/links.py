"""Hyperlinks in stored web pages, as array expressions (no explode, no shuffle needed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup that hides anchors, and the href value of an anchor tag
# (double-quoted, single-quoted or bare).
HIDDEN_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>"
ANCHOR_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

# Character references decoded inside an attribute; the ampersand comes last.
_ENTITIES = (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def _decode(c: Column) -> Column:
    for entity, char in _ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def hrefs(html: Column) -> Column:
    """All anchor targets of a page, in document order."""
    found = F.regexp_extract_all(F.regexp_replace(html, HIDDEN_MARKUP, " "), F.lit(ANCHOR_HREF), F.lit(1))
    return F.transform(found, lambda h: _decode(F.regexp_replace(h, "^[\"']|[\"']$", "")))


def _without_dot_segments(path: Column) -> Column:
    """Collapse ``.`` and ``..`` in an absolute path; ``..`` never climbs above the root."""
    parts = F.split(F.substring(path, 2, 2_147_483_647), "/")
    none = F.array().cast("array<string>")
    kept = F.aggregate(
        parts,
        none,
        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(p == ".", acc)
        .otherwise(F.concat(acc, F.array(p))),
    )
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(ends_in_dots & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the page address it was found on."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(base_path, r"^(.*/)", 1), F.lit("")), F.lit("/"))

    tail = F.regexp_extract(href, r"([?#].*)$", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rooted = F.when(href.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(origin, _without_dot_segments(rooted), tail))
    )


def first_href(found: Column, contains: str, any_of: Sequence[str]) -> Column:
    """First target holding ``contains`` (exact case) and any of ``any_of`` (any case); NULL if none."""
    def wanted(h: Column) -> Column:
        kind = F.lit(False)
        for text in any_of:
            kind = kind | F.contains(F.lower(h), F.lit(text.lower()))
        return F.contains(h, F.lit(contains)) & kind

    return F.try_element_at(F.filter(found, wanted), F.lit(1))
