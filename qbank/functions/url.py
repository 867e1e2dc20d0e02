"""URL-derived columns (P1-P4) and link routing (F1, F2).

All are built-in column expressions, so they stay inside whole-stage codegen
and can be pushed below joins by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qbank.functions.util import as_col

# Routing rules of the two book crawls, first match wins.
ECON_ROUTES = [
    ("key-terms", "key_terms"),
    ("key-concepts-and-summary", "key_concepts"),
    ("self-check-questions", "self_check"),
]
FINANCE_ROUTES = [
    ("key-terms", "key_terms"),
    ("summary", "summary"),
    ("multiple-choice", "multiple_choice"),
    ("review-questions", "review_questions"),
    ("problems", "problems"),
]
FINANCE_DEFAULT_ROUTE = "chapter"


def chapter_name(url) -> Column:
    """Last ``/`` segment (query string and fragment included; '' on a
    trailing slash)."""
    return F.element_at(F.split(as_col(url), "/"), -1)


def textbook_name(url) -> Column:
    """Segment index 4 (0-based); NULL when the URL is shorter."""
    return F.get(F.split(as_col(url), "/"), 4)


def section_slug(name) -> Column:
    """Drop the first ``-`` token, glue the rest: ``3-key-terms`` -> ``keyterms``."""
    parts = F.split(as_col(name), "-")
    return F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "")


def base_url(url) -> Column:
    """The URL minus its last segment."""
    u = as_col(url)
    return F.left(u, F.length(u) - F.length(chapter_name(u)))


def _route(link, rules, default) -> Column:
    lk = as_col(link)
    expr = None
    for needle, route in rules:
        cond = lk.contains(needle)
        expr = F.when(cond, F.lit(route)) if expr is None else expr.when(cond, F.lit(route))
    return expr.otherwise(F.lit(default) if default is not None else F.lit(None).cast("string"))


def route_econ(link) -> Column:
    """route of a TOC link in an economics book; NULL = not followed."""
    return _route(link, ECON_ROUTES, None)


def route_finance(link) -> Column:
    """route of a TOC link in the finance book; everything else is a chapter."""
    return _route(link, FINANCE_ROUTES, FINANCE_DEFAULT_ROUTE)


def remove_dot_segments(path) -> Column:
    """RFC 3986 dot-segment removal on an absolute path (``/a/b/../c`` ->
    ``/a/c``; a final ``.`` or ``..`` leaves a trailing slash)."""
    p = as_col(path)
    segs = F.split(p, "/")
    rest = F.slice(segs, 2, F.greatest(F.size(segs) - 1, F.lit(0)))
    out = F.aggregate(rest, F.array().cast("array<string>"), lambda acc, x: (
        F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x)))))
    trailing = F.element_at(segs, -1).isin(".", "..") & (F.size(out) > 0)
    cleaned = F.concat(F.lit("/"), F.array_join(out, "/"),
                       F.when(trailing, F.lit("/")).otherwise(""))
    # a dot segment always follows a slash: most paths skip the fold entirely
    return F.when(p.contains("/."), cleaned).otherwise(p)


def resolve_url(base, link) -> Column:
    """Resolve a (possibly relative) link against the page URL as a browser
    does (RFC 3986 merge + dot-segment removal), dropping the fragment.
    Handles absolute (``scheme:``), scheme-relative (``//``), root-relative
    (``/x``), query-only (``?q``), empty and directory-relative links."""
    b = F.regexp_replace(as_col(base), "#.*$", "")
    lk = F.regexp_replace(as_col(link), "#.*$", "")
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(b, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    link_path = F.regexp_extract(lk, r"^([^?]*)", 1)
    link_query = F.regexp_extract(lk, r"(\?.*)$", 1)
    directory = F.when(base_path == "", F.lit("/")).otherwise(
        F.regexp_replace(base_path, r"[^/]*$", ""))
    return (
        F.when(lk.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), lk)
        .when(lk.startswith("//"), F.concat(scheme, lk))
        .when(lk == "", b)
        .when(lk.startswith("?"), F.concat(origin, base_path, lk))
        .when(lk.startswith("/"), F.concat(origin, remove_dot_segments(link_path), link_query))
        .otherwise(F.concat(origin, remove_dot_segments(F.concat(directory, link_path)),
                            link_query))
    )
