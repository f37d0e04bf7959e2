"""URL helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import blank, col, strip

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def _resolve_dots(path: Column) -> Column:
    """Remove "." and ".." segments from an absolute path."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(p == ".", acc).otherwise(F.array_append(acc, p)))
    tail = F.when(path.rlike(r"(^|/)\.{1,2}$"), "/").otherwise("")
    return F.concat(F.array_join(kept, "/"), tail)


def absolute_url(url: Column | str, base: Column | str) -> Column:
    """Resolve a link against a base URL. ``base`` as text is a literal."""
    link = blank(url)
    base = F.lit(base) if isinstance(base, str) else base
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, _PATH, 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    query = F.regexp_extract(link, r"([?#].*)$", 1)
    rel = F.regexp_replace(link, r"[?#].*$", "")
    full = F.when(rel.startswith("/"), rel).otherwise(F.concat(folder, rel))
    full = F.when(full.rlike(r"(^|/)\.{1,2}(/|$)"), _resolve_dots(full)).otherwise(full)
    return (F.when(link.rlike(_SCHEME), link)
            .when(link.startswith("//"), F.concat(scheme, link))
            .when(rel == "", F.concat(origin, path, query))
            .otherwise(F.concat(origin, full, query)))


def clean_url(url: Column | str, base: Column | str) -> Column:
    """Trimmed absolute URL without doubled slashes after the scheme; blank stays blank."""
    link = strip(blank(url))
    return F.when(link == "", "").otherwise(
        F.regexp_replace(absolute_url(link, base), r"(?<!:)//+", "/"))


def slug_from_url(url: Column | str) -> Column:
    """Last path segment; query, fragment and a trailing "/" are ignored."""
    path = F.regexp_extract(strip(blank(url)), _PATH, 1)
    path = F.regexp_replace(F.regexp_replace(path, ";[^/]*$", ""), "/+$", "")
    return F.regexp_extract(path, "([^/]*)$", 1)


def host_of(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def path_of(url: Column | str) -> Column:
    path = F.regexp_extract(col(url), _PATH, 1)
    return F.when(path == "", "/").otherwise(path)


def quote(text: Column | str) -> Column:
    """Percent-encoding with spaces as %20, "/" and "~" kept, "*" encoded."""
    out = F.url_encode(blank(text))
    for found, kept in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(found), F.lit(kept))
    return out
