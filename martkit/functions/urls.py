"""URL resolution and short names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fold_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments of an absolute path."""
    parts = F.split(F.regexp_replace(path, r"^/", ""), "/", -1)
    last = F.element_at(parts, -1)

    def step(acc: Column, seg: Column) -> Column:
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(seg == "..", up).when(seg == ".", acc).otherwise(F.concat(acc, F.array(seg)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    # A path that ends in a dot segment names a directory.
    tail = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), tail)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute form of ``href`` seen from ``base`` (RFC 3986 reference resolution).

    A base path without dot segments and an href without them need no folding;
    only the others pay for it.
    """
    base, href = _c(base), _c(href)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    base_query = F.regexp_extract(base, r"^[^#]*?(\?[^#]*)", 1)
    base_dir = F.concat(F.regexp_replace(base_path, r"/[^/]*$", ""), F.lit("/"))

    ref_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    ref_tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    joined = F.when(href.startswith("/"), ref_path).otherwise(F.concat(base_dir, ref_path))
    folded = F.when(joined.rlike(r"/\.\.?(/|$)"), _fold_dots(joined)).otherwise(joined)

    return (F.when(href == "", base)
            .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("#"), F.concat(site, base_path, base_query, href))
            .when(href.startswith("?"), F.concat(site, base_path, href))
            .otherwise(F.concat(site, folded, ref_tail)))


def basename(c: Column | str) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(_c(c), "/", -1), -1)


def short_key(c: Column | str, max_length: int = 50) -> Column:
    """The last path segment of a long URL; a short URL is its own key."""
    c = _c(c)
    return F.when(F.length(c) > max_length, basename(c)).otherwise(c)
