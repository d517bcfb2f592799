"""Text normalisation, matching and labelling."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

# Every character Python counts as white space: Unicode spaces and the ASCII separators.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
_WS = r"[\s\x1c-\x1f]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is referred to."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


def collapse_ws(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), rf"(?U){_WS}+", " ")


def drop_parenthetical(c: Column | str) -> Column:
    """Drop ``(...)`` parts, then collapse and strip the white space."""
    return strip_ws(collapse_ws(F.regexp_replace(_c(c), r"\([^)]*\)", "")))


def contains_ci(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test; False for NULL."""
    return F.coalesce(F.lower(_c(c)).contains(needle.lower()), F.lit(False))


def case_label(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose needle occurs in the text."""
    out = None
    for needle, label in rules:
        hit = contains_ci(c, needle)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def first_non_empty(*cols: Column | str) -> Column:
    """First value that is neither NULL nor an empty text."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def last_token(c: Column | str) -> Column:
    """Last white-space separated token; NULL for blank text."""
    return F.nullif(F.regexp_extract(strip_ws(c), r"(?U)([^\s\x1c-\x1f]+)$", 1), F.lit(""))


def map_lookup(c: Column | str, mapping: Mapping[str, object], default: object) -> Column:
    """Value for a key, ``default`` for an unknown one, NULL for NULL."""
    c = _c(c)
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(pairs, c), F.lit(default)))


def preview(c: Column | str, n: int, default: str) -> Column:
    """The first ``n`` characters, or ``default`` where there is no text."""
    return F.substring(F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default)), 1, n)


def percent_text(c: Column | str) -> Column:
    """One decimal and a percent sign, as report lines show a score."""
    return F.format_string("%.1f%%", _c(c).cast("double"))


def md5_hex(c: Column | str) -> Column:
    return F.md5(_c(c))
