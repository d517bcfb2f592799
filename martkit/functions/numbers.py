"""Text to amounts, counts and timestamps; completeness scoring."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from martkit.functions.text import let, strip_ws


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_amount(c: Column | str) -> Column:
    """Digits and dots of a text as a double; NULL where they form no number."""
    kept = F.regexp_replace(_c(c), r"[^0-9.]", "")
    # Only what is a number reaches the cast: a failing one costs an exception per row.
    return F.nullif(F.regexp_extract(kept, r"^([0-9]+\.?[0-9]*|\.[0-9]+)$", 1), F.lit("")).cast("double")


def to_double_lenient(df: DataFrame, name: str) -> Column:
    """Text columns go through ``parse_amount``; numeric ones pass unchanged."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_amount(name)
    return F.col(name).cast("double")


def parse_count(c: Column | str) -> Column:
    """Text to a whole number: NULL stays NULL, anything unreadable becomes 0.

    Surrounding white space, a sign and single underscores between digits are
    allowed.  The result is a bigint, so a value too wide for an ``int`` column
    is still visible to the schema check of the sink; one too wide even for a
    bigint becomes the outermost bigint of its sign, which no ``int`` column holds.
    """
    c = _c(c)
    digits = F.regexp_replace(strip_ws(c), r"(?<=[0-9])_(?=[0-9])", "")
    widest = F.lit(2**63 - 1)
    whole = let(digits, lambda v: F.when(v.rlike(r"^[+-]?[0-9]+$"), F.coalesce(
        v.try_cast("bigint"), F.when(v.startswith("-"), -widest).otherwise(widest))))
    return F.when(c.isNotNull(), F.coalesce(whole, F.lit(0).cast("bigint")))


def to_int_or_zero(df: DataFrame, name: str) -> Column:
    """``parse_count`` for text; numeric columns are cut towards zero."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_count(name)
    return F.col(name).try_cast("bigint")


_ISO = (r"^([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})"
        r"(?:[Tt ]([0-9]{2})(?:(:?)([0-9]{2})(?:\6([0-9]{2})(?:[.,]([0-9]+))?)?)?(?:[Zz]|([+-])([0-9]{2}):?([0-9]{2})?)?)?$")


def parse_iso_ts(c: Column | str, fallback: Column) -> Column:
    """ISO-8601 text to a UTC wall-clock ``timestamp_ntz``; bad text to ``fallback``.

    The extended and the basic form, any number of decimals after a point or a comma (cut to
    six).  A zone suffix is applied by arithmetic, so the result does not depend on the session
    time zone.  NULL stays NULL.  Pass a literal as ``fallback``: one value per run keeps
    re-executed tasks in agreement.  Week dates are not read.
    """
    c = _c(c)

    def part(i: int, default: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(c, _ISO, i), F.lit("")), F.lit(default))
    text = F.concat(part(1, ""), F.lit("-"), part(3, ""), F.lit("-"), part(4, ""), F.lit("T"), part(5, "00"), F.lit(":"),
                    part(7, "00"), F.lit(":"), part(8, "00"), F.lit("."), F.rpad(F.substring(part(9, "0"), 1, 6), 6, "0"))
    minutes = part(11, "0").cast("int") * 60 + part(12, "0").cast("int")
    signed = F.when(part(10, "+") == "-", -minutes).otherwise(minutes)
    return (F.when(c.isNull(), F.lit(None).cast("timestamp_ntz"))
            .when(~c.rlike(_ISO), fallback)
            .otherwise(F.coalesce(text.try_cast("timestamp_ntz") - F.make_dt_interval(mins=signed), fallback)))


def in_range(c: Column | str, low: float, high: float) -> Column:
    """Strictly between ``low`` and ``high``; False for NULL."""
    c = _c(c)
    return F.coalesce((c > low) & (c < high), F.lit(False))


def is_filled(df: DataFrame, name: str) -> Column:
    """True unless the value is NULL, an empty text, zero or false."""
    c, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        ok = c != ""
    elif isinstance(dtype, T.NumericType):
        ok = c != 0
    elif isinstance(dtype, T.BooleanType):
        ok = c
    else:
        ok = c.isNotNull()
    return F.coalesce(ok, F.lit(False))


# The fields that count towards an item's completeness.
SCORED_FIELDS = [
    "title", "price", "upc", "category", "url", "product_type", "rating",
    "price_excl_tax", "price_incl_tax", "image_url", "description",
]


def completeness_score(df: DataFrame, names: Iterable[str] = SCORED_FIELDS) -> Column:
    """Share of filled fields in percent, two decimals; 100 for no fields."""
    names = list(names)
    if not names:
        return F.lit(100.0)
    filled = sum((is_filled(df, n).cast("int") for n in names), F.lit(0))
    return F.round(filled / F.lit(float(len(names))) * 100, 2)
