"""Stock texts: quantity, in-stock decision and a clean label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions.text import drop_parenthetical, strip_ws

# --- fixed values: patterns in order of precedence, phrases, labels, bounds ---
QUANTITY_PATTERNS = [
    r"\(([0-9]+)\s+available\)",
    r"available\s*[:\-]?\s*([0-9]+)",
    r"([0-9]+)\s+available",
    r"\(([0-9]+)\s*in\s*stock\)",
    r"in\s+stock\s*[:\-]?\s*([0-9]+)",
    r"([0-9]+)\s+in\s+stock",
    r"stock\s*[:\-]?\s*([0-9]+)",
    r"\b([0-9]+)\s*(?:pcs?|items?|units?)\b",
    r"\b([0-9]+)\s+left\b",
    r"\b([0-9]+)\s+remaining\b",
    r"\b([0-9]+)\b",
]
# What a text must hold for the pattern at the same place to match, in small letters; one of them is enough.
PATTERN_NEEDS = [
    ["available"], ["available"], ["available"], ["stock"], ["stock"], ["stock"], ["stock"],
    ["pc", "item", "unit"], ["left"], ["remaining"], [],
]
OUT_PHRASES = ["out of stock", "not available", "sold out", "нет в наличии"]
IN_PHRASES = ["in stock", "available", "есть в наличии"]
STATUS_RULES = [("in stock", "in_stock"), ("out of stock", "out_of_stock")]
QUANTITY_BOUNDS = (0, 1000)
# --- end of fixed values ------------------------------------------------------


def first_pattern_int(c: Column | str, patterns: Sequence[str] = QUANTITY_PATTERNS,
                      low: int = QUANTITY_BOUNDS[0], high: int = QUANTITY_BOUNDS[1],
                      needs: Sequence[Sequence[str]] | None = None, lowered: Column | str | None = None) -> Column:
    """Number of the first pattern whose first match lies between the bounds, else 0.

    The bounds are 0 and a power of ten, so that they can be read off the digits: a number in
    range has that many digits at most after its leading zeros, and one at least.

    ``needs`` names texts of which a match holds one (those of the stock patterns by default): a pattern is
    tried only where ``lowered``, the text in small letters, has it.  That test is one for ASCII texts; in others
    letters such as the long s fold to ASCII ones, so there every pattern is tried.
    """
    digits = len(str(high)) - 1
    if low != 0 or high != 10 ** digits:
        raise ValueError("the bounds must be 0 and a power of ten")
    c = F.col(c) if isinstance(c, str) else c
    lowered = F.lower(c) if lowered is None else F.col(lowered) if isinstance(lowered, str) else lowered
    if needs is None:
        needs = PATTERN_NEEDS if patterns is QUANTITY_PATTERNS else [[]] * len(patterns)
    usable = rf"^0*([1-9][0-9]{{0,{digits - 1}}})$"
    folds = F.octet_length(c) != F.length(c)
    # Lazily in order, without a lambda: a pattern is tried only where the ones before it gave nothing, and
    # only the one that gives the number is evaluated twice.
    hits = []
    for pattern, words in zip(patterns, needs, strict=True):
        hit = F.nullif(F.regexp_extract(F.regexp_extract(c, "(?iU)" + pattern, 1), usable, 1), F.lit(""))
        hits.append(F.when(_any_of(lowered, words) | folds, hit) if words else hit)
    return F.when(c.rlike("[0-9]"), F.coalesce(*hits, F.lit("0")).cast("int")).when(c.isNotNull(), F.lit(0))


def stock_status(c: Column | str, lowered: Column | str, quantity: Column | str) -> Column:
    """"in_stock", "out_of_stock" or, for a missing or empty text, "unknown".

    Out-phrases win over in-phrases, which win over the number found.  A text of
    white space only is "out_of_stock".
    """
    c, lowered, quantity = (F.col(x) if isinstance(x, str) else x for x in (c, lowered, quantity))
    return (F.when(c.isNull() | (c == ""), "unknown")
            .when(_any_of(lowered, OUT_PHRASES), "out_of_stock")
            .when(_any_of(lowered, IN_PHRASES) | (quantity > 0), "in_stock")
            .otherwise("out_of_stock"))


def _any_of(lowered: Column, phrases: Sequence[str]) -> Column:
    out = F.lit(False)
    for phrase in phrases:
        out = out | lowered.contains(phrase)
    return out


def availability_label(c: Column | str, clean: Column | str, in_stock: Column, quantity: Column) -> Column:
    """The text without its parentheses, or a label built anew when nothing is left."""
    c, clean = (F.col(x) if isinstance(x, str) else x for x in (c, clean))
    rebuilt = (F.when(in_stock & (quantity > 0),
                      F.concat(F.lit("In stock ("), quantity.cast("string"), F.lit(" available)")))
               .when(in_stock, "In stock")
               .otherwise("Out of stock"))
    return (F.when(c.isNull() | (c == ""), "Unknown")
            .when(clean == "", rebuilt)
            .otherwise(clean))


def with_availability(df: DataFrame, text: str) -> DataFrame:
    """Add availability_raw, available_quantity, in_stock, availability_status and availability.

    Intermediate texts are columns of their own, so each is computed once, and
    none of them needs a lambda.  An in-stock item counts at least one piece,
    any other none.
    """
    in_stock = F.col("availability_status") == "in_stock"
    return (
        df.withColumn("availability_raw", strip_ws(text))
        .withColumn("_lowered", F.lower("availability_raw"))
        .withColumns({"_quantity": first_pattern_int("availability_raw", lowered="_lowered"),
                      "_clean": drop_parenthetical("availability_raw")})
        .withColumn("availability_status", stock_status(text, "_lowered", "_quantity"))
        .withColumns({
            "in_stock": in_stock,
            "available_quantity": F.when(in_stock, F.greatest("_quantity", F.lit(1))).otherwise(0)})
        .withColumn("availability", availability_label(
            text, "_clean", F.col("in_stock"), F.col("available_quantity")))
        # An empty text counts as missing; one of white space only is an empty raw text.
        .withColumn("availability_raw", F.when(F.col(text) != "", F.col("availability_raw")))
        .drop("_lowered", "_quantity", "_clean"))
