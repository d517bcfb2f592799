"""Cleaning, validation and schema enforcement of raw rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from martkit.functions.numbers import is_filled, parse_iso_ts, to_double_lenient, to_int_or_zero
from martkit.schemas import INSERT_DEFAULTS, TableRules

# --- fixed values: the fields each cleaning step applies to -------------------
TRIMMED = ["title", "category", "product_type"]
FILLED = {"price": 0.0, "reviews_count": 0, "rating": 0}
AMOUNT_FIELDS = ["price", "price_excl_tax", "price_incl_tax", "tax"]
COUNT_FIELDS = ["reviews_count", "rating", "available_quantity"]
REQUIRED_FIELDS = ["title", "price", "url"]
# --- end of fixed values ------------------------------------------------------


def trim_columns(df: DataFrame, names: Iterable[str] = TRIMMED) -> DataFrame:
    """Strip ASCII spaces (not tabs or other white space) at both ends."""
    return df.withColumns({n: F.trim(n) for n in names})


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL, and only NULL, by a default of the column's own type."""
    return df.withColumns({
        n: F.coalesce(F.col(n), (v if isinstance(v, Column) else F.lit(v)).cast(df.schema[n].dataType))
        for n, v in defaults.items()})


def non_blank(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull() & (F.col(name) != ""))


def stamp(df: DataFrame, name: str, at: Column | None = None) -> DataFrame:
    """Add a timestamp; pass a literal so that every table of a run carries the same one."""
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def clean(df: DataFrame) -> DataFrame:
    """Trim the text keys and fill the numeric gaps, in one projection each."""
    return fill_nulls(trim_columns(df), FILLED)


def insert_defaults(at: Column) -> dict[str, object]:
    """What a newly stored item gets where nothing was sent; ``at`` is the run's time."""
    return {"scraped_at": at, **INSERT_DEFAULTS}


def apply_insert_defaults(df: DataFrame, defaults: Mapping[str, object] = INSERT_DEFAULTS) -> DataFrame:
    return fill_nulls(df, {n: v for n, v in defaults.items() if n in df.columns})


def _names_where(conditions: Mapping[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def required_fields(df: DataFrame, names: Iterable[str] = REQUIRED_FIELDS) -> Column:
    """Array of the fields that are NULL, empty, zero or false."""
    return _names_where({n: ~is_filled(df, n) for n in names})


def null_fields(names: Iterable[str]) -> Column:
    """Array of the fields that are NULL."""
    return _names_where({n: F.col(n).isNull() for n in names})


def validate_items(df: DataFrame, fallback_ts: Column) -> DataFrame:
    """Amounts, counts and timestamps as typed columns, plus one flag struct per row.

    ``_validation`` holds what the run statistics add up: how many amounts and
    counts were read from text, whether the timestamp was text, and the missing
    required fields.  Everything is one projection over the input.
    """
    present = [f.name for f in df.schema]
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema}
    amounts = [n for n in AMOUNT_FIELDS if n in present]
    counts = [n for n in COUNT_FIELDS if n in present]

    typed = {n: to_double_lenient(df, n) for n in amounts}
    typed |= {n: to_int_or_zero(df, n) for n in counts}
    n_amounts = sum((typed[n].isNotNull().cast("int") for n in amounts if is_text[n]), F.lit(0))
    n_counts = sum((_reads_as_count(n).cast("int") for n in counts if is_text[n]), F.lit(0))
    dated = is_text.get("scraped_at", False)
    if dated:
        typed["scraped_at"] = parse_iso_ts("scraped_at", fallback_ts)
        n_dates = F.col("scraped_at").isNotNull().cast("int")
    else:
        n_dates = F.lit(0)

    out = df.select(
        *[typed.get(n, F.col(n)).alias(n) for n in present],
        n_amounts.alias("_amounts"), n_counts.alias("_counts"), n_dates.alias("_dates"))
    flags = F.struct(
        F.col("_amounts").alias("cleaned_prices"), F.col("_counts").alias("cleaned_ints"),
        F.col("_dates").alias("fixed_dates"),
        required_fields(out, [n for n in REQUIRED_FIELDS if n in present]).alias("missing"))
    return out.withColumn("_validation", flags).drop("_amounts", "_counts", "_dates")


def _reads_as_count(name: str) -> Column:
    """Whether a text is a whole number, as opposed to having been replaced by 0."""
    return F.coalesce(F.col(name).rlike(r"(?U)^[\s\x1c-\x1f]*[+-]?[0-9]+(_[0-9]+)*[\s\x1c-\x1f]*$"),
                      F.lit(False))


def loses_value(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a value that is there cannot be held by the wanted type.

    Numbers are compared with the bound of a NUMERIC type after rounding, which
    is what the cast does; letting the cast fail would cost an exception per row.
    """
    if isinstance(want, T.DecimalType) and isinstance(have, T.NumericType):
        limit = 10 ** (want.precision - want.scale)
        return F.coalesce(F.abs(F.round(c, want.scale)) >= limit, F.lit(False))
    return c.isNotNull() & c.try_cast(want).isNull()


def storage_problems(df: DataFrame, rules: TableRules) -> list[Column]:
    """One text per reason a row does not fit the declared table, NULL where it does.

    Covers NOT NULL, lengths, ranges and casts that lose the value.
    """
    checks: list[Column] = []
    limits, not_null = rules.lengths, set(rules.not_null)
    for f in rules.schema:
        if f.name not in df.columns:
            if f.name in not_null:
                checks.append(F.lit(f"{f.name}: is null"))
            continue
        c, have = F.col(f.name), df.schema[f.name].dataType
        if f.name in not_null:
            checks.append(F.when(c.isNull(), f"{f.name}: is null"))
        if f.name in limits:
            checks.append(F.when(F.length(c) > limits[f.name], f"{f.name}: longer than {limits[f.name]}"))
        if have != f.dataType:
            checks.append(F.when(loses_value(c, have, f.dataType), f"{f.name}: not a {f.dataType.simpleString()}"))
        if f.name in rules.ranges:
            checks.append(F.when(~c.between(*rules.ranges[f.name]), f"{f.name}: out of range"))
    return checks


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns in the declared types; absent ones are NULL.

    Values that do not fit become NULL: run ``quarantine`` first to keep such rows apart.
    """
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema])


def quarantine(df: DataFrame, problems: Iterable[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows without problems, and the others with their reasons joined in ``reject_reason``."""
    tagged = df.withColumn("reject_reason", F.concat_ws("; ", *problems))
    storable = tagged.where(F.col("reject_reason") == "").drop("reject_reason")
    return storable, tagged.where(F.col("reject_reason") != "")
