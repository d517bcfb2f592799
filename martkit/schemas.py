"""Declared schemas of the raw item table and of the star schema.

A column's upper length sits in its field metadata (``max_length``), so the
schema object is the single place that says what a table accepts.  Keys, ranges
and references live beside it in ``TableRules``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def text(name: str, max_length: int | None = None, nullable: bool = True) -> T.StructField:
    meta = {} if max_length is None else {"max_length": max_length}
    return T.StructField(name, T.StringType(), nullable, meta)


def col(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


# --- fixed values: column names, types and lengths of the stored tables -------
RAW_ITEM = T.StructType([
    text("url", 500, nullable=False),
    col("scraped_at", T.TimestampNTZType()),
    text("title", 500),
    col("price", T.DoubleType()),
    text("price_raw", 50),
    text("availability", 100),
    text("availability_raw"),
    col("available_quantity", T.IntegerType()),
    col("in_stock", T.BooleanType()),
    text("availability_status", 50),
    text("description"),
    text("upc", 50),
    text("product_type", 100),
    col("price_excl_tax", T.DoubleType()),
    text("price_excl_tax_raw", 50),
    col("price_incl_tax", T.DoubleType()),
    text("price_incl_tax_raw", 50),
    col("tax", T.DoubleType()),
    text("tax_raw", 50),
    col("reviews_count", T.IntegerType()),
    col("rating", T.IntegerType()),
    text("rating_text", 20),
    text("category", 200),
    text("image_url", 500),
    text("image_filename", 500),
    col("data_quality_score", T.DoubleType()),
])

DIM_RATINGS = T.StructType([
    col("rating_id", T.IntegerType(), nullable=False),
    col("rating_value", T.IntegerType(), nullable=False),
    text("rating_name", 10, nullable=False),
    text("rating_description", 100),
    col("created_at", T.TimestampType()),
])

DIM_CATEGORIES = T.StructType([
    col("category_id", T.IntegerType(), nullable=False),
    text("category", 200, nullable=False),
    col("created_at", T.TimestampType()),
])

DIM_PRODUCT_TYPES = T.StructType([
    col("product_type_id", T.IntegerType(), nullable=False),
    text("product_type", 200, nullable=False),
    col("created_at", T.TimestampType()),
])

FACT = T.StructType([
    text("book_id", 50, nullable=False),
    text("title", 500, nullable=False),
    text("description"),
    col("price", T.DecimalType(10, 2)),
    col("in_stock", T.BooleanType()),
    col("available_quantity", T.IntegerType()),
    col("reviews_count", T.IntegerType()),
    col("rating_id", T.IntegerType()),
    col("category_id", T.IntegerType()),
    col("product_type_id", T.IntegerType()),
    text("image_url", 500),
    text("url", 500),
    col("scraped_at", T.TimestampNTZType()),
    col("processed_at", T.TimestampType()),
])

RATING_ROWS = [
    (1, 0, "Zero", "Без рейтинга"),
    (2, 1, "One", "Очень плохо"),
    (3, 2, "Two", "Плохо"),
    (4, 3, "Three", "Средне"),
    (5, 4, "Four", "Хорошо"),
    (6, 5, "Five", "Отлично"),
]

MIN_QUALITY = 85.0
INSERT_DEFAULTS = {"available_quantity": 0, "in_stock": False}
# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    ref_column: str


@dataclass(frozen=True)
class TableRules:
    """What a stored table promises besides its column types."""

    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def lengths(self) -> dict[str, int]:
        return {f.name: f.metadata["max_length"] for f in self.schema if "max_length" in f.metadata}

    @property
    def decimals(self) -> dict[str, tuple[int, int]]:
        return {
            f.name: (f.dataType.precision, f.dataType.scale)
            for f in self.schema
            if isinstance(f.dataType, T.DecimalType)
        }


RAW_RULES = TableRules(RAW_ITEM, unique=("url",))

# In load order: what a fact refers to comes before the fact.
MART_RULES: dict[str, TableRules] = {
    "dim_ratings": TableRules(
        DIM_RATINGS, ("rating_id",), ("rating_value",), {"rating_value": (0, 5)}),
    "dim_categories": TableRules(DIM_CATEGORIES, ("category_id",)),
    "dim_product_types": TableRules(
        DIM_PRODUCT_TYPES, ("product_type_id",), ("product_type",)),
    "fact_books": TableRules(
        FACT, ("book_id",),
        foreign_keys=(
            ForeignKey("rating_id", "dim_ratings", "rating_id"),
            ForeignKey("category_id", "dim_categories", "category_id"),
            ForeignKey("product_type_id", "dim_product_types", "product_type_id"),
        )),
}

RUN_METRICS = T.StructType([
    text("etl_name"),
    col("success", T.BooleanType()),
    text("start_time"),
    text("end_time"),
    col("duration_seconds", T.DoubleType()),
    col("statistics", T.StructType([
        text("etl_run_id"),
        col("total_duration_seconds", T.DoubleType()),
        col("extraction_records", T.LongType()),
        col("transformation_books", T.LongType()),
        col("quality", T.LongType()),
        col("tables_loaded", T.IntegerType()),
        text("spark_application_id"),
        text("status"),
        text("error"),
    ])),
])
