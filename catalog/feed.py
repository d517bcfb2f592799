"""An item feed derived from line items and parts.

The given tables hold no scrape feed and no NULL, so every column of the feed is
an expression over a joined row, with gaps and odd values at fixed positions.
No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martkit.functions.numbers import completeness_score
from catalog import table

# The same expression text serves both engines: it is the input of the queries,
# not their result.
COLUMNS = {
    "url": "concat('https://shop.example/item/', cast(l_orderkey as string), '/', cast(l_linenumber as string),"
           " '/', cast(l_partkey as string))",
    "scraped_at": "l_shipdate",
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "title": "case when p_partkey % 10 = 0 then null else concat('  ', p_name, ' ') end",
    "price": "case when l_linenumber = 7 then null else l_extendedprice end",
    "availability": "case cast(l_quantity as int) % 5"
                    " when 0 then concat('In stock (', cast(cast(l_quantity as int) as string), ' available)')"
                    " when 1 then 'In stock' when 2 then 'Out of stock' when 3 then 'Pre-order' else null end",
    "available_quantity": "case when l_linenumber = 6 then null else cast(l_quantity as int) end",
    "description": "case when p_partkey % 3 = 0 then null else concat(p_brand, ' ', p_name) end",
    "upc": "case when l_orderkey % 997 = 0 then null else cast(l_partkey as string) end",
    "product_type": "p_brand",
    "reviews_count": "case when l_orderkey % 5 = 0 then null else l_linenumber end",
    "rating": "nullif(p_size % 8, 7)",
    "category": "case when p_partkey % 13 = 0 then null when p_partkey % 17 = 0 then '' else p_type end",
    "image_url": "concat('https://shop.example/media/', cast(p_partkey as string), '.jpg')",
}
SCORED = ["title", "price", "upc", "category", "product_type", "rating"]
# One of six fields may be missing, as one of eleven may at the usual minimum.
MINIMUM = 80.0
ORDER = ["scraped_at", "l_orderkey", "l_linenumber", "l_partkey"]


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    feed = joined.selectExpr(*[f"{e} as {n}" for n, e in COLUMNS.items()])
    return feed.withColumn("data_quality_score", F.when(
        F.col("l_orderkey") % 101 != 0, completeness_score(feed, SCORED)))


_FILLED = " + ".join(
    f"(case when {c} is null or {c} = {empty} then 0 else 1 end)"
    for c, empty in [("title", "''"), ("price", "0"), ("upc", "''"), ("category", "''"),
                     ("product_type", "''"), ("rating", "0")])

RAW = f"""feed as (
  select {", ".join(f"{e} as {n}" for n, e in COLUMNS.items())}
  from lineitem join part on l_partkey = p_partkey
), raw as (
  select *, case when l_orderkey % 101 <> 0 then round(cast({_FILLED} as double) / 6 * 100, 2) end
    as data_quality_score
  from feed
)"""
CLEAN = f"""{RAW}, cleaned as (
  select * replace (
    trim(title, ' ') as title, trim(category, ' ') as category, trim(product_type, ' ') as product_type,
    coalesce(price, 0) as price, coalesce(reviews_count, 0) as reviews_count, coalesce(rating, 0) as rating)
  from raw
)"""
DEDUP = f"""{CLEAN}, kept as (
  select * exclude (rn) from (
    select *, row_number() over (partition by upc order by scraped_at nulls first, l_orderkey, l_linenumber,
      l_partkey) as rn from cleaned)
  where rn = 1
)"""
DIMS = f"""{DEDUP}, categories as (
  select category, dense_rank() over (order by md5(category)) as category_id
  from (select distinct category from kept where category is not null and category <> '')
), product_types as (
  select product_type, dense_rank() over (order by md5(product_type)) as product_type_id
  from (select distinct product_type from kept where product_type is not null and product_type <> '')
), ratings(rating_id, rating_value) as (values (1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5))"""
IN_STOCK = "lower(coalesce(availability, '')) like '%in stock%'"
STATUS = """case when lower(availability) like '%in stock%' then 'in_stock'
  when lower(availability) like '%out of stock%' then 'out_of_stock' else 'unknown' end"""
FACT = f"""{DIMS}, fact as (
  select upc as book_id, title, description, price, {IN_STOCK} as in_stock,
    coalesce(available_quantity, 0) as available_quantity, reviews_count,
    rating_id, category_id, product_type_id, image_url, url, scraped_at
  from kept
  left join categories using (category)
  left join product_types using (product_type)
  left join ratings on rating = rating_value
  where data_quality_score >= {MINIMUM}
)"""
