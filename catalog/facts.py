"""Dimensions, surrogate keys, lookups and the fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.operators.clean import clean
from martkit.operators.keys import build_dimension, distinct_values, surrogate_keys
from martkit.operators.lookup import DimRef, fk_orphans, lookup_dimensions, measured, orphan_rows
from martkit.operators.stats import row_count
from martkit.plans.mart import rating_ref, transform
from martkit.session import materialize
from martkit.sources.readers import default_ratings
from catalog import query, table
from catalog.feed import CLEAN, DEDUP, DIMS, FACT, MINIMUM, ORDER, RAW, STATUS, raw_items
from catalog.items import kept_items


@query("distinct_dimension", f"""with {DEDUP}
select distinct category from kept where category is not null and category <> ''""")
def distinct_dimension(spark, sf):
    return distinct_values(kept_items(spark, sf), "category")


@query("dimension_cardinality", f"""with {DEDUP}
select 'category' as dimension, count(distinct nullif(category, '')) as members from kept
union all select 'product_type', count(distinct nullif(product_type, '')) from kept""")
def dimension_cardinality(spark, sf):
    kept = materialize(kept_items(spark, sf).select("category", "product_type"), "kept")
    sizes = [row_count(distinct_values(kept, c), "members").select(F.lit(c).alias("dimension"), "members")
             for c in ("category", "product_type")]
    return sizes[0].unionByName(sizes[1])


@query("surrogate_keys", f"with {DIMS} select category_id, category from categories")
def category_keys(spark, sf):
    return build_dimension(kept_items(spark, sf), "category", "category_id")


@query("surrogate_keys_product_type", f"with {DIMS} select product_type_id, product_type from product_types")
def product_type_keys(spark, sf):
    return build_dimension(kept_items(spark, sf), "product_type", "product_type_id")


@query("surrogate_keys_large", """select dense_rank() over (order by md5(text)) as text_id, text
from (select distinct text from documents where text is not null and text <> '')""")
def text_keys(spark, sf):
    return build_dimension(table(spark, sf, "documents"), "text", "text_id")


@query("surrogate_keys_urls", f"""with {RAW}
select dense_rank() over (order by md5(url)) as url_id, url from (select distinct url from raw)""")
def url_keys(spark, sf):
    return surrogate_keys(raw_items(spark, sf).select("url").distinct(), "url", "url_id")


@query("lookup_one_dim", f"""with {DIMS}
select url, category, category_id from kept left join categories using (category)""")
def lookup_one_dim(spark, sf):
    kept = materialize(kept_items(spark, sf).select("url", "category"), "kept")
    dim = build_dimension(kept, "category", "category_id")
    return lookup_dimensions(kept, [DimRef(dim, "category", "category", "category_id")])


@query("lookup_three_dims", f"""with {DIMS}
select url, rating_id, category_id, product_type_id from kept left join categories using (category)
left join product_types using (product_type) left join ratings on rating = rating_value""")
def lookup_three_dims(spark, sf):
    kept = materialize(kept_items(spark, sf).select("url", "category", "product_type", "rating"), "kept")
    dims = [
        DimRef(build_dimension(kept, "category", "category_id"), "category", "category", "category_id"),
        DimRef(build_dimension(kept, "product_type", "product_type_id"),
               "product_type", "product_type", "product_type_id"),
        measured(rating_ref(default_ratings(spark))),
    ]
    return lookup_dimensions(kept, dims).select("url", "rating_id", "category_id", "product_type_id")


@query("rating_lookup_out_of_range", f"""with {CLEAN},
ratings(rating_id, rating_value) as (values (1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5))
select url, rating, rating_id from cleaned left join ratings on rating = rating_value""")
def rating_lookup(spark, sf):
    items = clean(raw_items(spark, sf)).select("url", "rating")
    return lookup_dimensions(items, [measured(rating_ref(default_ratings(spark)))])


@query("lookup_large_dim", """with texts as (
  select dense_rank() over (order by md5(text)) as text_id, text
  from (select distinct text from documents where text is not null and text <> ''))
select doc_id, text_id from documents left join texts using (text)""")
def lookup_large_dim(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    dim = build_dimension(docs, "text", "text_id")
    return lookup_dimensions(docs, [DimRef(dim, "text", "text", "text_id")]).select("doc_id", "text_id")


@query("lookup_measured_dim", """with texts as (
  select dense_rank() over (order by md5(text)) as text_id, text
  from (select distinct text from documents where text is not null and text <> ''))
select doc_id, text_id from documents left join texts using (text)""")
def lookup_measured_dim(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    dim = materialize(build_dimension(docs, "text", "text_id"), "texts")
    return lookup_dimensions(docs, [measured(DimRef(dim, "text", "text", "text_id"))]).select("doc_id", "text_id")


@query("fact_projection", f"with {FACT} select * from fact")
def fact_projection(spark, sf):
    return transform(raw_items(spark, sf), ORDER, minimum=MINIMUM).fact


@query("quality_reject_flags", f"""with {DEDUP}
select upc, url, lower(coalesce(availability, '')) like '%in stock%' as in_stock,
  coalesce(available_quantity, 0) as available_quantity, {STATUS} as availability_status, data_quality_score
from kept where data_quality_score < {MINIMUM}""")
def quality_reject_flags(spark, sf):
    return transform(raw_items(spark, sf), ORDER, minimum=MINIMUM).rejects.select(
        "upc", "url", "in_stock", "available_quantity", "availability_status", "data_quality_score")


@query("fact_by_category", f"""with {FACT}
select category, count(*) as items, count(*) filter (where in_stock) as in_stock_items,
  cast(sum(available_quantity) as bigint) as pieces
from fact left join categories using (category_id) group by category""")
def fact_by_category(spark, sf):
    mart = transform(raw_items(spark, sf), ORDER, minimum=MINIMUM)
    # The ids are grouped first: one row per category meets the dimension.
    per_id = mart.fact.groupBy("category_id").agg(
        F.count("*").alias("items"), F.count_if("in_stock").alias("in_stock_items"),
        F.sum("available_quantity").alias("pieces"))
    return per_id.join(mart.dims["dim_categories"], "category_id", "left").select(
        "category", "items", "in_stock_items", "pieces")


@query("fk_orphans", """select o_orderkey, count(*) as row_count from orders
where o_orderkey not in (select l_orderkey from lineitem) group by o_orderkey""")
def orphan_keys(spark, sf):
    return fk_orphans(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


@query("fk_orphan_rows", """select doc_id, lang, source from documents
where doc_id not in (select doc_id from labels)""")
def orphan_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return orphan_rows(docs, table(spark, sf, "labels"), "doc_id", "doc_id")
