"""Row-wise cleaning, gating and deduplication of the feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.functions.availability import STATUS_RULES
from martkit.functions.numbers import completeness_score
from martkit.functions.text import case_label, contains_ci, map_lookup
from martkit.operators.clean import clean, non_blank, null_fields, required_fields
from martkit.operators.dedup import dedup_keep_first, dedup_stats, later_duplicates, latest_per_key
from martkit.operators.quality import (
    completeness_rate, null_profile, quality_gate, quality_rejects, quality_report, reject_ids, reject_summary, worst_k)
from martkit.plans.mart import PROFILED, profile_raw
from catalog import query, table
from catalog.feed import CLEAN, DEDUP, IN_STOCK, MINIMUM, ORDER, RAW, SCORED, STATUS, raw_items


def kept_items(spark, sf):
    return dedup_keep_first(clean(raw_items(spark, sf)), "upc", ORDER)


@query("trim_fill_clean", f"""with {CLEAN}
select url, upc, title, category, product_type, price, reviews_count, rating from cleaned""")
def trim_fill_clean(spark, sf):
    return clean(raw_items(spark, sf)).select(
        "url", "upc", "title", "category", "product_type", "price", "reviews_count", "rating")


@query("non_blank_filter", f"""with {CLEAN}
select url, category from cleaned where category is not null and category <> ''""")
def non_blank_filter(spark, sf):
    return non_blank(clean(raw_items(spark, sf)), "category").select("url", "category")


@query("completeness_scores", f"""with {RAW} select url, data_quality_score as score from raw
where l_orderkey % 101 <> 0 union all
select url, round(cast((case when title is null or title = '' then 0 else 1 end)
  + (case when price is null or price = 0 then 0 else 1 end) + (case when upc is null or upc = '' then 0 else 1 end)
  + (case when category is null or category = '' then 0 else 1 end)
  + (case when product_type is null or product_type = '' then 0 else 1 end)
  + (case when rating is null or rating = 0 then 0 else 1 end) as double) / 6 * 100, 2)
from raw where l_orderkey % 101 = 0""")
def completeness_scores(spark, sf):
    raw = raw_items(spark, sf)
    return raw.select("url", completeness_score(raw, SCORED).alias("score"))


@query("contains_flag", f"with {RAW} select url, {IN_STOCK} as in_stock from raw")
def contains_flag(spark, sf):
    return raw_items(spark, sf).select("url", contains_ci("availability", "in stock").alias("in_stock"))


@query("status_label", f"with {RAW} select url, {STATUS} as availability_status from raw")
def status_label(spark, sf):
    return raw_items(spark, sf).select(
        "url", case_label("availability", STATUS_RULES, "unknown").alias("availability_status"))


@query("required_field_flags", f"""with {CLEAN}
select url, concat_ws('|', case when title is null or title = '' then 'title' end,
  case when price is null or price = 0 then 'price' end,
  case when url is null or url = '' then 'url' end) as missing from cleaned""")
def required_field_flags(spark, sf):
    df = clean(raw_items(spark, sf))
    return df.select("url", F.array_join(required_fields(df), "|").alias("missing"))


@query("null_field_list", f"""with {RAW}
select url, concat_ws('|', case when title is null then 'title' end, case when price is null then 'price' end,
  case when upc is null then 'upc' end, case when category is null then 'category' end,
  case when rating is null then 'rating' end, case when data_quality_score is null then 'data_quality_score' end)
  as null_names from raw""")
def null_field_list(spark, sf):
    names = ["title", "price", "upc", "category", "rating", "data_quality_score"]
    return raw_items(spark, sf).select("url", F.array_join(null_fields(names), "|").alias("null_names"))


@query("rating_names", f"""with {RAW}
select url, case when rating is not null then case rating when 0 then 'Zero' when 1 then 'One' when 2 then 'Two'
  when 3 then 'Three' when 4 then 'Four' when 5 then 'Five' else 'none' end end as rating_name from raw""")
def rating_names(spark, sf):
    words = {0: "Zero", 1: "One", 2: "Two", 3: "Three", 4: "Four", 5: "Five"}
    return raw_items(spark, sf).select("url", map_lookup("rating", words, "none").alias("rating_name"))


@query("null_profile_raw", f"""with {RAW} select {", ".join(
    f"count(*) filter (where {c} is null) as null_{c}" for c in PROFILED)} from raw""")
def null_profile_raw(spark, sf):
    return null_profile(raw_items(spark, sf), PROFILED)


@query("null_profile", f"""with {CLEAN} select count(*) as records, {", ".join(
    f"count(*) filter (where {c} is null) as null_{c}" for c in PROFILED)} from cleaned""")
def null_profile_clean(spark, sf):
    return profile_raw(raw_items(spark, sf))


@query("completeness_grade", f"""with {RAW}, r as (
  select round((count(title) + count(price) + count(upc) + count(category) + count(product_type) + count(rating))
    * cast(100 as double) / (count(*) * 6), 2) as completeness_rate from raw)
select completeness_rate, case when completeness_rate >= 90 then 'ok' when completeness_rate >= 70 then 'warning'
  else 'critical' end as grade from r""")
def completeness_grade(spark, sf):
    return completeness_rate(raw_items(spark, sf), SCORED)


@query("dedup_keep_first", f"""with {DEDUP}
select upc, url, scraped_at, title, category, price, data_quality_score from kept""")
def dedup_items(spark, sf):
    return kept_items(spark, sf).select(
        "upc", "url", "scraped_at", "title", "category", "price", "data_quality_score")


@query("dedup_stats", f"""with {RAW}, n as (select count(*) as b, count(distinct upc)
  + max(case when upc is null then 1 else 0 end) as a from raw)
select b as records_before, cast(a as bigint) as records_after, cast(b - a as bigint) as duplicates_removed from n""")
def dedup_counts(spark, sf):
    return dedup_stats(raw_items(spark, sf), "upc")


@query("dedup_removed", f"""with {RAW}
select upc, url from (select *, row_number() over (partition by upc order by scraped_at nulls first, l_orderkey,
  l_linenumber, l_partkey) as rn from raw) where rn > 1""")
def dedup_removed(spark, sf):
    return later_duplicates(raw_items(spark, sf), ["upc"], ORDER).select("upc", "url")


@query("dedup_events", """select event_id, user_id, ts from (
  select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn = 1""")
def dedup_events(spark, sf):
    return dedup_keep_first(table(spark, sf, "events"), "user_id", ["ts", "event_id"]).select(
        "event_id", "user_id", "ts")


@query("dedup_documents", """select doc_id, lang, source, text from (
  select *, row_number() over (partition by text order by doc_id) as rn from documents) where rn = 1""")
def dedup_documents(spark, sf):
    return dedup_keep_first(table(spark, sf, "documents"), "text", ["doc_id"]).select(
        "doc_id", "lang", "source", "text")


@query("latest_per_key", """select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def latest_rows(spark, sf):
    return latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value")


@query("quality_accept", f"""with {DEDUP}
select url, upc, data_quality_score from kept where data_quality_score >= {MINIMUM}""")
def quality_accept(spark, sf):
    return quality_gate(kept_items(spark, sf), minimum=MINIMUM).select("url", "upc", "data_quality_score")


@query("quality_reject", f"""with {DEDUP}
select url, upc, data_quality_score from kept where data_quality_score < {MINIMUM}""")
def quality_reject(spark, sf):
    return quality_rejects(kept_items(spark, sf), minimum=MINIMUM).select("url", "upc", "data_quality_score")


@query("quality_split_counts", f"""with {DEDUP}
select count(*) as kept, count(*) filter (where data_quality_score >= {MINIMUM}) as accepted,
  count(*) filter (where data_quality_score < {MINIMUM}) as rejected,
  count(*) filter (where data_quality_score is null) as unscored from kept""")
def quality_split_counts(spark, sf):
    score = F.col("data_quality_score")
    return kept_items(spark, sf).agg(
        F.count("*").alias("kept"), F.count_if(score >= MINIMUM).alias("accepted"),
        F.count_if(score < MINIMUM).alias("rejected"), F.count_if(score.isNull()).alias("unscored"))


@query("reject_summary", f"""with {DEDUP}
select count(*) as low_quality_count, min(data_quality_score) as min_score, max(data_quality_score) as max_score
from kept where data_quality_score < {MINIMUM}""")
def reject_totals(spark, sf):
    return reject_summary(quality_rejects(kept_items(spark, sf), minimum=MINIMUM))


@query("reject_ids", f"with {DEDUP} select upc from kept where data_quality_score < {MINIMUM}")
def rejected_ids(spark, sf):
    return reject_ids(quality_rejects(kept_items(spark, sf), minimum=MINIMUM), "upc")


@query("quality_report", f"""with {DEDUP}
select count(*) as low_quality_count, min(data_quality_score) as min_score, max(data_quality_score) as max_score,
  greatest(count(*) - 10, 0) as not_listed from kept where data_quality_score < {MINIMUM}""")
def report_totals(spark, sf):
    return quality_report(quality_rejects(kept_items(spark, sf), minimum=MINIMUM), "upc")[0]


@query("worst_10", f"""with {DEDUP}
select upc, substr(coalesce(nullif(title, ''), 'Без названия'), 1, 50) as title_preview, data_quality_score,
  printf('%.1f%%', data_quality_score) as score_text
from kept where data_quality_score < {MINIMUM}
order by data_quality_score, upc nulls first, title nulls first limit 10""")
def worst_10(spark, sf):
    return worst_k(quality_rejects(kept_items(spark, sf), minimum=MINIMUM), "upc")
