"""Number, date and stock texts, rendered from orders, parts and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.functions.availability import STATUS_RULES, first_pattern_int, with_availability
from martkit.functions.numbers import in_range, parse_amount, parse_count, parse_iso_ts
from martkit.functions.text import (
    case_label, drop_parenthetical, first_non_empty, last_token, map_lookup, md5_hex, preview, strip_ws)
from martkit.operators.clean import validate_items
from martkit.operators.stats import validation_stats
from martkit.plans.items import RATING_WORDS
from catalog import query, table

# The rendering is shared by both engines; reading it back is what is compared.
AMOUNT_TEXT = """case o_orderkey % 8
  when 0 then concat('£', cast(o_totalprice as string)) when 1 then concat('-', cast(o_totalprice as string))
  when 2 then concat('EUR 1,', cast(o_totalprice as string)) when 3 then concat(cast(o_orderkey as string), '.')
  when 4 then concat('1.', cast(o_totalprice as string)) when 5 then 'free' when 6 then ''
  else null end"""
COUNT_TEXT = """case o_orderkey % 8
  when 0 then cast(o_custkey as string) when 1 then concat(' ', cast(o_custkey as string), ' ')
  when 2 then concat('-', cast(o_custkey as string)) when 3 then concat(cast(o_custkey as string), '.5')
  when 4 then concat('1_', cast(o_custkey as string)) when 5 then 'many' when 6 then '' else null end"""
DATE_TEXT = """case o_orderkey % 6
  when 0 then concat(substr(cast(o_orderdate as string), 1, 10), 'T10:25:25.541786')
  when 1 then concat(substr(cast(o_orderdate as string), 1, 10), 'T10:25:25Z')
  when 2 then concat(substr(cast(o_orderdate as string), 1, 10), 'T10:25:25+03:30')
  when 3 then substr(cast(o_orderdate as string), 1, 10) when 4 then 'yesterday' else null end"""
RUN_TS = "2026-03-01 00:00:00"

_AMOUNT = "try_cast(regexp_replace({0}, '[^0-9.]', '', 'g') as double)"
_COUNT = """case when {0} is not null then coalesce(case when regexp_matches({0}, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$')
  then try_cast(replace(trim({0}), '_', '') as bigint) end, 0) end"""
_DATE = f"""case when {{0}} is null then null when {{0}} like '%Z' then cast(replace({{0}}, 'Z', '') as timestamp)
  when {{0}} like '%+03:30' then cast(replace({{0}}, '+03:30', '') as timestamp) - interval 210 minute
  when {{0}} like '____-__-__%' then cast({{0}} as timestamp) else timestamp '{RUN_TS}' end"""


def run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


@query("parse_amount", f"""with t as (select o_orderkey, {AMOUNT_TEXT} as x from orders)
select o_orderkey, x, {_AMOUNT.format('x')} as amount from t""")
def amounts(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{AMOUNT_TEXT} as x").withColumn(
        "amount", parse_amount("x"))


@query("to_int_or_zero", f"""with t as (select o_orderkey, {COUNT_TEXT} as x from orders)
select o_orderkey, x, {_COUNT.format('x')} as n from t""")
def counts(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{COUNT_TEXT} as x").withColumn("n", parse_count("x"))


@query("parse_iso_ts", f"""with t as (select o_orderkey, {DATE_TEXT} as x from orders)
select o_orderkey, x, {_DATE.format('x')} as ts from t""")
def dates(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{DATE_TEXT} as x").withColumn(
        "ts", parse_iso_ts("x", run_ts()))


@query("in_range", "select l_orderkey, l_linenumber, l_partkey, l_quantity > 10 and l_quantity < 20 as inside from lineitem")
def inside(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", in_range("l_quantity", 10, 20).alias("inside"))


UNVALIDATED = f"""select concat('u', cast(o_orderkey as string)) as url,
  case when o_orderkey % 9 = 0 then '' else o_orderpriority end as title, {AMOUNT_TEXT} as price,
  {COUNT_TEXT} as rating, cast(o_custkey as string) as reviews_count, {DATE_TEXT} as scraped_at from orders"""
_VALIDATED = f"""raw as ({UNVALIDATED}), v as (
  select url, title, {_AMOUNT.format('price')} as price, {_COUNT.format('rating')} as rating,
    {_COUNT.format('reviews_count')} as reviews_count, {_DATE.format('scraped_at')} as scraped_at,
    case when {_AMOUNT.format('price')} is not null then 1 else 0 end as p,
    case when coalesce(regexp_matches(rating, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$'), false) then 1 else 0 end
      + case when coalesce(regexp_matches(reviews_count, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$'), false) then 1 else 0 end
      as n,
    case when scraped_at is not null then 1 else 0 end as d
  from raw), flagged as (
  select *, concat_ws('|', case when title is null or title = '' then 'title' end,
    case when price is null or price = 0 then 'price' end, case when url = '' then 'url' end) as missing from v)"""


def unvalidated(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("martkit_orders")
    return spark.sql(UNVALIDATED.replace("from orders", "from martkit_orders"))


@query("validate_items", f"""with {_VALIDATED}
select url, title, price, rating, reviews_count, scraped_at, missing from flagged""")
def validated(spark, sf):
    return validate_items(unvalidated(spark, sf), run_ts()).select(
        "url", "title", "price", "rating", "reviews_count", "scraped_at",
        F.array_join("_validation.missing", "|").alias("missing"))


@query("validation_stats", f"""with {_VALIDATED}
select count(*) as total_processed, cast(sum(p) as bigint) as cleaned_prices, cast(sum(n) as bigint) as cleaned_ints,
  cast(sum(d) as bigint) as fixed_dates, count(*) filter (where missing <> '') as validation_errors,
  round(count(*) filter (where missing = '') * cast(100 as double) / count(*), 6) as success_rate from flagged""")
def validation_totals(spark, sf):
    return validation_stats(validate_items(unvalidated(spark, sf), run_ts())).withColumn(
        "success_rate", F.round("success_rate", 6))


# Every form a stock text takes, by line item; the number is the quantity or the order key.
STOCK_TEXT = """case l_orderkey % 16
  when 0 then concat('In stock (', q, ' available)') when 1 then 'In stock' when 2 then 'Out of stock'
  when 3 then concat('Out of stock (', q, ' available)') when 4 then concat('(', q, ' available)')
  when 5 then '(available)' when 6 then 'not available' when 7 then concat(k, ' available')
  when 8 then concat(q, ' left') when 9 then 'Pre-order' when 10 then concat('2024 model, ', q, ' left')
  when 11 then 'Unavailable' when 12 then concat('1200 in stock, ', q, ' units')
  when 13 then concat('  In   stock :  ', q, '  ') when 14 then '   ' else null end"""
_KEYED = """select l_orderkey, l_linenumber, l_partkey, cast(cast(l_quantity as int) as string) as q,
  cast(l_orderkey as string) as k from {0}"""
# The quantity patterns in order of precedence, as the SQL side writes them.
_PATTERNS = [
    r"\(([0-9]+)\s+available\)", r"available\s*[:\-]?\s*([0-9]+)", r"([0-9]+)\s+available",
    r"\(([0-9]+)\s*in\s*stock\)", r"in\s+stock\s*[:\-]?\s*([0-9]+)", r"([0-9]+)\s+in\s+stock",
    r"stock\s*[:\-]?\s*([0-9]+)", r"\b([0-9]+)\s*(?:pcs?|items?|units?)\b", r"\b([0-9]+)\s+left\b",
    r"\b([0-9]+)\s+remaining\b", r"\b([0-9]+)\b"]


def _one(p: str) -> str:
    n = f"try_cast(regexp_extract(s, '{p}', 1, 'i') as bigint)"
    return f"case when {n} > 0 and {n} < 1000 then {n} end"


STOCKED = f"""keyed as ({_KEYED.format('lineitem')}), raw as (select *, {STOCK_TEXT} as x from keyed),
stripped as (select *, regexp_replace(x, '^\\s+|\\s+$', '', 'g') as s from raw),
found as (select *, cast(case when s is null then null else coalesce({", ".join(map(_one, _PATTERNS))}, 0) end as int)
  as n from stripped),
judged as (select *, case when x is null or x = '' then 'unknown'
  when lower(s) like '%out of stock%' or lower(s) like '%not available%' or lower(s) like '%sold out%'
    then 'out_of_stock'
  when lower(s) like '%in stock%' or lower(s) like '%available%' or n > 0 then 'in_stock'
  else 'out_of_stock' end as status,
  trim(regexp_replace(regexp_replace(x, '\\([^)]*\\)', '', 'g'), '\\s+', ' ', 'g')) as clean from found),
counted as (select *, case when status = 'in_stock' then greatest(n, 1) else 0 end as qty from judged),
labelled as (select *, case when x is null or x = '' then 'Unknown' when clean <> '' then clean
  when status = 'in_stock' then concat('In stock (', cast(qty as varchar), ' available)')
  else 'Out of stock' end as label from counted)"""


def stock_texts(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "cast(cast(l_quantity as int) as string) as q",
        "cast(l_orderkey as string) as k")
    return lines.selectExpr("l_orderkey", "l_linenumber", "l_partkey", f"{STOCK_TEXT} as x")


KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("strip_and_drop_parens", f"with {STOCKED} select {', '.join(KEYS)}, s as stripped, clean from labelled")
def strip_and_drop(spark, sf):
    return stock_texts(spark, sf).select(
        *KEYS, strip_ws("x").alias("stripped"), drop_parenthetical("x").alias("clean"))


@query("pattern_quantity", f"with {STOCKED} select {', '.join(KEYS)}, n as quantity from labelled")
def pattern_quantity(spark, sf):
    return stock_texts(spark, sf).select(*KEYS, first_pattern_int(strip_ws("x")).alias("quantity"))


@query("availability_class", f"""with {STOCKED}
select {', '.join(KEYS)}, status = 'in_stock' as in_stock, status as availability_status, qty as available_quantity
from labelled""")
def availability_class(spark, sf):
    return with_availability(stock_texts(spark, sf), "x").select(
        *KEYS, "in_stock", "availability_status", "available_quantity")


@query("availability_label", f"""with {STOCKED}
select {', '.join(KEYS)}, case when x <> '' then s end as availability_raw, label as availability,
  case when lower(label) like '%in stock%' then 'in_stock' when lower(label) like '%out of stock%' then 'out_of_stock'
  else 'unknown' end as mart_status from labelled""")
def availability_text(spark, sf):
    return with_availability(stock_texts(spark, sf), "x").select(
        *KEYS, "availability_raw", "availability",
        case_label("availability", STATUS_RULES, "unknown").alias("mart_status"))


@query("first_non_empty", f"""with keyed as ({_KEYED.format('lineitem')}), raw as (select *, {STOCK_TEXT} as x from keyed)
select {', '.join(KEYS)}, coalesce(nullif(x, ''), nullif(case when l_linenumber > 3 then '' else q end, ''), k) as stock
from raw""")
def fallback_text(spark, sf):
    base = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "cast(cast(l_quantity as int) as string) as q",
        "cast(l_orderkey as string) as k")
    second = F.when(F.col("l_linenumber") > 3, "").otherwise(F.col("q"))
    return base.selectExpr(*KEYS, "q", "k", f"{STOCK_TEXT} as x").select(
        *KEYS, first_non_empty("x", second, "k").alias("stock"))


_RATING = """case p_size % 9 when 0 then 'star-rating Zero' when 1 then 'star-rating One' when 2 then 'star-rating  Two'
  when 3 then 'Three star-rating Three' when 4 then ' star-rating Four ' when 5 then 'Five' when 6 then 'star-rating Six'
  when 7 then 'star-rating' else null end"""


@query("rating_word_lookup", f"""with t as (select p_partkey, trim({_RATING}) as c from part),
w as (select p_partkey, list_last(string_split_regex(c, '\\s+')) as rating_text from t)
select p_partkey, rating_text, case when rating_text is not null then case rating_text when 'One' then 1 when 'Two' then 2
  when 'Three' then 3 when 'Four' then 4 when 'Five' then 5 else 0 end end as rating from w""")
def rating_words(spark, sf):
    parts = table(spark, sf, "part").selectExpr("p_partkey", f"{_RATING} as c")
    return parts.select("p_partkey", last_token("c").alias("rating_text")).withColumn(
        "rating", map_lookup("rating_text", RATING_WORDS, 0))


@query("md5_and_preview", """select doc_id, md5(text) as hash, substr(coalesce(nullif(text, ''), 'no text'), 1, 50) as head,
  lower(text) as lowered from documents""")
def hashes(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", md5_hex("text").alias("hash"), preview("text", 50, "no text").alias("head"),
        F.lower("text").alias("lowered"))
