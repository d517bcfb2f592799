"""Extraction from the given web pages and from item pages rendered out of parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.functions import html as H
from martkit.functions.urls import basename, resolve_url, short_key
from martkit.plans.items import item_links, next_page, page_links, pages_to_items, spec_rows, spec_table
from martkit.session import scratch_path
from martkit.sources.rawpages import read_raw_pages
from martkit.sources.readers import read_pages
from catalog import REGISTRY, query

_DECODE = ("replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')")


def corpus(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet")


@query("page_links", r"""with l as (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from pages),
e as (select page_id, url, unnest(h) as href, unnest(range(len(h))) as position from l)
select page_id, cast(position as int) as position, concat(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1), href)
  as link_url from e""")
def links(spark, sf):
    return page_links(corpus(spark, sf))


@query("page_heading", f"""select page_id, nullif({_DECODE.format("regexp_extract(html, '<h1>([^<]*)', 1)")}, '')
  as heading from pages""")
def heading(spark, sf):
    pages = corpus(spark, sf)
    raw = pages.select("page_id", H.first_text("html", H.open_tag("h1")).alias("heading"))
    return raw.withColumn("heading", H.unescape("heading"))


@query("page_attr", """select page_id, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') as lang,
  nullif(regexp_extract(html, '<div class="([^"]*)"', 1), '') as div_class,
  nullif(regexp_extract(html, '<meta charset="([^"]*)"', 1), '') as charset from pages""")
def attributes(spark, sf):
    return corpus(spark, sf).select(
        "page_id", H.first_attr("html", "lang", H.open_tag("html")).alias("lang"),
        H.first_attr("html", "class", H.open_tag("div")).alias("div_class"),
        H.first_attr("html", "charset", H.open_tag("meta")).alias("charset"))


@query("page_nav_items", r"""with n as (select page_id, regexp_extract(html, '<ul>(.*?)</ul>', 1, 's') as b from pages),
i as (select page_id, regexp_extract_all(b, '<li>(.*?)</li>', 1, 's') as items from n)
select page_id, cast(len(items) as int) as items, case when len(items) >= 2 then nullif(regexp_extract(items[-2],
  '<a [^>]*>([^<]*)', 1), '') end as second_last from i""")
def nav(spark, sf):
    block = corpus(spark, sf).select("page_id", H.inner_html("html", H.open_tag("ul")).alias("b"))
    items = block.select("page_id", H.list_items("b").alias("items"))
    return items.select("page_id", F.size("items").alias("items"), H.first_text(
        F.try_element_at("items", F.lit(-2)), H.open_tag("a")).alias("second_last"))


# How a browser resolves references of each kind, spelled out for a page's own parts.
_HREF = """case page_id % 6 when 0 then concat('/r/', cast(page_id as string)) when 1 then '../up.html'
  when 2 then concat('//cdn.example/', cast(page_id as string)) when 3 then '?q=1' when 4 then 'leaf/./x/../y'
  else 'https://other.example/a' end"""


@query("resolved_urls", rf"""with t as (select page_id, url, {_HREF} as href, regexp_extract(url, '^([a-z]+)://', 1) as scheme,
  regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as site, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path
  from pages),
d as (select *, regexp_replace(path, '[^/]*$', '') as dir from t),
u as (select *, regexp_replace(regexp_replace(dir, '/$', ''), '[^/]*$', '') as parent from d)
select page_id, href, case page_id % 6 when 0 then concat(site, href)
  when 1 then concat(site, case when parent = '' then '/' else parent end, 'up.html') when 2 then concat(scheme, ':', href)
  when 3 then concat(site, path, href) when 4 then concat(site, dir, 'leaf/y') else href end as link_url from u""")
def resolved(spark, sf):
    pages = corpus(spark, sf).selectExpr("page_id", "url", f"{_HREF} as href")
    return pages.select("page_id", "href", resolve_url("url", "href").alias("link_url"))


@query("page_basename", "select page_id, split_part(url, '/', -1) as name from pages")
def names(spark, sf):
    return corpus(spark, sf).select("page_id", basename("url").alias("name"))


@query("short_url_key", """select page_id, case when length(url) > 50 then split_part(url, '/', -1) else url end as key
from pages""")
def short_keys(spark, sf):
    return corpus(spark, sf).select("page_id", short_key("url").alias("key"))


# --- item pages rendered from parts; reading them must give the parts back ----
_KEY = "cast(p_partkey as string)"
_PRICE = "cast(p_retailprice as string)"
_WORD = ("case p_size % 6 when 0 then 'Zero' when 1 then 'One' when 2 then 'Two' when 3 then 'Three' "
         "when 4 then 'Four' else 'Five' end")
_URL = f"concat('http://shop.example/catalogue/item_', {_KEY}, '/index.html')"
_STOCK = "case when p_size % 4 = 0 then 'Out of stock' else concat('In stock (', cast(p_size as string), ' available)') end"
_ROWS = {
    "UPC": f"concat('upc-', {_KEY})",
    "Product Type": "p_brand",
    "Price (excl. tax)": f"concat('£', {_PRICE})",
    "Price (incl. tax)": f"concat('&pound;', {_PRICE})",
    "Tax": "case when p_partkey % 5 = 0 then '' else '£0.00' end",
    "Availability:": f"case when p_partkey % 3 = 0 then '' else {_STOCK} end",
    "Number of reviews": "case when p_partkey % 17 = 0 then '99999999999999999999' else cast(p_size as string) end",
}
_TABLE_ROWS = ", ".join(f"'<tr><th>{h}</th><td>', {v}, '</td></tr>\\n'" for h, v in _ROWS.items())
# Some parts are what a parser must not read, or must read although it looks odd: commented-out and scripted
# markup, attributes without quotes or with the other quote inside, several links in a box, an empty box, a
# second striped table, cells with child elements, a pager without a link, a header with a colon, a huge number.
_HTML = f"""concat('<html><head><title>x</title><script>var t = "<div class=product_main><h1>no</h1></div>";</script></head>',
  '<body><!-- <div class="product_main"><h1>old</h1></div><div class="product_pod"><h3><a href="/gone">x</a></h3></div> -->',
  '<ul class="breadcrumb">\\n<li><a href="../../index.html">Home</a></li>',
  '<li><a href="../c.html">Items</a></li><li><a href="../c/x.html">', p_type, '</a></li><li class="active">', p_name,
  '</li></ul><div id="product_gallery" class="carousel"><div class="thumbnail"><div class="item active">',
  case when p_partkey % 7 = 0 then '' else concat('<img alt="x" src="../../media/o', char(39), {_KEY}, '.jpg"/>') end,
  '</div></div></div><div class="col-sm-6 product_main"><h1>', p_name, ' &amp; ', p_brand, '</h1><p class="price_color">£',
  {_PRICE}, '</p>', case when p_partkey % 3 = 0 then concat('<p class="instock availability">\\n ', {_STOCK}, '\\n</p>') else '' end,
  case when p_partkey % 11 = 0 then '' else concat('<p class="star-rating ', {_WORD}, '"><i class="icon-star"></i></p>') end,
  '</div><div id="product_description" class="sub-header"><h2>Product Description</h2></div>\\n<p>', p_name, ' &lt;', p_type,
  '&gt;</p><table class="other"><tr><th>UPC</th><td>none</td></tr></table><table class="table table-striped">',
  case when p_partkey % 13 = 0 then '<tr><th>UPC</th><td>old</td></tr>' else '' end, {_TABLE_ROWS},
  '</table><table class="striped table table-striped"><tr><th>Tax</th><td><b>x</b> t', {_KEY}, '</td></tr></table>',
  '<div class="product_pod"><h3><a href="../item_', cast(p_partkey + 1 as string), '/index.html">next</a>',
  concat('<a href=', char(39), '/two?a="b"', char(39), '>and</a></h3>'),
  '<p class="star-rating One"></p><p class="price_color">£1.00</p></div><div class="product_pod"><p>empty</p></div>',
  '<article class="row product_pod"><h3><a title="t" href=/item_',
  cast(p_partkey + 2 as string), '>more</a></h3></article>',
  case when p_size % 9 = 0 then '<ul class="pager"><li class="next disabled">next</li></ul><a href="/footer">f</a>' else concat('<ul class="pager"><li class="next"><a href="page-', cast(p_size as string),
  '.html">next</a></li></ul>') end, '</body></html>')"""


def item_pages(spark, sf):
    # One row group would be one task, whatever it costs to read its pages.
    parts = spark.read.parquet(f"{sf}/part.parquet").repartition(spark.sparkContext.defaultParallelism)
    return parts.selectExpr("p_partkey as page_id", f"{_URL} as url", f"{_HTML} as html")


_SPEC = f"""select p_partkey, {_ROWS['UPC']} as upc, p_brand as product_type, concat('£', {_PRICE}) as price_text,
  concat(' t', {_KEY}) as tax_text, case when p_partkey % 5 = 0 then null else '£0.00' end as first_tax,
  case when p_partkey % 3 = 0 then null else {_STOCK} end as stock_cell,
  case when p_partkey % 17 = 0 then '99999999999999999999' else cast(p_size as varchar) end as reviews_text from part"""


@query("page_spec_table", f"""with s as ({_SPEC})
select p_partkey as page_id, upc, product_type, price_text as price_excl_tax_raw, price_text as price_incl_tax_raw,
  tax_text as tax_raw, reviews_text as reviews_raw, cast(null as varchar) as stock_cell from s""")
def spec(spark, sf):
    return spec_table(item_pages(spark, sf))


@query("page_spec_rows", f"""with s as ({_SPEC}), r as (
  select p_partkey as page_id, 0 as k, 'UPC' as header, 'old' as value from s where p_partkey % 13 = 0
  union all select p_partkey, 1, 'UPC', upc from s union all select p_partkey, 2, 'Product Type', product_type from s
  union all select p_partkey, 3, 'Price (excl. tax)', price_text from s
  union all select p_partkey, 4, 'Price (incl. tax)', price_text from s
  union all select p_partkey, 5, 'Tax', first_tax from s where first_tax is not null
  union all select p_partkey, 6, 'Availability:', stock_cell from s where stock_cell is not null
  union all select p_partkey, 7, 'Number of reviews', reviews_text from s
  union all select p_partkey, 8, 'Tax', tax_text from s)
select page_id, cast(row_number() over (partition by page_id order by k) - 1 as int) as position, header, value from r""")
def spec_lines(spark, sf):
    return spec_rows(item_pages(spark, sf))


@query("item_links", """select p_partkey as page_id, 0 as position,
  concat('http://shop.example/catalogue/item_', cast(p_partkey + 1 as varchar), '/index.html') as link_url from part
union all select p_partkey, 1, 'http://shop.example/two?a="b"' from part
union all select p_partkey, 2, concat('http://shop.example/item_', cast(p_partkey + 2 as varchar)) from part""")
def listed_items(spark, sf):
    return item_links(item_pages(spark, sf))


@query("next_page", f"""select p_partkey as page_id, case when p_size % 9 <> 0 then
  concat('http://shop.example/catalogue/item_', {_KEY}, '/page-', cast(p_size as varchar), '.html') end as next_url
from part""")
def pager(spark, sf):
    return next_page(item_pages(spark, sf))


_SCRAPED = "2026-02-10 10:25:25"


@query("pages_to_items", f"""with s as (select * from part),
i as (select {_URL} as url, timestamp '{_SCRAPED}' as scraped_at, concat(p_name, ' & ', p_brand) as title,
  p_retailprice as price, concat('£', {_PRICE}) as price_raw,
  case when p_size % 4 = 0 then 'Out of stock' else 'In stock' end as availability, {_STOCK} as availability_raw,
  case when p_size % 4 = 0 then 0 else p_size end as available_quantity, p_size % 4 <> 0 as in_stock,
  case when p_size % 4 = 0 then 'out_of_stock' else 'in_stock' end as availability_status,
  concat(p_name, ' <', p_type, '>') as description, concat('upc-', {_KEY}) as upc, p_brand as product_type,
  p_retailprice as price_excl_tax, concat('£', {_PRICE}) as price_excl_tax_raw,
  p_retailprice as price_incl_tax, concat('£', {_PRICE}) as price_incl_tax_raw,
  cast(p_partkey as double) as tax, concat(' t', {_KEY}) as tax_raw,
  case when p_partkey % 17 = 0 then null else p_size end as reviews_count,
  case when p_partkey % 11 = 0 then 1 else p_size % 6 end as rating,
  case when p_partkey % 11 = 0 then 'One' else {_WORD} end as rating_text, p_type as category,
  case when p_partkey % 7 = 0 then null else concat('http://shop.example/media/o''', {_KEY}, '.jpg') end as image_url,
  case when p_partkey % 7 = 0 then null else concat('o''', {_KEY}, '.jpg') end as image_filename from s)
select *, round(cast(9 + case when rating = 0 then 0 else 1 end + case when image_url is null then 0 else 1 end as double)
  / 11 * 100, 2) as data_quality_score from i""")
def items(spark, sf):
    return pages_to_items(item_pages(spark, sf), F.lit(_SCRAPED).cast("timestamp_ntz"))


# The same pages as HTML also allows them: end tags left out, ``>`` and ``<`` inside attribute values.
_LOOSE = {
    "</td></tr>\n": "", "</td></tr>": "", "</th>": "", "</li>": "", "</p>": "",
    '<p class="price_color">': '<p data-note="5 > 4" class="price_color">',
    "<h1>": "<h1 title='a > b'>",
    '<img alt="x"': '<img alt="1 > 0 < 2"',
    '<a title="t"': '<a title="</h3> >"',
    '<div id="product_description"': '<div data-q="a>b" id="product_description"',
    '<a href="page-': '<a data-x=">" href="page-',
    '<div class="col-sm-6 product_main">': '<div data-a="x>y" class="col-sm-6 product_main">',
}


def loose_pages(spark, sf):
    html = F.col("html")
    for found, put in _LOOSE.items():
        html = F.replace(html, F.lit(found), F.lit(put))
    return item_pages(spark, sf).withColumn("html", html)


def _same(name: str, source: str):
    """A query over the loose pages whose result is that of ``source`` over the full ones."""
    return query(name, REGISTRY[source].sql)


@_same("page_spec_rows_loose", "page_spec_rows")
def loose_spec_lines(spark, sf):
    return spec_rows(loose_pages(spark, sf))


@_same("item_links_loose", "item_links")
def loose_listed_items(spark, sf):
    return item_links(loose_pages(spark, sf))


@_same("next_page_loose", "next_page")
def loose_pager(spark, sf):
    return next_page(loose_pages(spark, sf))


@_same("pages_to_items_loose", "pages_to_items")
def loose_items(spark, sf):
    return pages_to_items(loose_pages(spark, sf), F.lit(_SCRAPED).cast("timestamp_ntz"))


@_same("page_links_signs", "page_links")
def links_beside_signs(spark, sf):
    """Every anchor gets attributes with a ``>`` in front of its ``href``; no link may be lost."""
    pages = corpus(spark, sf)
    return page_links(pages.withColumn("html", F.replace("html", F.lit("<a href="), F.lit("<a title='5 > 4' data-x=\">\" href="))))


# A page's label by the bytes it is written in: marked UTF-8, marked UTF-16, and ISO-8859-1 where that can hold it.
_LATIN = r"r'^[\x00-\xff]*$'"
_PUT = "replace(html, '<meta charset=\"utf-8\">', '<meta charset=\"iso-8859-1\">')"


def raw_folder(spark, sf):
    """The pages as files, one each, in three character sets."""
    narrow = f"page_id % 3 = 2 and html rlike {_LATIN}"
    page = F.expr(f"case when {narrow} then {_PUT} else html end")
    # The writer ends each file with one byte, a line feed: the second one of a feed in UTF-16.
    wide = F.expr("unhex(concat('FEFF', hex(encode(html, 'UTF-16BE')), '00'))")
    content = F.when(F.col("narrow"), F.encode(F.when(F.col("narrow"), F.col("html")), "ISO-8859-1")).when(
        F.col("page_id") % 3 == 1, wide).otherwise(F.expr("unhex(concat('EFBBBF', hex(html)))"))
    pages = corpus(spark, sf).select("page_id", F.expr(narrow).alias("narrow"), page.alias("html"))
    path = scratch_path(spark, "raw-pages")
    # The driver holds a row for each folder that a job writes, so a job writes a share of the ids; every task has some of them.
    jobs, h = max(1, -(-pages.count() // _PAGES_A_JOB)), F.xxhash64("page_id")
    shelf = F.pmod(F.shiftright(h, 32), F.lit(_SHELVES)).alias("shelf")
    for k in range(jobs):
        pages.filter(F.pmod(h, F.lit(jobs)) == k).select(shelf, "page_id", content.cast("string").alias("value")).write.partitionBy(
            "shelf", "page_id").text(f"{path}/part={k}")
    return path


# Pages that one job writes, and folders that they are dealt to.
_PAGES_A_JOB, _SHELVES = 100_000, 20


@query("raw_pages_decoded", rf"""select page_id, md5(concat(case when page_id % 3 = 2 and regexp_full_match(html, '[\x00-\xff]*', 's')
  then {_PUT} else html end, chr(10))) as page_md5, nullif({_DECODE.format("regexp_extract(html, '<h1>([^<]*)', 1)")}, '') as heading
from pages""")
def raw_pages(spark, sf):
    pages = read_raw_pages(spark, raw_folder(spark, sf), pattern="part-*")
    return pages.select("page_id", F.md5(F.col("html").cast("binary")).alias("page_md5"),
                        H.unescape(H.first_text("html", H.open_tag("h1"))).alias("heading"))
