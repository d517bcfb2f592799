"""A corpus of item pages to raw item rows, in one stage without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions import html as H
from martkit.functions.availability import with_availability
from martkit.functions.markup import closed_markup
from martkit.functions.numbers import SCORED_FIELDS, completeness_score, parse_amount, parse_count
from martkit.functions.text import first_non_empty, last_token, map_lookup
from martkit.functions.urls import basename, resolve_url
from martkit.schemas import RAW_ITEM

# --- fixed values: page landmarks, table headers and rating words -------------
MAIN = H.open_tag(H.ANY, "product_main")
GALLERY = H.open_tag(H.ANY, element_id="product_gallery")
BREADCRUMB = H.open_tag(H.ANY, "breadcrumb")
SPEC_TABLE = H.open_tag(H.ANY, "table", "table-striped")
ITEM_BOX = H.open_tag(H.ANY, "product_pod")
STOCK = H.open_tag(H.ANY, "availability")
NEXT = H.open_tag(H.ANY, "next")
HEADERS = {
    "upc": "UPC",
    "product_type": "Product Type",
    "price_excl_tax_raw": "Price (excl. tax)",
    "price_incl_tax_raw": "Price (incl. tax)",
    "tax_raw": "Tax",
    "reviews_raw": "Number of reviews",
    "stock_cell": "Availability",
}
ATTRIBUTES = ("image_src", "stars")
RATING_WORDS = {"Zero": 0, "One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
# --- end of fixed values ------------------------------------------------------


def item_links(pages: DataFrame) -> DataFrame:
    """One row per item link of a listing page, absolute, with its position: all anchors of all boxes."""
    return explode_links(pages, lambda page: H.links_within(page, ITEM_BOX, H.open_tag("h3")))


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link of a page, absolute, with its position."""
    return explode_links(pages, H.all_links)


def visible(pages: DataFrame, *columns: str) -> DataFrame:
    """The given columns and ``_page``, the markup without comments, scripts and styles, every element with its end tag."""
    return closed_markup(pages.select(*columns, H.visible_markup("html").alias("_page")), "_page")


def explode_links(pages: DataFrame, hrefs: Callable[[Column], Column]) -> DataFrame:
    out = visible(pages, "page_id", "url").select("page_id", "url", hrefs(F.col("_page")).alias("_hrefs"))
    out = out.select("page_id", "url", F.posexplode(H.unescape_all(F.col("_hrefs"), attributes=True)).alias("position", "href"))
    return out.select("page_id", "position", resolve_url("url", "href").alias("link_url"))


def next_page(pages: DataFrame) -> DataFrame:
    """The pager's link, absolute, or NULL on the last page of a list."""
    hrefs = visible(pages, "page_id", "url").select(
        "page_id", "url", F.try_element_at(H.links_within("_page", NEXT), F.lit(1)).alias("_href"))
    return hrefs.select("page_id", "url", H.unescape("_href", attribute=True).alias("_href")).select(
        "page_id", F.when(F.col("_href") != "", resolve_url("url", "_href")).alias("next_url"))


def spec_rows(pages: DataFrame) -> DataFrame:
    """The two-column specification rows of every page as (page_id, position, header, value)."""
    blocks = visible(pages, "page_id").select("page_id", H.elements("_page", SPEC_TABLE).alias("_blocks"))
    pairs = blocks.select("page_id", F.posexplode(H.kv_rows(F.col("_blocks"))).alias("position", "kv"))
    texts = pairs.select("page_id", "position", H.unescape_all(F.array("kv.k", "kv.v")).alias("kv"))
    return texts.select("page_id", "position", F.col("kv")[0].alias("header"), F.col("kv")[1].alias("value"))


def spec_table(pages: DataFrame) -> DataFrame:
    """The specification of every page as one row; a repeated header keeps its last value."""
    blocks = visible(pages, "page_id").select("page_id", H.elements("_page", SPEC_TABLE).alias("_blocks"))
    staged = blocks.select("page_id", H.kv_rows(F.col("_blocks")).alias("_pairs"))
    return _decoded(staged, ["page_id"], {
        name: H.kv_lookup(F.col("_pairs"), header) for name, header in HEADERS.items()})


def _decoded(rows: DataFrame, keep: list[str], texts: dict[str, Column]) -> DataFrame:
    """The texts with their character references decoded, all of a row in one expression."""
    kinds = {False: [n for n in texts if n not in ATTRIBUTES], True: [n for n in texts if n in ATTRIBUTES]}
    raw = rows.select(*keep, *[F.array(*[texts[n] for n in names]).alias(f"_raw_{kind}") for kind, names in kinds.items() if names])
    decoded = raw.select(*keep, *[H.unescape_all(F.col(f"_raw_{kind}"), kind).alias(f"_texts_{kind}")
                                  for kind, names in kinds.items() if names])
    return decoded.select(*keep, *[F.col(f"_texts_{kind}")[i].alias(name) for kind, names in kinds.items()
                                   for i, name in enumerate(names)])


def pages_to_items(pages: DataFrame, scraped_at: Column) -> DataFrame:
    """Raw item rows of a corpus of detail pages.

    Projections in a row: cut what is not shown, close what is left open, cut the page into its blocks, read texts and
    attributes out of them, decode those, then derive the typed columns.  The page itself
    leaves with the blocks.  A number that its column cannot hold becomes NULL.
    """
    blocks = visible(pages, "url").select(
        "url",
        H.inner_html("_page", MAIN).alias("_main"),
        H.kv_rows(H.elements("_page", SPEC_TABLE)).alias("_pairs"),
        H.inner_html("_page", GALLERY).alias("_gallery"),
        F.regexp_extract("_page", rf"(?s){BREADCRUMB}(.*?)</[uoUO][lL]\s*>", 1).alias("_crumbs"),
        H.sibling_text("_page", "product_description", "p").alias("_description"),
        H.first_attr("_page", "class", H.open_tag(H.ANY, "star-rating")).alias("_stars"),
        H.cell_beside("_page", HEADERS["stock_cell"]).alias("_stock_row"),
        # Only a page without a stock text in a table or the main block needs this one.
        H.deep_text(H.inner_html("_page", STOCK)).alias("_stock_any"),
    )
    cells = _decoded(blocks, ["url"], {
        "title": H.first_text("_main", H.open_tag("h1")),
        "price_raw": H.first_text("_main", H.open_tag(H.ANY, "price_color")),
        "stock_main": H.first_text("_main", STOCK),
        "image_src": H.first_attr("_gallery", "src", H.open_tag("img")),
        "category": H.first_text(F.try_element_at(H.list_items("_crumbs"), F.lit(-2)), H.open_tag("a")),
        "description": F.col("_description"),
        "stars": F.col("_stars"),
        "stock_row": F.col("_stock_row"),
        "stock_any": F.col("_stock_any"),
        **{name: H.kv_lookup(F.col("_pairs"), header) for name, header in HEADERS.items()},
    })
    stock = first_non_empty("stock_cell", "stock_row", "stock_main", "stock_any")
    named = with_availability(cells.withColumn("_stock", stock), "_stock")

    word = last_token("stars")
    image = F.col("image_src")
    derived = {
        "scraped_at": scraped_at,
        "price": parse_amount("price_raw"),
        "price_excl_tax": parse_amount("price_excl_tax_raw"),
        "price_incl_tax": parse_amount("price_incl_tax_raw"),
        "tax": parse_amount("tax_raw"),
        "reviews_count": parse_count("reviews_raw"),
        "rating": map_lookup(word, RATING_WORDS, 0),
        "rating_text": word,
        "image_url": F.when(image.isNotNull(), resolve_url("url", "image_src")),
        "image_filename": basename("image_src"),
    }
    score = "data_quality_score"
    body = named.select(*[
        derived.get(f.name, F.col(f.name) if f.name in named.columns else F.lit(None))
        .try_cast(f.dataType).alias(f.name)
        for f in RAW_ITEM if f.name != score])
    return body.withColumn(score, completeness_score(body, SCORED_FIELDS))
