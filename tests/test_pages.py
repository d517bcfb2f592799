"""Item pages written by hand, with the variants a shop produces."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martkit.functions import html as H
from martkit.functions.markup import close_elements, closed_markup, leaves_open
from martkit.plans.items import item_links, next_page, page_links, pages_to_items, spec_rows, spec_table

URL = "https://shop.example/catalogue/a-light_1000/index.html"
SPEC = """<table class="table table-striped">
<tr><th>UPC</th><td>a897fe39b1053632</td></tr><tr><th>Product Type</th><td>Books</td></tr>
<tr><th>Price (excl. tax)</th><td>£51.77</td></tr><tr><th>Price (incl. tax)</th><td>&pound;51.77</td></tr>
<tr><th>Tax</th><td>£0.00</td></tr>
<tr>
    <th>Availability</th>
    <td>In stock (22 available)</td>
</tr><tr><th>Number of reviews</th><td>0</td></tr></table>"""
MAIN = """<div class="col-sm-6 product_main"><h1>A Light &amp; a Dark</h1>
<p class="price_color">£51.77</p>
<p class="instock availability">
    <i class="icon-ok"></i>

        In stock (22 available)

</p>
<p class="star-rating Three"><i class="icon-star"></i></p></div>"""
CRUMBS = """<ul class="breadcrumb"><li><a href="../../index.html">Home</a></li>
<li><a href="../category/books_1/index.html">Books</a></li>
<li><a href="../category/books/poetry_23/index.html">Poetry</a></li><li class="active">A Light</li></ul>"""
GALLERY = """<div id="product_gallery" class="carousel"><div class="thumbnail"><div class="carousel-inner">
<div class="item active"><img src="../../media/cache/fe/72/fe72.jpg" alt="A Light" /></div></div></div></div>"""
ABOUT = """<div id="product_description" class="sub-header">
<h2>Product Description</h2></div>
<p>It&#39;s hard to imagine.</p>"""
OTHERS = """<article class="product_pod"><div class="image_container"><a href="../other_9/index.html"><img src="x.jpg"></a></div>
<p class="star-rating One"></p><h3><a href="../other_9/index.html" title="O">O</a></h3>
<p class="price_color">£1.00</p><p class="instock availability">Sold out</p></article>"""


def page(crumbs=CRUMBS, gallery=GALLERY, main=MAIN, about=ABOUT, spec=SPEC, others=""):
    return f"<!DOCTYPE html><html><body>{crumbs}{gallery}{main}{about}{spec}{others}</body></html>"


def read(spark, *pages):
    df = spark.createDataFrame([(i, URL, p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    out = pages_to_items(df, F.lit("2026-02-10 10:25:25").cast("timestamp_ntz"))
    return out.collect()


def test_complete_page(spark):
    (got,) = read(spark, page(others=OTHERS))
    assert got.asDict() == {
        "url": URL, "scraped_at": datetime(2026, 2, 10, 10, 25, 25), "title": "A Light & a Dark", "price": 51.77,
        "price_raw": "£51.77", "availability": "In stock", "availability_raw": "In stock (22 available)",
        "available_quantity": 22, "in_stock": True, "availability_status": "in_stock",
        "description": "It's hard to imagine.", "upc": "a897fe39b1053632", "product_type": "Books",
        "price_excl_tax": 51.77, "price_excl_tax_raw": "£51.77", "price_incl_tax": 51.77,
        "price_incl_tax_raw": "£51.77", "tax": 0.0, "tax_raw": "£0.00", "reviews_count": 0, "rating": 3,
        "rating_text": "Three", "category": "Poetry",
        "image_url": "https://shop.example/media/cache/fe/72/fe72.jpg", "image_filename": "fe72.jpg",
        "data_quality_score": 100.0}


def test_missing_parts(spark):
    empty, bare = read(spark, "<html></html>", page(crumbs="", gallery="", about="", spec="", others=""))
    assert empty.data_quality_score == 9.09 and empty.availability == "Unknown" and empty.availability_raw is None
    assert (empty.in_stock, empty.available_quantity, empty.availability_status) == (False, 0, "unknown")
    assert empty.rating is None and empty.image_url is None and empty.title is None
    # The block's first text is the line break before its icon: white space, hence out of stock.
    assert bare.title == "A Light & a Dark" and bare.availability == "Out of stock" and bare.availability_raw == ""
    assert bare.data_quality_score == 36.36


@pytest.mark.parametrize("change, field, want", [
    (lambda p: p.replace("star-rating Three", "star-rating Seven"), "rating", 0),
    (lambda p: p.replace("star-rating Three", "star-rating Seven"), "rating_text", "Seven"),
    (lambda p: p.replace("<td>£0.00</td>", "<td></td>"), "tax", None),
    (lambda p: p.replace("</table>", "<tr><th>UPC</th><td>later</td></tr></table>"), "upc", "later"),
    (lambda p: p.replace('class="price_color"', "class='price_color'", 1), "price", 51.77),
    (lambda p: p.replace('<p class="price_color">£51.77</p>', ""), "price", None),
    (lambda p: p.replace('class="price_color"', 'class="price_colors"', 1), "price", None),
    (lambda p: p.replace("<h1>", '<H1 id="t">').replace("</h1>", "</H1>"), "title", "A Light & a Dark"),
    (lambda p: p.replace(ABOUT, ABOUT.replace("</div>\n<p>", "</div><hr><p>")), "description", None),
    (lambda p: p.replace("In stock (22 available)", "(available)"), "availability", "In stock (1 available)"),
    (lambda p: p.replace("Number of reviews</th><td>0", "Number of reviews</th><td>12"), "reviews_count", 12),
    (lambda p: p.replace('table class="table table-striped"', 'table class="table-striped big table"'), "upc",
     "a897fe39b1053632"),
    (lambda p: p.replace('table class="table table-striped"', 'table class="table"'), "upc", None),
])
def test_variants(spark, change, field, want):
    (got,) = read(spark, change(page(others=OTHERS)))
    assert got[field] == want


def test_stock_text_places(spark):
    no_cell = SPEC.replace("In stock (22 available)", "")
    main = MAIN[:MAIN.index("<p class=\"instock")] + "</div>"
    in_main = main.replace("</div>", '<p class="availability">3 left</p></div>')
    a, b = read(spark, page(spec=no_cell, main=in_main, others=OTHERS), page(spec=no_cell, main=main, others=OTHERS))
    assert (a.availability, a.available_quantity) == ("3 left", 3)
    assert (b.availability, b.availability_status) == ("Sold out", "out_of_stock")


def test_listing(spark):
    listing = (OTHERS + OTHERS.replace("other_9", "more_3")
               + '<ul class="pager"><li class="current">Page 1</li><li class="next"><a href="page-2.html">next</a></li></ul>')
    df = spark.createDataFrame([(1, URL, listing), (2, URL, OTHERS)], "page_id long, url string, html string")
    found = [(r.page_id, r.link_url) for r in item_links(df).orderBy("page_id", "position").collect()]
    base = "https://shop.example/catalogue/"
    assert found == [(1, base + "other_9/index.html"), (1, base + "more_3/index.html"), (2, base + "other_9/index.html")]
    assert [r.next_url for r in next_page(df).orderBy("page_id").collect()] == [
        base + "a-light_1000/page-2.html", None]
    assert page_links(df).where("page_id = 1").count() == 5


def test_comments_and_scripts_can_be_cut(spark):
    df = spark.createDataFrame([("<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><h1>yes</h1>",)], "html string")
    assert df.select(H.first_text(H.visible_markup("html"), H.open_tag("h1"))).first()[0] == "yes"


def test_spec_table_only_reads_its_table(spark):
    df = spark.createDataFrame([(1, "<table><tr><th>UPC</th><td>x</td></tr></table>" + SPEC)], "page_id long, html string")
    assert spec_table(df).first().upc == "a897fe39b1053632"


def one_page(spark, body):
    return spark.createDataFrame([(1, "http://s.example/a/b.html", body)], "page_id long, url string, html string")


def test_what_is_not_shown_is_not_read(spark):
    hidden = ('<!-- <div class="product_main"><h1>old</h1></div><a href="/c">x</a> --><script>"<a href=/s>"</script>'
              '<style><a href="/t"></style><div class="product_main"><h1>new</h1></div><a href="/d">y</a>')
    assert read(spark, hidden)[0].title == "new"
    assert [r.link_url for r in page_links(one_page(spark, hidden)).collect()] == ["http://s.example/d"]


def test_attribute_quoting(spark):
    body = """<a href="/o'brien/x">1</a><a href='/q"r'>2</a><a href=/plain>3</a><p class=next><a href=/n>4</a></p>"""
    assert [r.link_url for r in page_links(one_page(spark, body)).orderBy("position").collect()] == [
        "http://s.example/o'brien/x", 'http://s.example/q"r', "http://s.example/plain", "http://s.example/n"]
    assert next_page(one_page(spark, body)).first().next_url == "http://s.example/n"


def test_links_stay_inside_their_element(spark):
    body = ('<ul><li class="next disabled">next</li></ul><div class="product_pod"><h3>none</h3></div>'
            '<div class="product_pod"><h3><a href="/1">a</a><a href="/2">b</a></h3><a href="/not">c</a></div><a href="/f">f</a>')
    assert next_page(one_page(spark, body)).first().next_url is None
    assert [r.link_url for r in item_links(one_page(spark, body)).orderBy("position").collect()] == [
        "http://s.example/1", "http://s.example/2"]


def test_all_striped_tables_and_mixed_cells(spark):
    body = ('<table class="table table-striped"><tr><th>UPC</th><td>u1</td></tr></table>'
            '<div class="table table-striped"><table><tr><th><i>!</i>Product Type</th><td><b>x</b> u9</td></tr>'
            '<tr><th>Tax</th><td><b><i>x</i></b><br/>t</td></tr><tr><th>Empty</th><td></td></tr></table></div>')
    assert [(r.header, r.value) for r in spec_rows(one_page(spark, body)).orderBy("position").collect()] == [
        ("UPC", "u1"), ("Product Type", " u9"), ("Tax", "t")]


@pytest.mark.parametrize("body", [
    '<table class="table table-striped"><tr><th>Availability:</th><td>In stock (3 available)</td></tr></table>',
    "<table><tr><th>Availability</th><td>In stock (3 available)</td></tr></table>",
    "<table><tr><td>Availability</td></tr><tr><td>x</td></tr></table><p class='availability'><i></i>In stock (3 available)</p>"
    .replace("<td>Availability</td>", "<td></td>"),
    '<div class="product_main"><p class="availability">In stock (3 available)</p></div>',
])
def test_places_of_the_stock_text(spark, body):
    row = read(spark, body)[0]
    assert (row.availability_raw, row.available_quantity) == ("In stock (3 available)", 3)


def test_no_value_ends_the_job(spark):
    body = '<table class="table table-striped"><tr><th>Number of reviews</th><td>9999999999</td></tr></table>'
    assert read(spark, body)[0].reviews_count is None
    texts = spark.createDataFrame(
        [("&#00000065;&#x000000042;&#99999999999999999999;&#xFFFFFFFFFF;&nosuch;&amp;lt;",)], "t string")
    assert texts.select(H.unescape("t")).first()[0] == "AB��&nosuch;&lt;"


def test_page_leaves_after_its_blocks(spark):
    plan = pages_to_items(one_page(spark, ""), F.lit(None).cast("timestamp_ntz"))._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "html#" in line]
    assert len(reads) <= 3, plan[:2000]


def test_signs_inside_attribute_values(spark):
    body = ("""<a title="5 > 4" href="/x">1</a><a data-href="/no" title='a>b' href='/y'>2</a><a title=it's href=/z>3</a>"""
            """<a href="/first" href="/second">4</a><a/href="/w">5</a>""")
    assert [r.link_url for r in page_links(one_page(spark, body)).orderBy("position").collect()] == [
        f"http://s.example/{n}" for n in ("x", "y", "z", "first", "w")]
    main = '<div data-q="a>b" class="product_main"><h1 title="1 > 0">T</h1><p data-x=">" class="price_color" data-y="<">£2</p></div>'
    row = read(spark, main)[0]
    assert (row.title, row.price) == ("T", 2.0)
    assert read(spark, '<p title=\'class="star-rating Five"\' class="star-rating Two">x</p>')[0].rating == 2


LOOSE = (CRUMBS.replace("</li>", "") + MAIN.replace("</p>", "") + ABOUT.replace("</p>", "")
         + SPEC.replace("</td>", "").replace("</th>", "").replace("</tr>", ""))


def test_end_tags_left_out(spark):
    loose, full = read(spark, f"<html><body>{LOOSE}", page(gallery=""))
    for name in ("title", "price", "category", "upc", "product_type", "price_incl_tax", "rating", "reviews_count", "available_quantity", "in_stock"):
        # The line break between a cell and the next row is text of the open cell.
        assert (loose[name].strip() if isinstance(full[name], str) else loose[name]) == full[name], name
    assert loose.description.strip() == full.description
    nav = one_page(spark, '<ul class="pager"><li class="current">1<li class="next"><a href="p2">next</a></ul><a href="/foot">f</a>')
    assert next_page(nav).first().next_url == "http://s.example/a/p2"
    none = one_page(spark, '<ul class="pager"><li class="next">next<li class="last"><a href="p9">last</a></ul>')
    assert next_page(none).first().next_url is None


def test_closed_pages_stay_as_they_are(spark):
    bodies = [page(others=OTHERS), LOOSE, "<p>a</p>text < 5 & more", None, "", '<a title="<li>">x</a>', "<LI>a</LI><Td>b"]
    df = spark.createDataFrame([(b,) for b in bodies], "html string")
    assert [r[0] for r in df.select(leaves_open(F.col("html"))).collect()] == [False, True, False, None, False, True, True]
    got = [r[0] for r in closed_markup(df, "html").collect()]
    assert got[0] == bodies[0] and got[2:5] == bodies[2:5]
    assert got[5:] == ['<a title="&lt;li&gt;">x</a>', "<li>a</li><td>b</td>"]


@pytest.mark.parametrize("loose, full", [
    ("<ul><li>a<li>b <b>x</ul><p>one<div>two</p>", "<ul><li>a</li><li>b <b>x</b></li></ul><p>one</p><div>two</div>"),
    ("<table><tr><th>A<td title='5 > 4'>1<tr><td>2<table><tr><td>in</table></table>z",
     '<table><tr><th>A</th><td title="5 &gt; 4">1</td></tr><tr><td>2<table><tr><td>in</td></tr></table></td></tr></table>z'),
    ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>"),
    ("<td>a</li></td>", "<td>a</td>"),
    ("x<![if q]>y<![foo[z]]><br/><p/>&copy 1 &amp;", "xy<br><p></p>&copy 1 &amp;"),
    ("<p>" * 3000, "<p></p>" * 3000),
])
def test_elements_are_closed_where_html_closes_them(loose, full):
    assert close_elements(loose) == full


def test_references_without_a_semicolon(spark):
    df = spark.createDataFrame([("&copy 2020 &notin; &notit; &#65 &#x42&amp &nosuch &copy=1",)], "t string")
    assert df.select(H.unescape("t")).first()[0] == "© 2020 ∉ ¬it; A B& &nosuch ©=1"
    assert df.select(H.unescape("t", attribute=True)).first()[0] == "© 2020 ∉ &notit; A B& &nosuch &copy=1"
    body = '<a href="/q?a=1&copy=2&reg;=3&lt">x</a>'
    assert page_links(one_page(spark, body)).first().link_url == "http://s.example/q?a=1&copy=2®=3<"
