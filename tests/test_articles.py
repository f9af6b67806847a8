"""Articles: golden page, contract defaults, ties, blanks and helpers."""

from pyspark.sql import functions as F

from faultlake.functions import text as T
from faultlake.operators import articles as A
from faultlake.sources import html as H

PAGE = """<html><body><h1> My  Title </h1><div class="content-date-comments"><div class="date-meta">1 May 2022</div></div>
<div class="futurio-content single-content"><p>The pump is fine &amp; dry.<p>Насос в порядке.</p>
<figure><img src="data:image/svg+xml;x" data-src="/up/a.jpg"><img src="/up/b.jpg" srcset="/up/s.jpg 300w, /up/l.jpg 900w"></figure>
<p>Fault codes:</p><ul><li>P1570,</li><li>21F37E</li></ul><p>Part no</p><ul><li>1E100RMX0132,</li></ul></div>
<span class="categories-links"><a>Crap</a><a>Cars</a><a>Cars</a></span><div class="tags-links"><a>ev</a></div>
<div class="comment-body"><cite class="fn">Ann</cite><div class="comment-meta"><a>today</a></div><p>Hi</p><p></p><p>there</p></div></body></html>"""


def pages(spark, *html):
    return spark.createDataFrame([(i, "https://x.example/p/1", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_golden_page(spark):
    r = H.parse_articles(pages(spark, PAGE)).first()
    assert (r.title, r.published_date) == ("My Title", "1 May 2022")
    assert r.fault_codes == ["P1570", "21F37E"] and r.part_numbers == ["1E100RMX0132"]
    assert r.images == ["https://x.example/up/a.jpg", "https://x.example/up/l.jpg"]
    assert r.categories == ["Cars"] and r.tags == ["ev"]
    assert [c.asDict() for c in r.comments] == [{"author": "Ann", "text": "Hi\n\nthere", "date": "today"}]
    assert r.content.startswith("The pump is fine & dry.")


def test_empty_pages_have_no_article(spark):
    assert H.parse_articles(pages(spark, None, "")).count() == 0
    assert H.html_nodes(pages(spark, None, "")).count() == 0


def test_tree_rules(spark):
    nodes = H.parse("<div><p>a<br>b<p>c</div></span><script>x</script>tail")
    assert [n["tag"] for n in nodes] == ["div", "p", "br", "p", "script"]
    assert "".join(nodes[1]["parts"]) == "abc" and "".join(nodes[0]["parts"]) == "abc"
    assert H.selector("  ") is None


def test_index_links(spark):
    page = pages(spark, '<a class="tpg-post-link" href="/a">x</a><a class="tpg-post-link" href="/a">y</a><a href="/b">z</a><a class="tpg-post-link">n</a>')
    assert [r.url for r in A.collect_urls(H.index_links(page), 5, ["page_ord", "pos"]).collect()] == ["https://x.example/a"]


def test_adapt_defaults_and_clashing_columns(spark):
    schema = "id long, title string, content string, images array<string>, comments array<struct<author:string,text:string,date:string>>, published_date string, url string, source string, summary string"
    raw = spark.createDataFrame([(1, None, None, None, None, None, None, None, "old"), (2, "\t T \n", "x" * 300, ["a"], [], "d", "", "s", "old")], schema)
    rows = A.adapt_articles(raw).orderBy("id").collect()
    assert rows[0].title == "" and rows[0].images == [] and rows[0].comments == [] and rows[0].source == "" and rows[0].summary == ""
    assert rows[1].title == "T" and len(rows[1].summary) == 200 and rows[1].source == "s"
    assert A.adapt_articles(raw.limit(0)).count() == 0


def test_first_by_title_keeps_blanks_and_breaks_ties(spark):
    rows = spark.createDataFrame([(3, " A "), (1, "a"), (2, None), (4, ""), (1, "b")], "article_id long, title string")
    got = sorted((r.article_id, r.title) for r in A.first_by_title(rows, ["article_id"]).collect())
    assert got == sorted([(1, "a"), (1, "b"), (2, None), (4, "")], key=lambda x: (x[0], x[1] or ""))


def test_scalars(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first().v

    lit = F.lit
    assert value(T.collapse_ws(lit("  Hello \x1c   World "))) == "Hello World"
    assert value(T.collapse_ws(lit(None).cast("string"))) == ""
    assert value(T.dehyphenate(lit("de-\ntects LI-ION"))) == "detects LI-ION"
    assert value(T.clean_zone(lit("INFOID:123\nA\nEVB\nTorque it.\nEVB-88\n\n\n\nRevision: 2014 June\nend"), lit("EVB"))) == "Torque it.\n\nend"
    assert value(T.title_case(lit("mercedes-BENZ 3er"))) == "Mercedes-Benz 3Er"
    assert value(T.last_of_srcset(lit("a 1w, b 2w ,"))) == "b" and value(T.last_of_srcset(lit(" , "))) is None
    assert value(T.is_english(lit("Привет"))) is False and value(T.is_english(lit(""))) is False and value(T.is_english(lit("Das Auto läuft"))) is True
    assert value(T.code_of(lit(" p0a-0d* "))) == "P0A0D" and value(T.code_of(lit("TORQUE"))) is None
    assert value(T.image_candidate(lit(""), lit(None).cast("string"), lit("x 1w, y 2w"), lit(""), lit("z"))) == "x 1w, y 2w"
    assert value(T.list_part_numbers(lit("AEV6804A-B nodigits"), lit("x"))) == ["AEV6804A-B"]
    assert value(T.list_part_numbers(lit("P1570 AEV6804A"), lit("things"))) == []
    assert value(T.list_part_numbers(lit("AEV6804A"), lit("Faults"))) == ["AEV6804A"]
    assert value(T.canonical_stem(lit(" "), lit(None).cast("string"), lit(None).cast("string"), lit(""), lit("My File"))) == "my file"


def test_web_fetch(spark):
    from faultlake.sources import web

    urls = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "page_id long, url string")
    got = web.fetch(urls, delay=0, get=lambda u: "<p>x" if u == "a" else None)
    assert [r.page_id for r in web.fetched(got).collect()] == [1]
