"""Queries of scalar functions, article operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultlake.functions import text as T
from faultlake.operators import articles as A
from faultlake.session import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))


_LINES = "lines as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as ord from documents)"
_DEDUP = "arts as (select * from articles where article_id is not null qualify row_number() over (partition by article_id order by fetched_at) = 1)"


@query("fn1_clean_text", r"select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as clean from documents")
def fn1(spark, sf):
    return _docs(spark, sf).select("doc_id", T.collapse_ws(F.col("text")).alias("clean"))


@query("flt24_english", r"""select doc_id, regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])(the|and|is|are|in|on|for|with|that|this|it)($|[^\p{L}\p{N}_])')
 or (length(regexp_replace(text, '\P{L}', '', 'g')) > 0 and length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / length(regexp_replace(text, '\P{L}', '', 'g')) > 0.8) as english from documents""")
def flt24(spark, sf):
    return _docs(spark, sf).select("doc_id", T.is_english(F.col("text")).alias("english"))


@query("flt14_noise_lines", rf"""with {_LINES} select doc_id, cast(ord as integer) as ord from lines where
 regexp_matches(trim(line), '^(?i)Revision:\s+') or regexp_matches(trim(line), '^[A-Z]{{1,4}}-\d+[A-Z]?$') or regexp_matches(trim(line), '^[PBCU][0-9A-F]{{4}}\s+[A-Z][A-Z\s]*$')
 or regexp_matches(trim(line), '^\d{{4}}\s+[A-Z][A-Z\s]*$') or regexp_matches(trim(line), '^(?i)<\s*DTC/CIRCUIT DIAGNOSIS\s*>$')""")
def flt14(spark, sf):
    return _lines(spark, sf).where(T.is_noise(F.col("line"))).select("doc_id", "ord")


@query("fn9_page_refs", rf"""with {_LINES} select doc_id, cast(ord as integer) as ord, ref from (select *, regexp_extract(line, '\b([A-Z]{{1,4}}-\d+[A-Z]?)\b', 1) as ref from lines) where ref <> ''""")
def fn9(spark, sf):
    return _lines(spark, sf).select("doc_id", "ord", T.footer_ref(F.col("line")).alias("ref")).where("ref is not null")


@query("fn2_zone_text")
def fn2(spark, sf):
    return _docs(spark, sf).select("doc_id", T.clean_zone(F.col("text"), F.lit("EVB")).alias("clean"))


@query("fn3_dehyphenate", r"select doc_id, regexp_replace(text, '([\p{L}\p{N}_]+)-\n([A-Za-z])', '\1\2', 'g') as clean from documents")
def fn3(spark, sf):
    return _docs(spark, sf).select("doc_id", T.dehyphenate(F.col("text")).alias("clean"))


@query("fn6_headings", "select section_id, heading, lower(trim(regexp_replace(heading, '\\s+', ' ', 'g'))) as key, count(*) as n from (select unnest(sections, recursive := true) from dtc_records) where heading is not null group by 1, 2, 3")
def fn6(spark, sf):
    s = table(spark, sf, "dtc_records").select(F.explode("sections").alias("s")).where("s.heading is not null")
    return s.groupBy("s.section_id", "s.heading", T.normal_heading(F.col("s.heading")).alias("key")).agg(F.count("*").alias("n"))


@query("fn7_slug", "select distinct o_orderpriority, trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') as slug from orders")
def fn7(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority", T.slug(F.col("o_orderpriority")).alias("slug")).distinct()


@query("fn8_stem", r"""select document_id, loaded_at, coalesce(nullif(concat_ws('_', nullif(s(vehicle.make), ''), nullif(s(vehicle.model), ''), nullif(s(vehicle.year), ''), nullif(s(section.code[1]), '')), ''),
 lower(regexp_replace(source_file, '\.[^.]*$', ''))) as stem from manuals""".replace("s(vehicle.make)", "trim(regexp_replace(lower(coalesce(vehicle.make, '')), '[^a-z0-9]+', '_', 'g'), '_')")
       .replace("s(vehicle.model)", "trim(regexp_replace(lower(coalesce(vehicle.model, '')), '[^a-z0-9]+', '_', 'g'), '_')").replace("s(vehicle.year)", "trim(regexp_replace(lower(coalesce(vehicle.year, '')), '[^a-z0-9]+', '_', 'g'), '_')")
       .replace("s(section.code[1])", "trim(regexp_replace(lower(coalesce(section.code[1], '')), '[^a-z0-9]+', '_', 'g'), '_')"))
def fn8(spark, sf):
    return table(spark, sf, "manuals").select("document_id", "loaded_at", T.canonical_stem(
        F.col("vehicle.make"), F.col("vehicle.model"), F.col("vehicle.year"), F.get("section.code", F.lit(0)), F.regexp_replace("source_file", r"\.[^.]*$", "")).alias("stem"))


@query("fn10_record_id", "select distinct record_id, substr(sha256(concat(document_id, coalesce(manual_type, ''), cast(location.start_pdf_page as varchar))), 1, 16) as made from dtc_records where location.start_pdf_page is not null and document_id is not null")
def fn10(spark, sf):
    r = table(spark, sf, "dtc_records").where("location.start_pdf_page is not null and document_id is not null")
    return r.select("record_id", T.record_id(F.col("document_id"), F.col("manual_type"), F.col("location.start_pdf_page")).alias("made")).distinct()


@query("fn11_md5", "select doc_id, md5(text) as digest from documents")
def fn11(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5("text").alias("digest"))


@query("fn14_title_case", "select p_partkey, array_to_string(list_transform(regexp_extract_all(p_name, '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), '') as title from part")
def fn14(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.title_case(F.col("p_name")).alias("title"))


@query("flt8_codes", "select record_id, code, regexp_matches(regexp_replace(upper(code), '[^A-Z0-9]', '', 'g'), '^[PBCU][0-9A-F]{4}$') as ok from (select record_id, unnest(codes) as code from dtc_records)")
def flt8(spark, sf):
    c = table(spark, sf, "dtc_records").select("record_id", F.explode("codes").alias("code"))
    return c.select("record_id", "code", T.code_of(F.col("code")).isNotNull().alias("ok"))


@query("fn21_code_echo", r"select record_id, trim(regexp_replace('[P0A0D] ' || title || ' [U1000]', '\[[PBCU][0-9A-F]{4}\]', '', 'g')) as clean from code_records where title is not null")
def fn21(spark, sf):
    return table(spark, sf, "code_records").where("title is not null").select("record_id", T.without_code_echo(F.concat(F.lit("[P0A0D] "), "title", F.lit(" [U1000]"))).alias("clean"))


@query("fn17_oem_ids", r"select record_id, sec, regexp_extract(t, 'OCID:\d+|INFOID:\d+', 0) as oem from (select record_id, unnest(sections).section_id as sec, replace(unnest(sections).oem_content_id, 'OCID', 'INFOID') as t from dtc_records) where t is not null")
def fn17(spark, sf):
    s = table(spark, sf, "dtc_records").select("record_id", F.explode("sections").alias("s")).where("s.oem_content_id is not null")
    return s.select("record_id", F.col("s.section_id").alias("sec"), F.regexp_extract(F.replace("s.oem_content_id", F.lit("OCID"), F.lit("INFOID")), T.OEM_ID, 0).alias("oem"))


@query("fn23_srcset", r"select doc_id, regexp_extract(trim(list_filter(list_transform(string_split(text, ','), lambda x: trim(x, chr(32) || chr(10) || chr(9) || chr(13))), lambda x: x <> '')[-1]), '^\S+', 0) as last from documents where text <> ''")
def fn23(spark, sf):
    return _docs(spark, sf).where("text <> ''").select("doc_id", T.last_of_srcset(F.col("text")).alias("last"))


@query("fn25_fault_codes", rf"""with {_DEDUP} select article_id, list_transform(list_concat(regexp_extract_all(c, '\b[Pp]\d{{3,}}\b'), regexp_extract_all(c, '\b\d{{2}}[A-Za-z0-9]{{3,}}\b')), lambda x: upper(x)) as codes
 from (select article_id, list_reduce(list_prepend('', fault_codes), lambda a, b: a || ' ' || b) as c from arts where len(fault_codes) > 0)""")
def fn25(spark, sf):
    a = table(spark, sf, "articles").where("size(fault_codes) > 0").dropDuplicates(["article_id"])
    return a.select("article_id", T.list_fault_codes(F.array_join("fault_codes", " "), F.lit("Fault codes:")).alias("codes"))


@query("fn26_part_numbers", r"""select p_partkey, list_filter(regexp_extract_all(c, '[0-9A-Za-z-]{5,}'), lambda x: regexp_matches(x, '\d')) as parts
 from (select p_partkey, p_brand || '-' || cast(p_size as varchar) || ', ' || p_name || ' 1E100RMX' || cast(p_partkey as varchar) as c from part)""")
def fn26(spark, sf):
    items = F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string"), F.lit(", "), "p_name", F.lit(" 1E100RMX"), F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select("p_partkey", T.list_part_numbers(items, F.lit("Part numbers:")).alias("parts"))


@query("flt29_labels", rf"""with {_LINES} select distinct line, regexp_matches(lower(line), '\bfaults?\b|\berrors?\b|\bfault code\b|\berror code\b') as fault,
 regexp_matches(lower(line), 'part numbers?|part no\b|part#|part number') as part from lines""")
def flt29(spark, sf):
    return _lines(spark, sf).select("line", T.is_fault_label(F.col("line")).alias("fault"), T.is_part_label(F.col("line")).alias("part")).distinct()


@query("agg11_type_markers", r"select distinct doc_id, list_transform(regexp_extract_all(text || ' [Type 2] [TYPE 1]', '(?i)\[TYPE [A-Z0-9]+\]'), lambda x: upper(x)) as markers from documents")
def agg11(spark, sf):
    return _docs(spark, sf).select("doc_id", T.type_markers(F.concat("text", F.lit(" [Type 2] [TYPE 1]"))).alias("markers"))


@query("snk8_rendered_rows", "select distinct record_id, x.table_id as table_id, array_to_string(list_transform(x.raw_rows, lambda r: array_to_string(list_transform(r, lambda c: coalesce(c, '')), ' | ')), chr(10)) as rendered from (select record_id, unnest(tables) as x from dtc_records) where x.raw_rows is not null")
def snk8(spark, sf):
    t = table(spark, sf, "dtc_records").select("record_id", F.explode("tables").alias("x")).where("x.raw_rows is not null")
    return t.select("record_id", "x.table_id", T.render_rows(F.col("x.raw_rows")).alias("rendered")).distinct()


@query("fn4_clean_cells", r"""select distinct record_id, table_id, trim(regexp_replace(replace(regexp_replace(c, '([\p{L}\p{N}_]+)-\n([A-Za-z])', '\1\2', 'g'), chr(10), ' '), '\s+', ' ', 'g')) as cell
 from (select record_id, x.table_id as table_id, unnest(flatten(x.raw_rows)) as c from (select record_id, unnest(tables) as x from dtc_records)) where c is not null""")
def fn4(spark, sf):
    t = table(spark, sf, "dtc_records").select("record_id", F.explode("tables").alias("x")).select("record_id", "x.table_id", F.explode(F.flatten("x.raw_rows")).alias("c"))
    return t.where("c is not null").select("record_id", "table_id", T.clean_cell(F.col("c")).alias("cell")).distinct()


@query("fn5_normal_cells", r"select distinct record_id, array_to_string(list_transform(string_split(coalesce(title, ''), chr(10)), lambda p: trim(regexp_replace(p, '\s+', ' ', 'g'))), chr(10)) as cell from code_records")
def fn5(spark, sf):
    return table(spark, sf, "code_records").select("record_id", T.normal_cell(F.col("title")).alias("cell")).distinct()


# -- articles ------------------------------------------------------------------------------------------------

_TRIM = r"regexp_replace(coalesce({0}, ''), '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


@query("prj4_adapted_articles", f"""with {_DEDUP} select article_id, {_TRIM.format('title')} as title, substr({_TRIM.format('content')}, 1, 200) as summary, coalesce(images, []) as images,
 coalesce(categories, []) as categories, coalesce(tags, []) as tags, coalesce(published_date, '') as published_date, coalesce(source, '') as source from arts""")
def prj4(spark, sf):
    a = A.adapt_articles(table(spark, sf, "articles").dropDuplicates(["article_id"]))
    return a.select("article_id", "title", "summary", "images", "categories", "tags", "published_date", "source")


@query("set2_first_by_title", rf"""with {_DEDUP} select article_id from (select article_id, lower({_TRIM.format('title')}) as k from arts)
 qualify k = '' or row_number() over (partition by k order by article_id) = 1""")
def set2(spark, sf):
    return A.first_by_title(table(spark, sf, "articles").select("article_id", "title").distinct(), ["article_id"]).select("article_id")


#: Distinct members in order of first appearance; null counts as one.
_ORDERED = "list_transform(list_filter(generate_series(1, len({0})), lambda i: list_position(list_transform({0}, lambda y: coalesce(y, chr(0))), coalesce({0}[i], chr(0))) = i), lambda i: {0}[i])"


@query("flt26_categories", f"with {_DEDUP} select article_id, list_filter({_ORDERED.format('c')}, lambda x: not contains(lower(x), 'soft')) as kept from (select article_id, list_concat(categories, categories[1:1], [null]) as c from arts where categories is not null)")
def flt26(spark, sf):
    """The stored categories with the first of them again and a null, so that the distinct step has work; a null names no word and goes."""
    a = table(spark, sf, "articles").where("article_id is not null and categories is not null").dropDuplicates(["article_id"])
    repeated = F.concat("categories", F.slice("categories", 1, 1), F.array(F.lit(None).cast("string")))
    return a.select("article_id", A.without_word(repeated, "soft").alias("kept"))


@query("flt27_images", f"with {_DEDUP} select article_id, cast(len(list_distinct(list_filter(images, lambda u: not starts_with(u, 'data:')))) as integer) as n from arts where images is not null")
def flt27(spark, sf):
    return table(spark, sf, "articles").where("images is not null").dropDuplicates(["article_id"]).select("article_id", F.size(A.without_inline_images(F.col("images"))).alias("n"))


@query("flt25_english_paragraphs")
def flt25(spark, sf):
    d = _docs(spark, sf).select("doc_id", A.english_or_all(F.split("text", "\n\n")).alias("p"))
    return d.select("doc_id", F.array_join("p", "\n\n").alias("content"))


@query("set1_urls", f"""with {_DEDUP} select url, min(article_id) as article_id from (select article_id, regexp_replace(source, '[?].*$', '') as url from arts) where url <> '' group by url order by 2 limit 100""")
def set1(spark, sf):
    links = table(spark, sf, "articles").select("article_id", F.regexp_replace("source", "[?].*$", "").alias("url"))
    return A.collect_urls(links, 100, ["article_id"])  # the cap on collected URLs is the feature


@query("agg21_distinct_tags", f"with {_DEDUP} select tag, count(*) as n from (select article_id, unnest(list_distinct(tags)) as tag from arts) where tag is not null group by tag")
def agg21(spark, sf):
    t = table(spark, sf, "articles").dropDuplicates(["article_id"]).select("article_id", F.explode(F.array_distinct("tags")).alias("tag"))
    return t.where("tag is not null").groupBy("tag").agg(F.count("*").alias("n"))


@query("agg20_comments", f"with {_DEDUP} select article_id, coalesce(c.author, '') as author, c.text as text, coalesce(c.date, '') as date from (select article_id, unnest(comments) as c from arts) where coalesce(c.text, '') <> ''")
def agg20(spark, sf):
    a = table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"])
    return a.select("article_id", F.explode(A.comments_of(F.col("comments"))).alias("c")).select("article_id", "c.*")


def _pages(spark, sf, by_line: bool = False) -> DataFrame:
    """Articles as HTML pages with their whole content, to run the HTML source over whole tables.

    The content is one paragraph, or with ``by_line`` one for each line.
    """
    def esc(c):
        return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    a = table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"])
    tag = lambda name, values: F.array_join(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.concat(F.lit(f"<{name}>"), esc(v), F.lit(f"</{name}>"))), "")
    body = tag("p", F.split("content", "\n")) if by_line else F.concat(F.lit("<p>"), esc(F.col("content")), F.lit("</p>"))
    html = F.concat(F.lit("<html><body><h1>"), esc(F.col("title")), F.lit('</h1><div class="futurio-content single-content">'), body, F.lit("<p>Faults:<ul>"),
                    tag("li", F.col("fault_codes")), F.lit("</ul><p>Part numbers:</p><ul>"), tag("li", F.col("part_numbers")), F.lit('</ul></div><div class="tags-links">'), tag("a", F.col("tags")), F.lit("</div></body></html>"))
    return a.select(F.col("article_id").alias("page_id"), F.col("source").alias("url"), html.alias("html"))


@query("fn27_parsed_articles")
def fn27(spark, sf):
    from faultlake.sources import html

    return html.parse_articles(_pages(spark, sf, by_line=True)).select("page_id", "title", "content", "fault_codes", "part_numbers", "tags", F.size("images").alias("n_images"))


@query("src19_html_nodes", rf"""with {_DEDUP} select tag, sum(n) as n from (
 select 'li' as tag, coalesce(len(fault_codes), 0) + coalesce(len(part_numbers), 0) as n from arts union all select 'a', coalesce(len(tags), 0) from arts union all select 'h1', 1 from arts
 union all select 'ul', 2 from arts union all select 'p', 3 from arts union all select 'div', 2 from arts union all select 'body', 1 from arts union all select 'html', 1 from arts) where n > 0 group by tag""")
def src19(spark, sf):
    from faultlake.sources import html

    return html.html_nodes(_pages(spark, sf)).groupBy("tag").agg(F.count("*").alias("n"))


@query("jn17_list_labels", rf"with {_DEDUP} select article_id as page_id, unnest(['Faults:', 'Part numbers:']) as label from arts")
def jn17(spark, sf):
    from faultlake.sources import html

    nodes = html.html_nodes(_pages(spark, sf)).withColumn("text", F.substring_index("text", ":", 1))
    return A.preceding_label(nodes).select("page_id", F.concat(F.trim(F.element_at(F.split("label", "\n"), -1)), F.lit(":")).alias("label"))


@query("jn18_absolute_urls")
def jn18(spark, sf):
    a = table(spark, sf, "articles").dropDuplicates(["article_id"]).select("article_id", "source", F.explode("images").alias("href"))
    return a.select("article_id", T.absolute_url(F.col("source"), F.regexp_replace("href", "^https?://[^/]+", "")).alias("url"))


@query("fn24_image_candidates", f"""with {_DEDUP} select article_id, case when article_id % 4 = 0 then 'lazy-' || article_id when article_id % 4 = 1 then 'a.jpg 300w, b.jpg 900w' when article_id % 4 = 2 then 'l.jpg' when images[1] like 'data:image/svg+xml%' then null else nullif(images[1], '') end as address from arts""")
def fn24(spark, sf):
    a = table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"])
    k = F.col("article_id") % 4
    return a.select("article_id", T.image_candidate(F.when(k == 0, F.concat(F.lit("lazy-"), F.col("article_id").cast("string"))), F.lit(None).cast("string"), F.when(k == 1, "a.jpg 300w, b.jpg 900w"),
                                                    F.when(k == 2, "s.jpg 300w, l.jpg 900w"), F.get("images", F.lit(0))).alias("address"))


@query("src20_selected_nodes", f"with {_DEDUP} select article_id as page_id, cast(coalesce(len(tags), 0) as bigint) as n from arts where coalesce(len(tags), 0) > 0")
def src20(spark, sf):
    from faultlake.sources import html

    return html.select(_pages(spark, sf), "div.tags-links a").groupBy("page_id").agg(F.count("*").alias("n"))


@query("src21_index_links", f"with {_DEDUP} select article_id as page_ord, 'https://site.example/a/' || article_id as url from arts")
def src21(spark, sf):
    """Article links of index pages, made absolute against the site's base address."""
    from faultlake.sources import html

    p = table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"]).select(F.col("article_id").alias("page_id"), F.lit("https://site.example/").alias("url"), F.concat(
        F.lit('<a class="tpg-post-link" href="/a/'), F.col("article_id").cast("string"), F.lit('">x</a><a class="other" href="/b">y</a>')).alias("html"))
    return html.index_links(p).select("page_ord", "url")


@query("flt28_fetched_pages", f"with {_DEDUP} select article_id from arts where coalesce(content, '') <> ''")
def flt28(spark, sf):
    from faultlake.sources import web

    a = table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"]).withColumn("html", F.col("content"))
    return web.fetched(a).select("article_id")


@query("set4_category_union", f"with {_DEDUP} select article_id, cast(len(list_distinct(c)) + case when len(list_filter(c, lambda x: x is null)) > 0 then 1 else 0 end as integer) as n from (select article_id, list_concat(coalesce(categories, []), coalesce(tags, [])) as c from arts)")
def set4(spark, sf):
    """Categories and tags as one set; all nulls are one member."""
    none = F.array().cast("array<string>")
    both = F.concat(F.coalesce("categories", none), F.coalesce("tags", none))
    a = table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"])
    return a.select("article_id", F.size(F.array_distinct(both)).alias("n"))


@query("set7_header_footer_lines", f"with {_LINES} select doc_id, line from (select *, row_number() over (partition by doc_id order by ord) as a, row_number() over (partition by doc_id order by ord desc) as z from lines) where a <= 2 or z <= 3")
def set7(spark, sf):
    """First two and last three lines of each text, each place once."""
    d = _docs(spark, sf).withColumn("l", F.split("text", "\n"))
    n = F.size("l")
    places = F.array_distinct(F.concat(F.sequence(F.lit(1), F.least(n, F.lit(2))), F.sequence(F.greatest(n - 2, F.lit(1)), n)))
    return d.select("doc_id", F.explode(F.transform(places, lambda i: F.get(F.col("l"), i - 1))).alias("line"))


@query("lim3_tails", f"with {_LINES} select doc_id, list(line order by ord)[-3:] as tail from lines where trim(line) <> '' group by doc_id")
def lim3(spark, sf):
    kept = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    return _docs(spark, sf).select("doc_id", F.slice(kept, F.greatest(F.size(kept) - 2, F.lit(1)), 3).alias("tail")).where("size(tail) > 0")
