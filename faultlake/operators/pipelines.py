"""The three ways from raw relations to results: the index of a manual, its records, and the articles of a site.

Tables may hold any number of manuals: ``doc`` and ``page`` are part of every key, so a manual is never one task. What is used more than once is
staged, so no plan holds another one twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultlake.functions import text as T
from faultlake.operators import articles as A
from faultlake.operators import dtc_index as I
from faultlake.operators import pages as P
from faultlake.session import stage
from faultlake.sources import html, web

def _with_page(table: DataFrame) -> DataFrame:
    return table.withColumn("page_id", F.struct("doc", "page"))


def _by_page(table: DataFrame) -> DataFrame:
    return _with_page(table).drop("doc", "page")


def build_index(pages: DataFrame, blocks: DataFrame, tables: DataFrame, words: DataFrame, links: DataFrame, toc: DataFrame) -> DataFrame:
    """(doc, code, page, page_ref, title, seq): the pages every fault code leads to, in the order of the index; a code and page come once.

    ``pages``: doc, page, text, footer; ``blocks``: doc, page, ord, text, y0, y1; ``tables``: doc, page, ord, x0, x1, y0, rows;
    ``words``: doc, page, ord, x0, y0, x1, y1, text; ``links``: doc, page, ord, lx0, ly0, lx1, ly1, target, dest; ``toc``: doc, page, title.
    Manuals whose bookmarks name an index are searched there only. A table with a column of codes is read row by row; other index
    pages, and pages that continue an index, are read from their words. Within a page the last mention of a code counts.
    """
    foot = stage(I.footer_map(pages.select("doc", "page", T.footer_ref(F.col("footer")).alias("page_ref"))))
    marked = I.bookmark_pages(toc)
    chosen = marked.select("doc").distinct().withColumn("_some", F.lit(True))
    open_ = (pages.where(I.mentions_index(F.col("text"))).select("doc", "page")
             .join(chosen, "doc", "left").join(marked.withColumn("_here", F.lit(True)), ["doc", "page"], "left").where("_some is null or _here").select("doc", "page"))
    heads = stage(I.heading_y(_by_page(blocks.join(open_, ["doc", "page"], "left_semi"))))
    headed = tables.withColumn("header", F.get("rows", F.lit(0))).where("size(rows) > 0")
    picked = I.choose_table(_by_page(headed), heads).join(_by_page(headed), ["page_id", "ord"])
    picked = stage(picked.withColumn("form", I.table_format(F.col("header"))).withColumn("doc", F.col("page_id.doc")).withColumn("table_id", F.col("page_id.page")))
    refs = I.link_texts(_by_page(links).select("page_id", F.col("ord").alias("link_ord"), "lx0", "ly0", "lx1", "ly1"), _by_page(words))
    linked = stage(_by_page(links).join(refs.select("page_id", F.col("link_ord").alias("ord"), F.col("ref_text").alias("link_ref")), ["page_id", "ord"], "left"))

    # tables with a column of codes
    column = I.reference_column(F.col("header"))
    rows = picked.where("form = 'A'").select("doc", "table_id", column.alias("_c"), F.posexplode(F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0)))).alias("row_no", "cells"))
    cell = lambda j: T.trim_ws(F.coalesce(F.get("cells", j), F.lit("")))
    rows = rows.select("doc", "table_id", F.col("row_no").cast("long").alias("row_no"), T.code_of(cell(F.lit(0))).alias("code"), T.without_code_echo(cell(F.lit(1))).alias("title"), cell(F.col("_c")).alias("_ref")).where("code is not null")
    rows = rows.withColumn("has_ref", F.col("_ref") != "").withColumn("ref", T.ref_in(F.col("_ref")))
    zone = linked.join(picked.where("form = 'A'").select("page_id", "doc", "table_id", "x0", "x1"), "page_id").where(I.in_reference_zone(F.col("lx0"), F.col("x0"), F.col("x1")))
    zone = zone.select("doc", "table_id", F.col("ly0").alias("y0"), "ord", "link_ref", F.col("target").cast("int").alias("link_page"), F.coalesce("dest", F.col("target").cast("string")).alias("dest"))
    merged = I.merge_groups_with_links(rows.select("doc", "table_id", "row_no", "code", "has_ref", "ref"), zone, foot)
    of_tables = merged.join(rows.select("doc", "table_id", "row_no", "title"), ["doc", "table_id", "row_no"]).select(
        "doc", F.col("table_id").alias("at"), F.col("row_no").alias("n"), "code", "page", F.col("ref").alias("page_ref"), "title")

    # everything else from words: pages in the other form, without a table, and pages that continue an index
    form = heads.join(picked.select("page_id", "form", F.col("y0").alias("table_y")), "page_id", "left").select("page_id", F.coalesce("form", F.lit("A")).alias("form"), F.coalesce("table_y", "y").alias("min_y"), F.col("form").isNotNull().alias("has_table"))
    found = stage(I.codes_with_y(_by_page(words)).withColumn("form", F.lit("A")).union(I.codes_with_y(_by_page(words), form="B").withColumn("form", F.lit("B"))))
    coded = found.select("page_id").distinct().withColumn("has_codes", F.lit(True))
    runs = stage(I.index_runs(_with_page(pages.select("doc", "page")).join(form.select("page_id", F.lit(True).alias("has_heading")), "page_id", "left").join(coded, "page_id", "left")
                        .select("doc", "page", F.coalesce("has_heading", F.lit(False)).alias("has_heading"), F.coalesce("has_codes", F.lit(False)).alias("has_codes"))))
    first = runs.groupBy("doc", "run").agg(F.min("page").alias("first"))
    lead = first.select("doc", "run", F.struct("doc", F.col("first").alias("page")).alias("lead"))
    places = _with_page(runs.join(lead, ["doc", "run"]).join(form.withColumnRenamed("page_id", "lead"), "lead"))
    places = places.where(~((F.col("page_id") == F.col("lead")) & (F.col("form") == "A") & F.col("has_table"))).select("page_id", "form", F.when(F.col("page_id") == F.col("lead"), F.col("min_y")).otherwise(-1e9).alias("min_y"))
    seen = stage(found.join(places, ["page_id", "form"]).where("y >= min_y"))
    lines = I.visual_rows(seen.select("page_id", "ord", F.col("y").alias("y0")), "page_id")
    lined = stage(seen.join(lines, ["page_id", "ord"]))
    row = stage(lined.groupBy("page_id", "row_no").agg(F.min(F.struct("y", "ord", "ref")).alias("f")).select("page_id", F.col("row_no").alias("code"), F.col("f.y").alias("y"), F.col("f.ref").alias("ref")))
    near = I.nearest_link(row.select("page_id", "code", "y"), linked.select("page_id", "ord", ((F.col("ly0") + F.col("ly1")) / 2).alias("mid"), F.struct(F.col("target").cast("int").alias("page"), "link_ref").alias("target")))
    ready = near.join(row.select("page_id", "code", "ref"), ["page_id", "code"]).select(F.col("page_id.doc").alias("doc"), "page_id", F.col("code").alias("row_no"), "ref", F.col("target.link_ref").alias("link_ref"), F.col("target.page").alias("link_page"))
    resolved = I.resolve_page(ready, foot, drop_unresolved=False).where("page is not null")
    # the printed reference names the page where it led there, else the link's
    by_print = F.col("ref").isNotNull() & (F.col("link_page").isNull() | (F.col("page") != F.col("link_page")))
    of_words = lined.join(resolved.select("page_id", "row_no", "page", F.when(by_print, F.col("ref")).otherwise(F.col("link_ref")).alias("page_ref")), ["page_id", "row_no"]).select(
        F.col("page_id.doc").alias("doc"), F.col("page_id.page").alias("at"), F.col("ord").alias("n"), "code", "page", "page_ref", "title")
    last = of_tables.union(of_words).groupBy("doc", "at", "code").agg(F.max(F.struct("n", "page", "page_ref", "title")).alias("l")).select("doc", "at", "code", "l.*")
    once = last.groupBy("doc", "code", "page").agg(F.min(F.struct("at", "n", "page_ref", "title")).alias("f"))
    return stage(once.select("doc", "code", "page", "f.page_ref", "f.title", F.struct("f.at", "f.n").alias("seq")))


def extract_records(index: DataFrame, pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per record: what an index page leads to, cut where the type of the manual changes.

    (doc, document_id, record_id, record_no, codes, title, manual_type, start_page, end_page, page_refs, section_code, page_ref_confidence, warning).
    ``index`` as of ``build_index``; ``pages``: doc, page, header, footer, type_heading; ``documents``: doc, document_id.
    A record goes on while the header names one of its codes, within one section prefix; after a change of type it goes on as a record of its own.
    """
    typed = stage(P.fill_types(pages).withColumn("_ref", T.footer_ref(F.col("footer"))).withColumn("prefix", F.regexp_extract(F.coalesce("_ref", F.lit("")), "^([A-Z]{1,4})-", 1)).withColumn("prefix", T.none_if_blank(F.col("prefix"))))
    by_page = stage(I.codes_by_page(index))
    titles = I.pages_by_code(index).select("doc", "code", "title")
    named = by_page.select("doc", F.col("page").alias("start"), F.posexplode("codes").alias("k", "code")).join(titles, ["doc", "code"])
    title = named.groupBy("doc", "start").agg(F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("k", "title"))), lambda x: x["title"]).alias("t"))
    title = title.select("doc", "start", I.record_title(F.col("t"), F.col("n")).alias("title"))
    # runs are found without regard to types first, then cut where the type changes
    starts = by_page.select("doc", F.col("page").alias("start_page"), "codes").join(typed.select("doc", F.col("page").alias("start_page"), "prefix"), ["doc", "start_page"], "left").withColumn("type", F.lit(None).cast("string"))
    runs = P.record_runs(starts, typed.select("doc", "page", "header", "prefix", F.lit(None).cast("string").alias("type")))
    covered = runs.withColumn("page", F.explode(F.sequence("start_page", "end_page"))).join(typed.select("doc", "page", F.col("manual_type").alias("type")), ["doc", "page"], "left")
    parts = stage(P.type_segments(covered.select("doc", F.col("start_page").alias("record"), "page", "type")))
    full = parts.join(by_page.select("doc", F.col("page").alias("record"), "codes", F.col("page_ref").alias("expected_ref")), ["doc", "record"]).join(title.withColumnRenamed("start", "record"), ["doc", "record"])
    first = full.join(typed.select("doc", F.col("page").alias("first_page"), "header", "footer", F.col("prefix").alias("section_code")), ["doc", "first_page"], "left")
    first = first.withColumn("expected_ref", F.when(F.col("first_page") == F.col("record"), F.col("expected_ref")))
    checked = P.page_codes_verified(first.withColumn("page", F.col("first_page")))
    printed = parts.join(typed.where("_ref is not null").select("doc", "page", "_ref"), "doc").where("page between first_page and last_page")
    refs = printed.groupBy("doc", "record", "segment", "_ref").agg(F.min("page").alias("p")).groupBy("doc", "record", "segment").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "_ref"))), lambda x: x["_ref"]).alias("page_refs"))
    made = stage(checked.join(refs, ["doc", "record", "segment"], "left").join(documents.select("doc", "document_id"), "doc"))
    order = made.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("record", "segment"))).alias("_all"))  # as many as a manual has records
    return made.join(order, "doc").select(
        "doc", "document_id", T.record_id(F.col("document_id"), F.col("type"), F.col("first_page")).alias("record_id"), F.array_position("_all", F.struct("record", "segment")).alias("record_no"), "codes", "title",
        F.col("type").alias("manual_type"), F.col("first_page").alias("start_page"), F.col("last_page").alias("end_page"), F.coalesce("page_refs", F.array().cast("array<string>")).alias("page_refs"), "section_code",
        F.col("confidence").alias("page_ref_confidence"), "warning")


def run_site(index_pages: DataFrame, get: Callable[[str], str | None], site: dict[str, str] | None = None, max_articles: int | None = None, delay: float = web.DELAY, output: str | None = None) -> DataFrame:
    """Adapted articles of a site: links of its index pages, each fetched once, parsed, one for each title, in the contract's shape.

    ``index_pages``: page_id (their order), url. Pages that cannot be fetched are left out. With ``output`` the articles are written there as JSON and read back.
    """
    css = {**html.SITE, **(site or {})}
    listed = html.index_links(web.fetched(web.fetch(index_pages, delay, get)), css["article"])
    urls = A.collect_urls(listed, max_articles, ["page_ord", "pos"])
    numbered = urls.select(F.xxhash64("url").alias("page_id"), "url", "page_ord", "pos")
    pages = web.fetched(web.fetch(numbered, delay, get))
    raw = html.parse_articles(pages, site).join(numbered.select("page_id", "page_ord", "pos"), "page_id")
    kept = A.first_by_title(raw, ["page_ord", "pos"])
    adapted = A.adapt_articles(kept.drop("page_id", "page_ord", "pos"))
    if output is None:
        return adapted
    adapted.write.mode("overwrite").json(output)
    return adapted.sparkSession.read.schema(adapted.schema).json(output)
