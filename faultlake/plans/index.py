"""Queries of the fault-code index operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultlake.operators import dtc_index as I
from faultlake.plans.derived import KEY, PAGE, ansi, cte, derived, run, words_by_page
from faultlake.session import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


@query("agg1_codes_by_page", cte("dtc_index") + """select c.doc, c.page, codes, page_ref from (select doc, page, list(code order by seq) as codes from (select doc, page, code, min(seq) as seq from dtc_index group by 1, 2, 3) group by 1, 2) c
 join (select doc, page, arg_min(page_ref, seq) filter (where page_ref is not null) as page_ref from dtc_index group by 1, 2) r on c.doc = r.doc and c.page = r.page""")
def agg1(spark, sf):
    return I.codes_by_page(derived(spark, sf, "dtc_index"))


@query("agg3_pages_by_code", cte("dtc_index") + """select doc, code, list(page order by seq) as pages, list(page_ref order by seq) as page_refs, arg_min(title, seq) as title
 from (select doc, code, page, min(seq) as seq, nullif(arg_min(coalesce(page_ref, ''), seq), '') as page_ref, arg_min(title, seq) as title from dtc_index group by 1, 2, 3) group by 1, 2""")
def agg3(spark, sf):
    return I.pages_by_code(derived(spark, sf, "dtc_index"))


@query("agg4_footer_map", cte("dtc_index") + "select doc, page_ref, max(page) as page from dtc_index where page_ref is not null group by 1, 2")
def agg4(spark, sf):
    return I.footer_map(derived(spark, sf, "dtc_index"))


@query("set5_index_union", cte("dtc_index") + "select doc, code, page, min(seq) as seq from dtc_index group by 1, 2, 3")
def set5(spark, sf):
    return I.union_of_pages(derived(spark, sf, "dtc_index"))


@query("agg10_titles", """select p_brand, case when n > 0 then nullif(array_to_string(list_transform(list_filter(generate_series(1, d), lambda k: true), lambda k: w[k]), ' '), '') end as title from (
 select p_brand, n, w, coalesce(list_max(list_filter(generate_series(1, len(w)), lambda k: len(list_filter(ws, lambda x: array_to_string(x[1:k], ' ') = array_to_string(w[1:k], ' '))) = len(ws))), 0) as d from (
 select p_brand, count(*) as n, list(string_split(p_name, ' ') order by p_partkey) as ws, list(string_split(p_name, ' ') order by p_partkey)[1] as w from part group by p_brand))""")
def agg10(spark, sf):
    p = table(spark, sf, "part").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: x["p_name"]).alias("t"))
    return p.select("p_brand", I.record_title(F.col("t"), F.lit(2)).alias("title"))


_SQUASH = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


@query("agg10b_title_prefixes", f"""select record_id, nullif(case when len(w) = 1 then w[1] || ' SIDE' else w[1] || ' ' || w[2] end, '') as title from (
 select record_id, string_split({_SQUASH.format(r"regexp_replace(title, '^[A-Z] ', '')")}, ' ') as w from (select distinct record_id, title from code_records where title is not null) where title <> '')""")
def agg10b(spark, sf):
    """Titles of two codes that share the first two words (all there is of shorter ones and a word of their own)."""
    r = table(spark, sf, "code_records").where("title is not null and title <> ''").select("record_id", "title").distinct()
    words = F.split(I.T.collapse_ws(F.regexp_replace("title", "^[A-Z] ", "")), " ")
    start = F.when(F.size(words) == 1, F.concat(F.get(words, 0), F.lit("  SIDE"))).otherwise(F.array_join(F.slice(words, 1, 2), " \t"))
    return r.select("record_id", I.record_title(F.array(F.concat(F.lit("A "), start, F.lit(" LEFT ")), F.concat(F.lit("B "), start, F.lit("  RIGHT"))), F.lit(2)).alias("title"))


_NEAR = """select r.page_id, r.code, r.y, m.target from code_rows r left join (select c.page_id, c.code, c.y, arg_min(l.target, (abs(l.mid - c.y), l.ord)) as target
 from code_rows c join links l on c.page_id = l.page_id and abs(l.mid - c.y) <= 20 group by 1, 2, 3) m on r.page_id = m.page_id and r.code = m.code and r.y = m.y"""


@query("jn1_nearest_link", cte("links", "code_rows") + _NEAR)
def jn1(spark, sf):
    return I.nearest_link(derived(spark, sf, "code_rows"), derived(spark, sf, "links"))


_MATCH = """matches as (select doc, seq, page_ref as ref, case when seq % 4 = 0 then null when seq % 4 = 1 then lower(page_ref) else 'EVB-' || cast(seq % 600 as varchar(9)) end as link_ref,
 case when seq % 11 = 0 then null else cast(seq % 700 as int) end as link_page from dtc_index)"""
_FOOT = "foot as (select doc as fdoc, page_ref, max(page) as page from dtc_index where page_ref is not null and page % 3 > 0 group by 1, 2)"
_RESOLVE = """select doc, seq, ref, link_ref, link_page, case when link_page is null then page when ref is not null and link_ref is not null and upper(ref) <> upper(link_ref) then coalesce(page, {keep}) else link_page end as page
 from matches left join foot on doc = fdoc and page_ref = ref"""


def _matches(spark, sf):
    ix = derived(spark, sf, "dtc_index")
    m = ix.select("doc", "seq", F.col("page_ref").alias("ref"), F.expr("case when seq % 4 = 0 then null when seq % 4 = 1 then lower(page_ref) else 'EVB-' || cast(seq % 600 as string) end as link_ref"),
                  F.expr("case when seq % 11 = 0 then null else cast(seq % 700 as int) end as link_page"))
    return m, I.footer_map(ix.where("page % 3 > 0"))


@query("jn2_footer_fallback", cte("dtc_index") + ", " + _MATCH + ", " + _FOOT + " " + _RESOLVE.format(keep="link_page"))
def jn2(spark, sf):
    return I.resolve_page(*_matches(spark, sf), drop_unresolved=False)


@query("jn2b_footer_fallback_drop", cte("dtc_index") + ", " + _MATCH + ", " + _FOOT + " " + _RESOLVE.format(keep="null"))
def jn2b(spark, sf):
    return I.resolve_page(*_matches(spark, sf), drop_unresolved=True)


#: Forty orders make one index table, 500 a manual.
def _table(key: str) -> tuple[str, str]:
    return f"cast({key} div 10000000000 div 500 as int) as doc", f"cast({key} div 400000000000 as int) as table_id"


@query("jn3_group_link_merge")
def jn3(spark, sf):
    """Index rows of each page against its links in order; the fold has no SQL form and is tested by brute force."""
    rows = derived(spark, sf, "dtc_index").drop("doc").selectExpr("*", *_table("seq")).select("doc", "table_id", F.col("seq").alias("row_no"), "code", (F.col("seq") % 3 == 0).alias("has_ref"),
                                                   F.when(F.col("seq") % 3 == 0, F.concat(F.lit("EVB-"), (F.col("seq") % 500).cast("string"))).alias("ref"))
    links = derived(spark, sf, "links").selectExpr("*", *_table("ord")).select("doc", "table_id", F.col("mid").alias("y0"), "ord", F.concat(F.lit("evb-"), (F.col("ord") % 500).cast("string")).alias("link_ref"),
                                               (F.col("target") % 90 + 1).cast("int").alias("link_page"), F.col("target").cast("string").alias("dest"))
    foot = I.footer_map(derived(spark, sf, "dtc_index").where("page % 3 > 0"))
    return I.merge_groups_with_links(rows, links, foot)


@query("win2_carried_references", cte("dtc_index") + """select tbl, row_no, grp_ref as group_ref, grp_page as group_page, code from (select *, max(ref) over (partition by tbl, grp) as grp_ref, max(case when ref is not null then page end) over (partition by tbl, grp) as grp_page
 from (select *, count(ref) over (partition by tbl order by row_no rows between unbounded preceding and current row) as grp from (select seq // 150000000000 as tbl, seq as row_no, code, page, case when seq % 5 < 2 then page_ref end as ref from dtc_index))) where grp > 0 and grp_page is not null""")
def win2(spark, sf):
    rows = derived(spark, sf, "dtc_index").select(F.expr("seq div 150000000000 as tbl"), F.col("seq").alias("row_no"), "code", "page", F.expr("case when seq % 5 < 2 then page_ref end as ref"))
    return I.carry_reference(rows, "tbl", "row_no").select("tbl", "row_no", "group_ref", "group_page", "code")


@query("win6_visual_rows")
def win6(spark, sf):
    """Anchor clustering of words into rows; tested by brute force."""
    return I.visual_rows(derived(spark, sf, "words"), "page_id")


@query("win7_blocks", cte("links") + """select page_id, ord, sum(j) over (partition by page_id order by mid, ord rows between unbounded preceding and current row) as block from (
 select *, case when mid - lag(mid) over (partition by page_id order by mid, ord) > 40 then 1 else 0 end as j from links)""")
def win7(spark, sf):
    return I.blocks_by_gap(derived(spark, sf, "links"), "page_id", "mid", ["mid", "ord"]).select("page_id", "ord", "block")


@query("win17_index_runs", cte("pages_seq") + """select doc, page, run from (select *, max(case when not has_codes and not has_heading then 1 else 0 end) over (partition by doc, run order by page rows between unbounded preceding and current row) as gap
 from (select *, sum(cast(has_heading as int)) over (partition by doc order by page rows between unbounded preceding and current row) as run from pages_seq) where run > 0) where gap = 0""")
def win17(spark, sf):
    return I.index_runs(derived(spark, sf, "pages_seq"))


@query("flt4_index_pages", "select doc_id from documents where " + " or ".join(f"contains(lower(text || case when doc_id % 9 = 0 then ' DTC Index' else '' end), '{h}')" for h in I.HEADINGS))
def flt4(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(I.mentions_index(F.concat("text", F.expr("case when doc_id % 9 = 0 then ' DTC Index' else '' end")))).select("doc_id")


_BLOCKS = f"""select {PAGE} as page_id, {KEY} as ord, l_quantity as y0, l_quantity + 12 as y1,
 case when l_partkey % 40 = 0 then '  DTC Index ' || chr(10) || 'x' when l_partkey % 40 = 1 then 'DTC and Display Item' when l_partkey % 40 = 2 then 'dtc only' else 'block' end as text from {{lineitem}}"""
_HIT = """select page_id, arg_min(y, (rank, ord)) as y from (select page_id, ord, case when trim(split_part(lower(trim(text)), chr(10), 1)) = 'dtc index' then 0 when contains(lower(text), 'dtc') and contains(lower(text), 'display item') then 1 end as rank,
 case when trim(split_part(lower(trim(text)), chr(10), 1)) = 'dtc index' then y1 else y0 end as y from blocks) where rank is not null group by page_id"""


@query("flt5_heading_y", "with blocks as (" + ansi(_BLOCKS) + ") " + _HIT)
def flt5(spark, sf):
    return I.heading_y(run(spark, sf, _BLOCKS))


@query("flt6_index_table", "with blocks as (" + ansi(_BLOCKS) + "), hits as (" + _HIT + f"""), tabs as (select {ansi(PAGE)} as page_id, {KEY} as ord, l_quantity as y0,
 case l_suppkey % 4 when 0 then 'reference' when 1 then 'action' when 2 then 'item' else 'malfunction' end as h from lineitem)
 select page_id, coalesce(r, case when not regexp_matches(fh, 'description|action|malfunction|factor') then f end) as ord from (
 select t.page_id, min(case when h = 'reference' then ord end) as r, arg_min(h, ord) as fh, min(ord) as f from tabs t join hits on t.page_id = hits.page_id where y0 >= y group by 1) where r is not null or not regexp_matches(fh, 'description|action|malfunction|factor')""")
def flt6(spark, sf):
    li = table(spark, sf, "lineitem")
    tabs = li.select(F.expr(f"{PAGE} as page_id"), F.expr(KEY + " as ord"), F.col("l_quantity").alias("y0"),
                                               F.expr("array('DTC', case l_suppkey % 4 when 0 then 'Reference' when 1 then 'Action' when 2 then 'Item' else 'Malfunction' end) as header"))
    return I.choose_table(tabs, I.heading_y(run(spark, sf, _BLOCKS)))


@query("flt7_table_format", "select distinct record_id, x.table_id as table_id, case when len(list_filter(x.raw_rows[1], lambda c: contains(lower(coalesce(c, '')), 'code'))) > 0 then 'A' else 'B' end as format, cast(case when coalesce(list_position(list_transform(x.raw_rows[1], lambda c: contains(lower(coalesce(c, '')), 'trigger')), true), 0) > 0 then list_position(list_transform(x.raw_rows[1], lambda c: contains(lower(coalesce(c, '')), 'trigger')), true) - 1 else len(x.raw_rows[1]) - 1 end as integer) as ref_col from (select record_id, unnest(tables) as x from dtc_records) where len(x.raw_rows) > 0")
def flt7(spark, sf):
    t = table(spark, sf, "dtc_records").select("record_id", F.explode("tables").alias("x")).where("size(x.raw_rows) > 0")
    header = F.transform(F.get("x.raw_rows", F.lit(0)), lambda c: F.replace(F.replace(F.lower(c), F.lit("code"), F.lit("dtc")), F.lit("trigger"), F.lit("reference")))
    return t.select("record_id", "x.table_id", I.table_format(header).alias("format"), I.reference_column(header).alias("ref_col")).distinct()


@query("flt9_reference_zone", cte("words") + "select page_id, ord from words where x0 >= 50.0 + (450.0 - 50.0) * 0.60")
def flt9(spark, sf):
    return derived(spark, sf, "words").where(I.in_reference_zone(F.col("x0"), F.lit(50.0), F.lit(450.0))).select("page_id", "ord")


_CODEWORDS = """select page_id, ord, x0, x1, y0, y1, case when ord % 20 = 10 then 'P0A' || cast(ord % 9 as varchar(9)) || 'D' when ord % 3 = 0 then 'EVB-' || cast(ord % 99 as varchar(9)) when ord % 7 = 0 then '12' when ord % 11 = 0 then '•' else text end as text from words"""


@query("fn22_codes_with_y")
def fn22(spark, sf):
    """Codes with titles and references from positioned words; the fold over each line is tested by brute force."""
    w = derived(spark, sf, "words")
    return I.codes_with_y(spark.sql(_CODEWORDS.replace("from words", "from {words}"), words=w))


@query("jn13_bookmarks", "select distinct o_orderkey // 500 as doc, cast(o_orderkey % 90 as int) as page from orders where o_orderkey % 6 = 0")
def jn13(spark, sf):
    toc = table(spark, sf, "orders").select(F.expr("o_orderkey div 500 as doc"), F.expr("cast(o_orderkey % 90 as int) as page"), F.expr("case when o_orderkey % 6 = 0 then 'BRC DTC Index' when o_orderkey % 6 = 1 then 'Self-diagnosis results' else 'Other' end as title"))
    return I.bookmark_pages(toc)


@query("jn15_link_texts", cte("words", "links") + r"""select page_id, link_ord, regexp_extract(t, '(?i)[A-Z]{2,10}-\d+', 0) as ref_text from (select l.page_id, l.link_ord, string_agg(w.text, ' ' order by w.ord) as t
 from (select page_id, ord as link_ord, mid % 400 as lx0, mid % 400 + 60 as lx1, mid % 150 as ly0, mid % 150 + 12 as ly1 from links) l join (select page_id, ord, x0, x1, y0, y1, 'EVB-' || cast(ord % 90 as varchar) as text from words) w
 on l.page_id = w.page_id and w.x1 > lx0 and w.x0 < lx1 and w.y1 > ly0 and w.y0 < ly1 group by 1, 2) where regexp_matches(t, '(?i)[A-Z]{2,10}-\d+')""")
def jn15(spark, sf):
    links = derived(spark, sf, "links").select("page_id", F.col("ord").alias("link_ord"), *(F.expr(f"mid % {m} + {a} as {n}") for n, m, a in (("lx0", 400, 0), ("lx1", 400, 60), ("ly0", 150, 0), ("ly1", 150, 12))))
    words = derived(spark, sf, "words").withColumn("text", F.concat(F.lit("EVB-"), (F.col("ord") % 90).cast("string")))
    return I.link_texts(links, words)


@query("jn20_row_words", cte("words") + "select a.page_id, a.ord, count(*) as n from words a join words b on a.page_id = b.page_id and abs(b.y0 - a.y0) < 3 and b.x0 > a.x1 group by 1, 2")
def jn20(spark, sf):
    return I.words_right(words_by_page(spark, sf), together=True)


@query("flt11_page_belongs", "select distinct record_id, len(list_filter(codes, lambda c: contains(upper(substr(t, 1, 300)), upper(c)))) > 0 as belongs from (select record_id, codes, coalesce(title, '') || coalesce(codes[1], '') as t from dtc_records where codes is not null)")
def flt11(spark, sf):
    r = table(spark, sf, "dtc_records").where("codes is not null")
    t = F.upper(F.substring(F.concat(F.coalesce("title", F.lit("")), F.coalesce(F.get("codes", F.lit(0)), F.lit(""))), 1, 300))
    return r.select("record_id", F.coalesce(F.exists("codes", lambda c: F.contains(t, F.upper(c))), F.lit(False)).alias("belongs")).distinct()


@query("agg22_any_link", cte("links") + "select page_id, count(*) > 0 as any_link from links group by page_id")
def agg22(spark, sf):
    return derived(spark, sf, "links").groupBy("page_id").agg((F.count("*") > 0).alias("any_link"))


@query("jn6_index_pages", cte("dtc_index", "pages_seq") + "select p.doc, p.page, i.n from pages_seq p join (select doc, page, count(distinct code) as n from dtc_index group by 1, 2) i on p.doc = i.doc and p.page = i.page")
def jn6(spark, sf):
    i = I.codes_by_page(derived(spark, sf, "dtc_index")).select("doc", "page", F.size("codes").cast("long").alias("n"))
    return derived(spark, sf, "pages_seq").join(i, ["doc", "page"]).select("doc", "page", "n")
