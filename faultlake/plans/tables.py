"""Queries of table operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultlake.operators import tables as X
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


def _tables(spark, sf):
    """Every table once, with its rows."""
    return (table(spark, sf, "dtc_records").dropDuplicates(["record_id"]).select("record_id", F.posexplode("tables").alias("pos", "x")).select("record_id", "pos", "x.*"))


_TABLES = "tabs as (select record_id, generate_subscripts(tables, 1) - 1 as pos, unnest(tables) as x from (select * from dtc_records where record_id is not null qualify row_number() over (partition by record_id order by loaded_at) = 1))"


@query("win4_merged_cells", cte("cells") + "select tbl, col, row, case when v <> '' and v = above then '' else v end as value from (select tbl, col, row, value as v, last_value(nullif(value, '') ignore nulls) over (partition by tbl, col order by row rows between unbounded preceding and 1 preceding) as above from cells)")
def win4(spark, sf):
    return X.clear_repeats(derived(spark, sf, "cells"))


@query("win3_fill_flags", cte("cells") + "select tbl, coalesce(bool_or(row > 1 and value = '' and up <> ''), false) as filled from (select *, lag(value) over (partition by tbl, col order by row) as up from cells) group by tbl")
def win3(spark, sf):
    return X.fill_down_flags(derived(spark, sf, "cells"))


_CELL = "lambda c: trim(coalesce(c, ''))"
_SUB = "len(list_filter(list_transform({0}, " + _CELL + "), lambda v: v <> '' and (regexp_full_match(v, '[A-Z][0-9A-Z]{{4}}') or regexp_full_match(v, '\\d+')))) = 0"


@query("flt23_subheaders", "with " + _TABLES + " select record_id, pos, " + _SUB.format("x.raw_rows[1]") + " as sub from tabs where len(x.raw_rows) > 0")
def flt23(spark, sf):
    return _tables(spark, sf).where("size(raw_rows) > 0").select("record_id", "pos", X.is_subheader(F.get("raw_rows", F.lit(0))).alias("sub"))


@query("win18_header_rows", "with " + _TABLES + ", h as (select record_id, pos, x.raw_rows as r, list_transform(x.raw_rows[1], " + _CELL + ") as a, list_transform(x.raw_rows[2], " + _CELL + ") as b from tabs where len(x.raw_rows) > 0) select record_id, pos, case when len(r) < 3 then 1 when not (" + _SUB.format("r[2]") + """) then 1
 when len(list_filter(generate_series(1, greatest(len(a), len(b))), lambda i: coalesce(a[i], '') = '' and coalesce(b[i], '') <> '')) > 0 then 2
 when len(list_filter(a, lambda v: not regexp_full_match(v, '[A-Za-z\\s]*'))) = 0 and len(list_filter(generate_series(1, greatest(len(a), len(b))), lambda i: coalesce(a[i], '') <> '' and coalesce(b[i], '') <> '')) > 0 then 2 else 1 end as n from h""")
def win18(spark, sf):
    return _tables(spark, sf).where("size(raw_rows) > 0").select("record_id", "pos", X.header_rows(F.col("raw_rows")).alias("n"))


@query("win19_partial", "with " + _TABLES + " select record_id, pos, coalesce(len(x.raw_rows) > 1 and " + _SUB.format("x.raw_rows[2]") + ", false) as partial from tabs where x.raw_rows is not null")
def win19(spark, sf):
    return _tables(spark, sf).where("raw_rows is not null").select("record_id", "pos", X.is_partial(F.col("raw_rows"), F.lit(1)).alias("partial"))


@query("flt21_blob_tables", "with " + _TABLES + " select record_id, pos, coalesce(len(x.raw_rows) > 1 and contains(x.raw_rows[1][1], chr(10)) and len(list_filter(x.raw_rows[1][2:], lambda c: coalesce(c, '') <> '')) = 0, false) as blob from tabs where x.raw_rows is not null")
def flt21(spark, sf):
    return _tables(spark, sf).where("raw_rows is not null").select("record_id", "pos", X.is_blob_start(F.col("raw_rows")).alias("blob"))


@query("flt22_blob_rows", "with " + _TABLES + " select record_id, pos, cast(len(list_filter(x.raw_rows, lambda r: coalesce(length(trim(r[1], ' ' || chr(10))) > 50 and contains(trim(r[1], ' ' || chr(10)), chr(10)) and len(list_filter(r[2:], lambda c: trim(coalesce(c, '')) <> '')) = 0, false))) as integer) as n from tabs where x.raw_rows is not null")
def flt22(spark, sf):
    return _tables(spark, sf).where("raw_rows is not null").select("record_id", "pos", F.size(F.filter("raw_rows", X.is_blob_row)).alias("n"))


@query("flt13_image_boxes", "with " + _TABLES + " select record_id, pos, len(list_filter(c, lambda v: v not in ('', '.') and not regexp_full_match(v, '[A-Z]{1,8}[0-9]{2,}[A-Z0-9]{0,8}'))) = 0 and len(list_filter(c, lambda v: regexp_full_match(v, '[A-Z]{1,8}[0-9]{2,}[A-Z0-9]{0,8}'))) > 0 as box from (select record_id, pos, list_transform(flatten(x.raw_rows), " + _CELL + ") as c from tabs where x.raw_rows is not null)")
def flt13(spark, sf):
    return _tables(spark, sf).where("raw_rows is not null").select("record_id", "pos", X.is_image_box(F.col("raw_rows")).alias("box"))


@query("flt18_side_tabs", "with " + _TABLES + " select record_id, pos, len(list_filter(list_transform(x.raw_rows, lambda r: coalesce(r[-1], '')), lambda v: v <> '' and not regexp_full_match(v, '[A-Z]{1,4}'))) = 0 as tabs from tabs where x.raw_rows is not null")
def flt18(spark, sf):
    t = _tables(spark, sf).where("raw_rows is not null")
    return t.select("record_id", "pos", X.only_side_tabs(F.transform("raw_rows", lambda r: F.coalesce(F.get(r, F.size(r) - 1), F.lit("")))).alias("tabs"))


@query("agg14_confidence", "with " + _TABLES + " select record_id, pos, case when list_has_any(coalesce(f, []), ['blob_row_detected', 'single_row_table', 'single_column_table']) then 'low' when list_has_any(coalesce(f, []), ['bbox_reconstruction_used', 'outer_column_recovered', 'bbox_clipped_by_drawings', 'wide_bbox_uncorrected']) or pos % 3 = 0 then 'medium' else 'high' end as confidence from (select record_id, pos, x.extraction.quality_flags as f from tabs)")
def agg14(spark, sf):
    return _tables(spark, sf).select("record_id", "pos", X.confidence(F.coalesce("extraction.quality_flags", F.array().cast("array<string>")), F.col("pos") % 3 == 0).alias("confidence"))


@query("agg18_fill_share", "with " + _TABLES + " select record_id, pos, share as filled_share, share >= 0.5 as accepted from (select record_id, pos, coalesce(len(list_filter(x.raw_rows, lambda r: len(list_filter(r, lambda c: coalesce(c, '') <> '')) >= greatest(1, len(r) // 2))), 0) / greatest(len(x.raw_rows), 1) as share from tabs where x.raw_rows is not null)")
def agg18(spark, sf):
    t = _tables(spark, sf).where("raw_rows is not null").select("record_id", "pos", F.col("raw_rows").alias("rows"))
    return X.fill_share(t).drop("rows")


@query("win5_continued_tables")
def win5(spark, sf):
    t = _tables(spark, sf).select(F.col("record_id").alias("record"), F.col("pos").alias("ord"), "table_id", "section_id", (F.col("start_pdf_page") + F.col("pos")).alias("page"),
                                  F.transform("raw_rows", lambda r: F.transform(r, lambda c: F.coalesce(c, F.lit("")))).alias("rows"))
    return X.continued_tables(t)


@query("jn16_table_sections", "with " + _TABLES + ", secs as (select record_id, s.section_id as section_id, min(s.heading) as heading, min(s.role) as role from (select record_id, unnest(sections) as s from dtc_records) group by 1, 2) select t.record_id, t.pos, heading, role from (select record_id, pos, x.section_id as section_id from tabs) t left join secs on t.record_id = secs.record_id and t.section_id = secs.section_id")
def jn16(spark, sf):
    secs = table(spark, sf, "dtc_records").select("record_id", F.explode("sections").alias("s")).groupBy("record_id", F.col("s.section_id").alias("section_id")).agg(F.min("s.heading").alias("heading"), F.min("s.role").alias("role"))
    return _tables(spark, sf).select("record_id", "pos", "section_id").join(secs, ["record_id", "section_id"], "left").select("record_id", "pos", "heading", "role")


_BOX = f"select {PAGE} as page_id, {KEY} as table_id, l_quantity * 5 as x0, l_quantity * 5 + cast(l_suppkey % 90 as double) as x1, cast(l_partkey % 300 as double) as y0, cast(l_partkey % 300 as double) + 40 as y1 from {{lineitem}}"
_ZONES = f"select {PAGE} as page_id, {KEY} as zone, l_quantity * 4 as zx0, l_quantity * 4 + 80 as zx1, cast(l_partkey % 300 as double) as zy0, cast(l_partkey % 300 as double) + 90 as zy1 from {{lineitem}}"
_RULES = f"select {PAGE} as page_id, {KEY} as rule, l_quantity * 4 as rx0, l_quantity * 4 + cast(l_suppkey % 60 as double) as rx1, cast(l_partkey % 300 as double) as ry0, cast(l_partkey % 300 as double) + cast(l_suppkey % 5 as double) as ry1, 250.0 as page_width, cast(l_suppkey % 4 as double) / 10 as darkness from {{lineitem}}"


def _with(**parts: str) -> str:
    return "with " + ", ".join(f"{k} as ({ansi(v)})" for k, v in parts.items()) + " "


def _geo(spark, sf, text):
    return run(spark, sf, text)


@query("jn9_zone_tables", _with(b=_BOX, z=_ZONES) + "select b.page_id, table_id, zone from b join z on b.page_id = z.page_id where (x1 - x0) * (y1 - y0) > 0 and greatest(least(x1, zx1) - greatest(x0, zx0), 0) * greatest(least(y1, zy1) - greatest(y0, zy0), 0) >= 0.5 * (x1 - x0) * (y1 - y0)")
def jn9(spark, sf):
    return X.tables_in_zones(_geo(spark, sf, _BOX), _geo(spark, sf, _ZONES))


@query("agg15_rule_extent", _with(b=_BOX, r=_RULES) + "select b.page_id, table_id, least(b.x0, min(rx0)) as rule_x0, greatest(b.x1, max(rx1)) as rule_x1 from b left join r on b.page_id = r.page_id and ry1 - ry0 <= 3 and rx1 - rx0 >= 20 and ry0 <= y1 and ry1 >= y0 group by b.page_id, table_id, b.x0, b.x1")
def agg15(spark, sf):
    return X.rule_extent(_geo(spark, sf, _BOX), _geo(spark, sf, _RULES)).select("page_id", "table_id", "rule_x0", "rule_x1")


@query("agg16_drawn_border", _with(b=_BOX, r=_RULES) + "select b.page_id, table_id, min(rx0) as bx0, max(rx1) as bx1 from b join r on b.page_id = r.page_id and ry1 - ry0 <= 3 and rx1 - rx0 >= 20 and rx1 < 245 and darkness < 0.3 and ry0 >= y0 - 20 and ry1 <= y1 + 20 group by 1, 2 having count(*) >= 2")
def agg16(spark, sf):
    return X.drawn_border(_geo(spark, sf, _BOX), _geo(spark, sf, _RULES))


@query("jn11_outer_words", _with(b=_BOX) + "," + cte("words")[4:] + """select table_id, row_no, side, string_agg(text, ' ' order by wy0, wx0, ord) as text from (select b.table_id, 1 as row_no, case when w.x0 < b.x0 then 'left' else 'right' end as side, w.y0 as wy0, w.x0 as wx0, w.ord, w.text
 from b join words w on b.page_id = w.page_id and (w.y0 + w.y1) / 2 >= b.y0 and (w.y0 + w.y1) / 2 < b.y1 and (w.x0 < b.x0 or w.x0 >= b.x1)) group by 1, 2, 3""")
def jn11(spark, sf):
    rows = _geo(spark, sf, _BOX).select("page_id", "table_id", F.lit(1).alias("row_no"), F.col("x0").alias("tx0"), F.col("x1").alias("tx1"), F.col("y0").alias("ry0"), F.col("y1").alias("ry1"))
    words = derived(spark, sf, "words").select("page_id", "ord", "text", *(F.col(c).alias("w" + c) for c in ("x0", "x1", "y0", "y1")))
    return X.outer_words(rows, words)


@query("agg19_row_ranges", _with(b=_BOX) + "select * from (select page_id as table_id, y0, lead(y0) over (partition by page_id order by y0) as y1 from (select page_id, y0 from b union select page_id, y1 from b)) where y1 is not null")
def agg19(spark, sf):
    return X.row_ranges(_geo(spark, sf, _BOX).select(F.col("page_id").alias("table_id"), "y0", "y1"))


@query("agg17_upper_median", f"select {ansi(PAGE)} as page_id, list_sort(list(l_extendedprice))[len(list(l_extendedprice)) // 2 + 1] as h from lineitem group by 1")
def agg17(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.expr(f"{PAGE} as page_id")).agg(X.upper_median(F.collect_list("l_extendedprice")).alias("h"))


@query("win8_word_rows")
def win8(spark, sf):
    return X.word_rows(derived(spark, sf, "words"), "page_id")


_ROWS = "select *, cast(y0 as int) as row_no from words"


@query("win9_cell_tokens", cte("words") + f""", r as ({_ROWS}), n as (select *, sum(j) over (partition by page_id, row_no order by x0, ord rows between unbounded preceding and current row) as token from (select *, case when x0 - lag(x1) over (partition by page_id, row_no order by x0, ord) <= 8 then 0 else 1 end as j from r))
 select page_id, row_no, token, min(x0) as x0, arg_max(x1, (x0, ord)) as x1, string_agg(text, ' ' order by x0, ord) as text from n group by 1, 2, 3""")
def win9(spark, sf):
    return X.cell_tokens(derived(spark, sf, "words").withColumn("row_no", F.col("y0").cast("int")), "page_id")


@query("win10_column_starts")
def win10(spark, sf):
    return X.column_starts(derived(spark, sf, "words"), "page_id")


@query("jn12_nearest_column", cte("words") + "select page_id, ord, cast(list_min(list_transform([0.0, 60.0, 120.0, 300.0, 450.0], lambda s, i: {'d': abs(x0 - s), 'i': i}))['i'] - 1 as integer) as col from words")
def jn12(spark, sf):
    return derived(spark, sf, "words").select("page_id", "ord", X.nearest_column(F.col("x0"), F.array(*map(F.lit, (0.0, 60.0, 120.0, 300.0, 450.0)))).alias("col"))


@query("fn29_rebuilt_tables")
def fn29(spark, sf):
    return X.rebuild(words_by_page(spark, sf), "page_id", together=True)


#: A third of the tables get words on their left, half of them end at the page's edge, a fifth of these at a drawn border, a quarter have rows from words: one column more, every row filled.
@query("fn28_repaired_tables", "with " + _TABLES + """, made as (select record_id, pos, rows, blob, pos % 3 = 0 as left_words, pos % 2 = 0 as edge, pos % 2 = 0 and pos % 5 < 2 as clipped, pos % 4 < 2 as has_new, len(rows[1]) + case when pos % 3 = 0 then 1 else 0 end as wide, coalesce(len(rows[1]), 0) + 1 as n_new from (
 select record_id, pos, x.raw_rows as rows, coalesce(len(x.raw_rows) > 1 and contains(x.raw_rows[1][1], chr(10)) and len(list_filter(x.raw_rows[1][2:], lambda c: coalesce(c, '') <> '')) = 0, false) as blob from tabs where len(x.raw_rows) > 0)),
 used as (select *, has_new and (clipped or coalesce(n_new > wide and n_new <= 1.5 * wide, false)) as use from made)
 select record_id, pos, case when len(rows) < 2 or len(rows[1]) = 1 or blob then 'low' when left_words or edge or use then 'medium' else 'high' end as confidence, cast(case when use then n_new else coalesce(wide, -1) end as integer) as n_columns, use as rebuilt, clipped from used""")
def fn28(spark, sf):
    t = _tables(spark, sf).where("size(raw_rows) > 0").select("record_id", "pos", F.col("raw_rows").alias("rows"))
    t = t.withColumn("left_words", F.when(F.col("pos") % 3 == 0, F.transform("rows", lambda r: F.lit("left")))).withColumn("right_words", F.transform("rows", lambda r: F.lit("EVB")))
    t = t.withColumn("x1", F.when(F.col("pos") % 2 == 0, 610.0).otherwise(500.0)).withColumn("page_width", F.lit(612.0)).withColumn("border_x1", F.when(F.col("pos") % 5 < 2, 580.0))
    new = F.transform("rows", lambda r: F.array_repeat(F.lit("new"), F.coalesce(F.size(F.get("rows", F.lit(0))), F.lit(0)) + 1))
    t = t.withColumn("rebuilt", F.when(F.col("pos") % 4 < 2, new))
    return X.repair(t).select("record_id", "pos", "confidence", F.coalesce(F.size(F.get("rows", F.lit(0))), F.lit(-1)).alias("n_columns"), F.array_contains("flags", "bbox_reconstruction_used").alias("rebuilt"),
                              F.array_contains("flags", "bbox_clipped_by_drawings").alias("clipped"))


_COUNTED = f"""headed as (select record_id, pos, r, case when len(r) < 3 then 1 when not ({_SUB.format('r[2]')}) then 1
 when len(list_filter(generate_series(1, greatest(len(a), len(b))), lambda i: coalesce(a[i], '') = '' and coalesce(b[i], '') <> '')) > 0 then 2
 when len(list_filter(a, lambda v: not regexp_full_match(v, '[A-Za-z\\s]*'))) = 0 and len(list_filter(generate_series(1, greatest(len(a), len(b))), lambda i: coalesce(a[i], '') <> '' and coalesce(b[i], '') <> '')) > 0 then 2 else 1 end as n
 from (select record_id, pos, x.raw_rows as r, list_transform(x.raw_rows[1], {_CELL}) as a, list_transform(x.raw_rows[2], {_CELL}) as b from tabs where len(x.raw_rows) > 0))"""


@query("win3_filled_tables", "with " + _TABLES + ", " + _COUNTED + """, cells as (select *, coalesce(r[i + 1][j + 1], '') as v from (select *, unnest(generate_series(0, coalesce(len(r[i + 1]), 0) - 1)) as j from (select *, unnest(generate_series(0, len(r) - 1)) as i from headed))),
 runs as (select *, i - row_number() over (partition by record_id, pos, j order by i) as run from cells)
 select record_id, pos, cast(i as integer) as row_no, string_agg(v, ' | ' order by j) as cells from (select record_id, pos, i, j, case when i < n then v
 else coalesce(last_value(nullif(v, '') ignore nulls) over (partition by record_id, pos, j, run, i >= n order by i rows between unbounded preceding and current row), '') end as v from runs) group by 1, 2, 3""")
def win3b(spark, sf):
    """The rows of every table with empty cells filled from above, below its headers; rows without cells are left out."""
    t = _tables(spark, sf).where("size(raw_rows) > 0").select("record_id", "pos", F.posexplode(X.filled_down(F.col("raw_rows"), X.header_rows(F.col("raw_rows")))).alias("row_no", "cells"))
    return t.where("size(cells) > 0").select("record_id", "pos", "row_no", F.array_join("cells", " | ").alias("cells"))


@query("win18_header_labels", "with " + _TABLES + ", " + _COUNTED + """ select record_id, pos, array_to_string(list_transform(generate_series(1, greatest(coalesce(len(r[1]), 0), case when n = 2 then coalesce(len(r[2]), 0) else 0 end)),
 lambda j: concat_ws(' ', nullif(trim(coalesce(r[1][j], '')), ''), case when n = 2 then nullif(trim(coalesce(r[2][j], '')), '') end)), ' | ') as labels from headed""")
def win18b(spark, sf):
    """Column labels of every table; two header rows are joined."""
    t = _tables(spark, sf).where("size(raw_rows) > 0").withColumn("n", X.header_rows(F.col("raw_rows")))
    return t.select("record_id", "pos", F.array_join(F.coalesce(X.header_labels(F.col("raw_rows"), F.col("n")), F.array().cast("array<string>")), " | ").alias("labels"))


@query("fn28_reconstructed_tables")
def fn28b(spark, sf):
    """Tables made readable by themselves: blob row stripped, cells filled down, repeats cleared; tested by brute force."""
    t = _tables(spark, sf).where("size(raw_rows) > 0").select("record_id", "pos", X.reconstructed(F.col("raw_rows"), X.is_blob_start(F.col("raw_rows"))).alias("r"))
    return t.select("record_id", "pos", "r.headers", "r.steps", F.transform("r.rows", lambda x: F.array_join(x, " | ")).alias("rows"))
