"""Queries of page, section, image and vehicle operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultlake.operators import pages as P
from faultlake.operators import vehicle as V
from faultlake.plans.derived import KEY, MANUAL, PAGE, ansi, cte, derived, run
from faultlake.session import global_ordinal, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


_FILL = "filled as (select *, last_value(type_heading ignore nulls) over (partition by doc order by page rows between unbounded preceding and current row) as manual_type from pages_seq)"


def _filled(spark, sf):
    return P.fill_types(derived(spark, sf, "pages_seq"))


@query("win1_page_types", cte("pages_seq") + ", " + _FILL + " select doc, page, manual_type from filled")
def win1(spark, sf):
    return _filled(spark, sf).select("doc", "page", "manual_type")


_STARTS = "starts as (select doc, page as start_page, ['P3A0D', 'P1A0D', 'P5A0D', 'P7A0D'] as codes, prefix, manual_type as type from filled)"


@query("win11_record_runs", cte("pages_seq") + ", " + _FILL + ", " + _STARTS + """ select doc, start_page, cast(coalesce(stop - 1, last, start_page) as integer) as end_page from (
 select s.doc, s.start_page, min(case when len(list_filter(s.codes, lambda c: contains(upper(substr(p.header, 1, 300)), c))) = 0 or p.prefix <> s.prefix or p.manual_type is distinct from s.type then p.page end) as stop, max(p.page) as last
 from starts s left join filled p on s.doc = p.doc and p.page > s.start_page group by 1, 2)""")
def win11(spark, sf):
    pages = _filled(spark, sf)
    starts = pages.select("doc", F.col("page").alias("start_page"), F.array(*map(F.lit, ("P3A0D", "P1A0D", "P5A0D", "P7A0D"))).alias("codes"), "prefix", F.col("manual_type").alias("type"))
    return P.record_runs(starts, pages.select("doc", "page", "header", "prefix", F.col("manual_type").alias("type")))


@query("win12_type_segments", cte("pages_seq") + ", " + _FILL + """ select doc, record, segment, any_value(t) as type, min(page) as first_page, max(page) as last_page from (select *, sum(c) over (partition by doc, record order by page rows between unbounded preceding and current row) as segment from (
 select doc, page, page // 100 as record, manual_type as t, case when row_number() over w > 1 and lag(manual_type) over w is not distinct from manual_type then 0 else 1 end as c from filled window w as (partition by doc, page // 100 order by page))) group by 1, 2, 3""")
def win12(spark, sf):
    pages = _filled(spark, sf).select("doc", "page", F.expr("page div 100 as record"), F.col("manual_type").alias("type"))
    return P.type_segments(pages)


_BREAKS = f"select {PAGE} as page_id, {KEY} as ord, l_quantity * 15 as y_top, 792.0 as page_height from {{lineitem}}"


@query("win13_zones", "with breaks as (" + ansi(_BREAKS).replace("792.0", "cast(792 as double)") + ") select page_id, ord, y_top, coalesce(lead(y_top) over (partition by page_id order by y_top, ord), page_height) as zone_end from breaks")
def win13(spark, sf):
    b = run(spark, sf, _BREAKS).withColumn("page_height", F.lit(792.0))
    return P.zones(b).select("page_id", "ord", "y_top", "zone_end")


_PARTS = f"select {PAGE} as record, {KEY} as ord, case when l_suppkey % 4 = 0 then 's' || cast(l_suppkey as varchar(9)) end as section, ' t' || cast(l_linenumber as varchar(9)) || ' ' as text from {{lineitem}}"
_OPEN = "opened as (select * from (select *, last_value(section ignore nulls) over (partition by record order by ord rows between unbounded preceding and current row) as open_section from parts) where open_section is not null)"


def _opened(spark, sf):
    return P.continue_sections(run(spark, sf, _PARTS))


@query("win14_open_sections", "with parts as (" + ansi(_PARTS) + "), " + _OPEN + " select record, ord, open_section from opened")
def win14(spark, sf):
    return _opened(spark, sf).select("record", "ord", "open_section")


@query("agg9_section_texts", "with parts as (" + ansi(_PARTS) + "), " + _OPEN + " select record, open_section as section, nullif(trim(string_agg(text, chr(10) || chr(10) order by ord), ' ' || chr(10)), '') as cleaned_text from opened group by 1, 2")
def agg9(spark, sf):
    o = _opened(spark, sf).select("record", F.col("open_section").alias("section"), "ord", "text")
    return P.section_texts(o)


@query("win15_sequence_ids", "select record_id, 'r' || cast(row_number() over (partition by document_id order by start, record_id) as varchar) as seq_id from (select distinct record_id, document_id, location.start_pdf_page as start from dtc_records where record_id is not null)")
def win15(spark, sf):
    r = table(spark, sf, "dtc_records").where("record_id is not null").select("record_id", F.coalesce("document_id", F.lit("")).alias("document_id"), F.coalesce("location.start_pdf_page", F.lit(2**31 - 1)).alias("start")).distinct()
    return global_ordinal(r, "document_id", ["start", "record_id"], "n").select("record_id", F.concat(F.lit("r"), (F.col("n") + 1).cast("string")).alias("seq_id"))


_LINES = "lines as (select doc_id as page_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 as ord, unnest(string_split(text, chr(10))) as text from documents)"


def _doc_lines(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))


@query("jn7_known_headings", "select record_id as page_id, h as heading, role, min(pos) as ord from (select record_id, pos, x.heading as t from (select record_id, unnest(sections) as x, generate_subscripts(sections, 1) - 1 as pos from dtc_records)) join (values "
       + ", ".join(f"('{h}', '{r}')" for h, r in P.HEADINGS) + ") k(h, role) on lower(trim(regexp_replace(replace(replace(t, 'Function', 'description'), 'Monitor Rules', 'DTC  Logic'), '\\s+', ' ', 'g'))) = lower(h) group by 1, 2, 3")
def jn7(spark, sf):
    s = table(spark, sf, "dtc_records").select(F.col("record_id").alias("page_id"), F.posexplode("sections.heading").alias("ord", "text"))
    return P.known_headings(s.withColumn("text", F.replace(F.replace("text", F.lit("Function"), F.lit("description")), F.lit("Monitor Rules"), F.lit("DTC  Logic"))))


@query("flt15_unknown_headings")
def flt15(spark, sf):
    lines = _doc_lines(spark, sf).withColumn("all_bold", F.length("text") % 2 == 0)
    return P.unknown_headings(lines).select("page_id", "ord", "text")


@query("agg8_headings_by_record", "select record_id as record, list_sort(list_distinct(list(h))) as headings from (select record_id, unnest(sections).heading as h from dtc_records) where h is not null group by record_id")
def agg8(spark, sf):
    return P.headings_by_record(table(spark, sf, "dtc_records").select(F.col("record_id").alias("record"), F.explode("sections.heading").alias("text")).where("text is not null"))


@query("jn8_image_sections", cte("sections", "images") + "select i.doc, i.image, i.page, arg_max(s.section_id, (s.page_start, s.idx)) as section_id from images i left join sections s on s.doc = i.doc and s.page_start <= i.page group by 1, 2, 3")
def jn8(spark, sf):
    return P.images_to_sections(derived(spark, sf, "images"), derived(spark, sf, "sections"))


@query("jn14_captions", cte("links", "words") + """select l.page_id, l.ord as image, arg_min('JSCIA' || lpad(cast(w.ord % 999 as varchar), 4, '0') || 'GB', w.ord) as caption from links l join words w on l.page_id = w.page_id and w.y0 >= l.mid % 170 - 40 and w.y0 <= l.mid % 170 + 60 where w.ord % 2 = 0 group by 1, 2""")
def jn14(spark, sf):
    images = derived(spark, sf, "links").select("page_id", F.col("ord").alias("image"), F.expr("mid % 170 as y1"))
    spans = derived(spark, sf, "words").withColumn("text", F.when(F.col("ord") % 2 == 0, F.concat(F.lit("JSCIA"), F.lpad((F.col("ord") % 999).cast("string"), 4, "0"), F.lit("GB"))).otherwise(F.col("text")))
    return P.captions(images, spans.drop("x0", "x1", "y1"))


_IMG = "select MANUAL as doc, KEY as ord, l_partkey % 90 as xref, 'm' || cast(l_partkey % 70 as varchar(9)) as md5, cast(l_quantity * 20 as int) as width, cast(l_suppkey * 13 % 1500 as int) as height, 'i' || cast(KEY as varchar(30)) as name from {lineitem}".replace("KEY", KEY).replace("MANUAL", MANUAL)


@query("set3_image_dedup", "with im as (" + ansi(_IMG) + ") select doc, xref, ord, md5, first_value(name) over (partition by doc, md5 order by ord) as file_name from (select * from im qualify row_number() over (partition by doc, xref order by ord) = 1) where width >= 500 and height >= 500")
def set3(spark, sf):
    return P.dedup_images(run(spark, sf, _IMG))


@query("flt12_large_images", "with im as (" + ansi(_IMG) + ") select doc, ord from im where width >= 500 and height >= 500")
def flt12(spark, sf):
    return P.large_images(run(spark, sf, _IMG)).select("doc", "ord")


_CHECKED = """checked as (select doc, page, len(list_filter(['P3A0D', 'P4A0D'], lambda c: contains(upper(substr(header, 1, 300)), c))) > 0 as code_match, nullif(regexp_extract(footer, '\\b([A-Z]{1,4}-\\d+[A-Z]?)\\b', 1), '') as detected_ref,
 case when page % 3 > 0 then lower(footer) end as expected_ref from pages_seq)"""


def _verified(spark, sf):
    p = derived(spark, sf, "pages_seq").select("doc", "page", "header", "footer", F.array(F.lit("P3A0D"), F.lit("P4A0D")).alias("codes"), F.expr("case when page % 3 > 0 then lower(footer) end as expected_ref"))
    return P.page_codes_verified(p)


@query("fn18_page_verification", cte("pages_seq") + ", " + _CHECKED + """ select doc, page, code_match, detected_ref, case when code_match and same then 'high' when code_match and not avail then 'medium' when not code_match and same then 'low' else 'conflict' end as confidence
 from (select *, detected_ref is not null and expected_ref is not null as avail, coalesce(upper(detected_ref) = upper(expected_ref), false) as same from checked)""")
def fn18(spark, sf):
    return _verified(spark, sf).select("doc", "page", "code_match", "detected_ref", "confidence")


@query("fn19_verification_warnings", cte("pages_seq") + ", " + _CHECKED + """ select doc, page, case when code_match and same then null when code_match and not avail then h || 'DTC code confirmed in header, no printed page ref detected'
 when not code_match and same then h || 'footer ref ''' || detected_ref || ''' matches index but DTC code not found in page header'
 else h || case when code_match then 'DTC code confirmed in header' else 'DTC code NOT found in header' end || case when avail then '; index ref=''' || expected_ref || ''', footer ref=''' || detected_ref || ''''
 when expected_ref is not null then '; index ref=''' || expected_ref || ''', no footer ref detected' when detected_ref is not null then '; no index ref, footer ref=''' || detected_ref || '''' else '' end end as warning
 from (select *, 'page_ref_confidence=' || case when code_match and same then 'high' when code_match and not avail then 'medium' when not code_match and same then 'low' else 'conflict' end || ' on PDF page ' || cast(page as varchar) || ': ' as h
 from (select *, detected_ref is not null and expected_ref is not null as avail, coalesce(upper(detected_ref) = upper(expected_ref), false) as same from checked))""")
def fn19(spark, sf):
    return _verified(spark, sf).select("doc", "page", "warning")


@query("set6_record_types", cte("pages_seq") + ", " + _FILL + " select doc, coalesce(list_sort(list_distinct(list(manual_type) filter (where manual_type is not null))), []) as types from filled group by doc")
def set6(spark, sf):
    return P.record_types(_filled(spark, sf))


@query("agg12_section_codes", cte("pages_seq") + "select doc, list(prefix order by page) as codes from (select doc, prefix, min(page) as page from pages_seq group by 1, 2) group by doc")
def agg12(spark, sf):
    return P.section_codes(derived(spark, sf, "pages_seq"))


@query("agg13_page_refs", cte("pages_seq") + "select doc, list(ref order by page) as refs from (select doc, ref, min(page) as page from (select doc, page, regexp_extract(footer, '\\b([A-Z]{1,4}-\\d+[A-Z]?)\\b', 1) as ref from pages_seq) where ref <> '' group by 1, 2) group by doc")
def agg13(spark, sf):
    from faultlake.functions import text as T

    p = derived(spark, sf, "pages_seq").select("doc", "page", T.footer_ref(F.col("footer")).alias("prefix"))
    return P.section_codes(p).withColumnRenamed("codes", "refs")


@query("jn5_types_of_records", cte("pages_seq") + ", " + _FILL + " select doc, page, manual_type from filled")
def jn5(spark, sf):
    f = _filled(spark, sf)
    return f.select("doc", "page").join(f.select("doc", "page", "manual_type"), ["doc", "page"])


@query("lim2_first_pages", cte("pages_seq") + "select doc, count(*) as n from pages_seq where page <= 5 group by doc")
def lim2(spark, sf):
    return derived(spark, sf, "pages_seq").where("page <= 5").groupBy("doc").agg(F.count("*").alias("n"))


@query("flt2_digital", cte("pages_seq") + "select doc, coalesce(bool_or(length(trim(repeat(text, page % 8))) > 50) filter (where page <= 5), false) as digital from pages_seq group by doc")
def flt2(spark, sf):
    return V.is_digital(derived(spark, sf, "pages_seq").withColumn("text", F.expr("repeat(text, page % 8)")))


@query("agg5_link_sample", cte("links") + "select page_id // 7 as doc, count(*) as n_links, true as has_links, bool_or(target % 5 = 4) as has_internal_links from links where page_id % 7 + 1 <= 5 group by 1")
def agg5(spark, sf):
    return V.link_sample(derived(spark, sf, "links").select(F.expr("page_id div 7 as doc"), F.expr("page_id % 7 + 1 as page"), F.expr("target % 5 as kind")))


_LABELS = "select o_orderkey div 20 as doc, o_orderkey as ord, case o_orderkey % 6 when 0 then 'EVB-' when 1 then 'TM-' when 2 then null else 'x' end as prefix from {orders}"
_TOC = "select o_orderkey div 20 as doc, cast(o_orderkey % 9 as int) as level from {orders}"


@query("agg6_merged_files", "with labels as (" + ansi(_LABELS) + "), toc as (" + ansi(_TOC) + """) select doc, score >= 2 as is_merged, case when score >= 3 then 'high' when score = 2 then 'medium' when score = 1 then 'low' else 'high' end as confidence,
 list_filter([case when n >= 2 then 'page labels have ' || n || ' distinct section prefixes: ' || l end, case when m >= 5 then 'TOC has ' || m || ' top-level sections' end], lambda x: x is not null) as evidence,
 list_filter([case when n = 1 then 'single section prefix in page labels: ' || l when n = 0 then 'no section-code prefixes found in page labels' end, case when m >= 2 and m < 5 then 'TOC has ' || m || ' top-level sections (weak signal)'
 when m < 2 then 'TOC has ' || m || ' top-level section(s) — no signal' end, case when score = 1 then 'weak signal — treating as single manual' end], lambda x: x is not null) as notes from (
 select *, case when n >= 2 then 3 else 0 end + case when m >= 5 then 2 when m >= 2 then 1 else 0 end as score from (select d.doc, coalesce(n, 0) as n, l, coalesce(m, 0) as m from (select doc from labels union select doc from toc) d
 left join (select doc, count(*) as n, string_agg(code, ', ' order by ord) as l from (select doc, regexp_extract(prefix, '^([A-Z]{2,5})-', 1) as code, min(ord) as ord from labels where regexp_matches(prefix, '^[A-Z]{2,5}-') group by 1, 2) group by doc) a on a.doc = d.doc
 left join (select doc, count(*) filter (where level = 1) as m from toc group by doc) t on t.doc = d.doc))""")
def agg6(spark, sf):
    return V.merged_verdict(run(spark, sf, _LABELS), run(spark, sf, _TOC))


# Footer, foreword and title texts made of the manuals' own fields
_TEXTS = """select document_id as doc, [case when v.year is null then 'EVB-1' else 'EVB-' || substr(v.year, 3, 2) end, coalesce(v.year || ' ' || case when regexp_full_match(v.model, '[A-Za-z][A-Za-z0-9-]*') then v.model else 'LEAF' end, 'cover 1!'),
 case when v.revision_date is null then 'note #' else 'Revision: ' || v.revision_date end] as lines from (select document_id, any_value(vehicle) as v from manuals group by document_id)"""


@query("fn12_footer", "select doc, case when lines[3] like 'Revision: %' then trim(substr(lines[3], 11)) end as revision_date, nullif(regexp_extract(lines[2], '^(\\d{4}) ([A-Za-z][A-Za-z0-9-]*)$', 1), '') as year, nullif(regexp_extract(lines[2], '^(\\d{4}) ([A-Za-z][A-Za-z0-9-]*)$', 2), '') as model from (" + _TEXTS + ")")
def fn12(spark, sf):
    return _vehicle_docs(spark, sf).select("doc", "footer.revision_date", "footer.year", "footer.model")


def _vehicle_docs(spark, sf):
    m = table(spark, sf, "manuals").where("document_id is not null").dropDuplicates(["document_id"]).withColumn("v", F.col("vehicle"))
    model = F.when(F.col("v.model").rlike("^[A-Za-z][A-Za-z0-9-]*$"), F.col("v.model")).otherwise("LEAF")
    lines = F.array(F.lit(""), F.when(F.col("v.year").isNull(), "EVB-1").otherwise(F.concat(F.lit("EVB-"), F.substring("v.year", 3, 2))),
                    F.when(F.col("v.year").isNull(), "cover 1!").otherwise(F.concat("v.year", F.lit(" "), model)),
                    F.when(F.col("v.revision_date").isNull(), "note #").otherwise(F.concat(F.lit("Revision: "), "v.revision_date")))
    name = F.concat_ws(" ", "v.year", "v.make", "v.model")
    fore = F.when(F.col("v.make").isNotNull() & (F.length("v.make") % 2 == 0), F.concat(F.lit("procedure for the "), name, F.lit(" and its kin")))
    title = F.when(F.substring("document_id", 1, 1) < "8", F.concat(F.lit("Service "), name, F.lit(" Manual")))
    return m.select(F.col("document_id").alias("doc"), V.footer_info(lines).alias("footer"), V.foreword_info(fore).alias("foreword"), V.title_info(title).alias("title"), F.lit("June 2020").alias("revision"))


_NAMES = "(select document_id as doc, any_value(vehicle).make as m, concat_ws(' ', any_value(vehicle).year, any_value(vehicle).make, any_value(vehicle).model) as n from manuals where document_id is not null group by document_id)"
_FORE, _TITLE = r"(?i)for the (\d{4})\s+([A-Z][A-Z\-]+)\s+([A-Z][A-Z0-9\-]+)", r"(\d{4})\s+([A-Za-z]+)\s+([A-Za-z0-9\-]+)"


@query("fn14_foreword", f"""select doc, regexp_extract(t, '{_FORE}', 1) as year, array_to_string(list_transform(string_split(regexp_extract(t, '{_FORE}', 2), '-'), lambda w: upper(w[1]) || lower(w[2:])), '-') as make, upper(regexp_extract(t, '{_FORE}', 3)) as model
 from (select doc, 'procedure for the ' || n || ' and its kin' as t from {_NAMES} where m is not null and length(m) % 2 = 0) where regexp_matches(t, '{_FORE}')""")
def fn14b(spark, sf):
    """Foreword phrases of the manuals' own years, makes and models, as people typed them."""
    return _vehicle_docs(spark, sf).where("foreword is not null").select("doc", "foreword.*")


@query("fn15_title", f"""select doc, regexp_extract(t, '{_TITLE}', 1) as year, regexp_extract(t, '{_TITLE}', 2) as make, upper(regexp_extract(t, '{_TITLE}', 3)) as model
 from (select doc, 'Service ' || n || ' Manual' as t from {_NAMES} where substr(doc, 1, 1) < '8') where regexp_matches(t, '{_TITLE}')""")
def fn15(spark, sf):
    """Titles of the manuals' own years, makes and models."""
    return _vehicle_docs(spark, sf).where("title is not null").select("doc", "title.*")


@query("fn16_vehicle_merge")
def fn16(spark, sf):
    models = table(spark, sf, "vehicle_models").groupBy(F.upper("model").alias("model")).agg(F.min("make").alias("make"))
    return V.merge_vehicle(_vehicle_docs(spark, sf), models)


@query("jn4_model_lookup", "select distinct m.document_id as doc, make from (select document_id, vehicle.model as model from manuals where vehicle.model is not null) m left join (select upper(model) as model, min(make) as make from vehicle_models group by 1) v on upper(m.model) = v.model")
def jn4(spark, sf):
    m = table(spark, sf, "manuals").where("vehicle.model is not null").select(F.col("document_id").alias("doc"), F.upper("vehicle.model").alias("model")).distinct()
    models = table(spark, sf, "vehicle_models").groupBy(F.upper("model").alias("model")).agg(F.min("make").alias("make"))
    return m.join(models, "model", "left").select("doc", "make").distinct()


@query("fn13_revision", cte("pages_seq") + "select doc, arg_min('June ' || cast(2000 + page as varchar), page) as revision_date from pages_seq where page <= 5 and page % 2 = 0 group by doc")
def fn13(spark, sf):
    p = derived(spark, sf, "pages_seq").select("doc", "page", F.lit(0).alias("zone"), F.lit(0).alias("ord"), F.when(F.col("page") % 2 == 0, F.concat(F.lit("Edition: June "), (2000 + F.col("page")).cast("string"))).otherwise("x").alias("line"))
    return V.revision_of(p)
