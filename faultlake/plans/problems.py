"""Queries of the general data problems (2 and 5) with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultlake.operators import nested, schema_drift
from faultlake.session import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return schema_drift.schema_changes(table(spark, sf, "adapter_files"))


def p2_table(spark: SparkSession, sf: str) -> DataFrame:
    return schema_drift.steady_table(table(spark, sf, "adapter_files"))


def p2_failed_casts(spark: SparkSession, sf: str) -> DataFrame:
    return schema_drift.failed_casts(table(spark, sf, "adapter_files"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return nested.broken_links(table(spark, sf, "dtc_records"), table(spark, sf, "code_records"))


def p5_links(spark: SparkSession, sf: str) -> DataFrame:
    report = nested.link_report(table(spark, sf, "dtc_records"), table(spark, sf, "code_records"))
    return report.distinct().groupBy("child_kind", "variant", "link").count().withColumnRenamed("count", "n")


def _flat(kind: str, name: str, *columns: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        build, source = (nested.dtc_tables, "dtc_records") if kind == "dtc" else (nested.code_tables, "code_records")
        return build(table(spark, sf, source))[name].selectExpr(*columns)
    return query


p5_sections = _flat("dtc", "section", "record_id", "pos", "section_id", "heading", "role", "page_start", "page_end", "length(cleaned_text) as text_chars")
p5_tables = _flat("dtc", "table", "record_id", "pos", "table_id", "section_id", "section_link")
p5_table_rows = _flat("dtc", "table_row", "record_id", "table_pos", "row_no", "size(cells) as n_cells")
p5_groups = _flat("dtc", "table_group", "record_id", "pos", "group_id", "tables_link")
p5_images = _flat("dtc", "image", "record_id", "pos", "image_id", "section_id", "section_link")
p5_blocks = _flat("code", "block", "record_id", "pos", "block_id", "block_type", "variant", "page_link")


def p5_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return nested.shape_counts(table(spark, sf, "dtc_records"), table(spark, sf, "code_records"))


#: Queries of flat tables: source, table and columns.
FLAT = {
    "p5_records": ("dtc", "record", "record_id", "document_id", "record_type", "title", "start_pdf_page", "end_pdf_page", "section_code", "extraction_status", "extraction_page_ref_confidence"),
    "p5_record_codes": ("dtc", "record_code", "record_id", "no", "code"),
    "p5_record_warnings": ("dtc", "record_warning", "record_id", "no", "warning"),
    "p5_record_page_refs": ("dtc", "page_ref", "record_id", "ref_no", "page_ref"),
    "p5_sections_typed": ("dtc", "section_typed", "record_id", "pos", "section_id", "heading", "has_type_variants"),
    "p5_sections_text": ("dtc", "section_text", "record_id", "pos", "section_id", "heading", "cleaned_text"),
    "p5_section_markers": ("dtc", "section_marker", "record_id", "pos", "no", "marker"),
    "p5_tables_grid": ("dtc", "table_grid", "record_id", "pos", "table_id", "section_link", "extraction_confidence", "extraction_partial"),
    "p5_tables_ragged": ("dtc", "table_ragged", "record_id", "pos", "table_id", "section_link", "extraction_header_rows_hint"),
    "p5_tables_empty": ("dtc", "table_empty", "record_id", "pos", "table_id", "section_link"),
    "p5_table_page_refs": ("dtc", "table_page_ref", "record_id", "pos", "no", "page_ref"),
    "p5_table_flags": ("dtc", "table_flag", "record_id", "pos", "no", "flag"),
    "p5_group_tables": ("dtc", "group_table", "record_id", "group_pos", "ref_no", "table_id"),
    "p5_groups_many": ("dtc", "group_many", "record_id", "pos", "group_id", "tables_link"),
    "p5_images_captioned": ("dtc", "image_captioned", "record_id", "pos", "image_id", "caption", "section_link"),
    "p5_images_plain": ("dtc", "image_plain", "record_id", "pos", "image_id", "image_path", "section_link"),
    "p5_code_records": ("code", "record", "record_id", "document_id", "record_type", "title", "start_pdf_page", "section_ref", "extraction_status", "extraction_ocr_used"),
    "p5_code_warnings": ("code", "record_warning", "record_id", "no", "warning"),
    "p5_identifiers": ("code", "identifier", "record_id", "pos", "type", "value", "confidence"),
    "p5_code_page_refs": ("code", "page_ref", "record_id", "ref_no", "page_ref"),
    "p5_blocks_text": ("code", "block_text", "record_id", "pos", "block_id", "page_link", "text"),
    "p5_blocks_table": ("code", "block_table", "record_id", "pos", "block_id", "page_link", "table_quality_status", "table_quality_confidence"),
    "p5_blocks_image": ("code", "block_image", "record_id", "pos", "block_id", "image_id", "path", "caption", "pdf_page"),
    "p5_blocks_mixed": ("code", "block_mixed", "record_id", "pos", "block_id", "text", "image_id", "path", "caption", "table_quality_status"),
    "p5_blocks_empty": ("code", "block_empty", "record_id", "pos", "block_id", "extraction_status"),
    "p5_block_rows": ("code", "table_row", "record_id", "pos", "row_no", "size(cells) as n_cells"),
    "p5_block_page_refs": ("code", "block_page_ref", "record_id", "pos", "ref_no", "page_ref"),
    "p5_block_warnings": ("code", "block_warning", "record_id", "pos", "no", "warning"),
    "p5_block_flags": ("code", "block_flag", "record_id", "pos", "no", "flag"),
    "p5_block_extraction_warnings": ("code", "block_extraction_warning", "record_id", "pos", "no", "warning"),
}

QUERIES = {f.__name__: f for f in (p2_found, p2_table, p2_failed_casts, p5_found, p5_links, p5_shapes)} | {
    "p5_sections": p5_sections, "p5_tables": p5_tables, "p5_table_rows": p5_table_rows, "p5_groups": p5_groups, "p5_images": p5_images, "p5_blocks": p5_blocks} | {
    name: _flat(*spec) for name, spec in FLAT.items()}

_DTC = "d as (select * from dtc_records where record_id is not null qualify row_number() over (partition by record_id order by loaded_at) = 1)"
_CODE = "c as (select * from code_records where record_id is not null qualify row_number() over (partition by record_id order by loaded_at) = 1)"


def _n(ids: str, field: str, value: str) -> str:
    return f"coalesce(len(list_filter({ids}, lambda s: s.{field} = {value})), 0)"


def _state(n: str, target: str) -> str:
    return f"case when {target} is null then 'none' when {n} = 1 then 'ok' when {n} = 0 then 'missing' else 'ambiguous' end"


def _child(cte: str, array: str, extra: str = "") -> str:
    return f"(select *, unnest({array}) as x, generate_subscripts({array}, 1) as pos from {cte})"


_GROUP_STATE = f"""case when len(list_filter(x.source_table_ids, lambda q: q is not null and {_n('tables', 'table_id', 'q')} = 0)) > 0 then 'missing'
 when len(list_filter(x.source_table_ids, lambda q: q is not null and {_n('tables', 'table_id', 'q')} > 1)) > 0 then 'ambiguous'
 when len(list_filter(x.source_table_ids, lambda q: q is not null)) > 0 then 'ok' else 'none' end"""
_BLOCK_STATE = """case when coalesce(len(list_filter(x.location.page_refs, lambda q: q is not null)), 0) = 0 then 'none'
 when len(list_filter(x.location.page_refs, lambda q: q is not null and not coalesce(list_contains(location.page_refs, q), false))) = 0 then 'ok' else 'missing' end"""
_VARIANT = """case when t + r + i > 1 then 'mixed' when t = 1 then 'text' when r = 1 then 'table' when i = 1 then 'image' else 'empty' end"""

SQL = {
    "p5_found": f"""with {_DTC}, {_CODE} select record_id, child_kind, cast(pos as integer) as child_pos from (
 select record_id, 'table' as child_kind, pos, {_state(_n('sections', 'section_id', 'x.section_id'), 'x.section_id')} as link from {_child('d', 'tables')}
 union all select record_id, 'image', pos, {_state(_n('sections', 'section_id', 'x.section_id'), 'x.section_id')} from {_child('d', 'images')}
 union all select record_id, 'group', pos, {_GROUP_STATE} from {_child('d', 'table_groups')}
 union all select record_id, 'block', pos, {_BLOCK_STATE} from {_child('c', 'content_blocks')}) where link in ('missing', 'ambiguous')""",
    "p5_sections": f"with {_DTC} select record_id, cast(pos as integer) as pos, x.section_id, x.heading, x.role, x.page_start, x.page_end, cast(length(x.cleaned_text) as integer) as text_chars from {_child('d', 'sections')}",
    "p5_tables": f"with {_DTC} select record_id, cast(pos as integer) as pos, x.table_id, x.section_id, {_state(_n('sections', 'section_id', 'x.section_id'), 'x.section_id')} as section_link from {_child('d', 'tables')}",
    "p5_table_rows": f"with {_DTC} select record_id, cast(pos as integer) as table_pos, cast(generate_subscripts(rr, 1) - 1 as integer) as row_no, cast(len(unnest(rr)) as integer) as n_cells from (select record_id, pos, x.raw_rows as rr from {_child('d', 'tables')})",
    "p5_groups": f"with {_DTC} select record_id, cast(pos as integer) as pos, x.group_id, {_GROUP_STATE} as tables_link from {_child('d', 'table_groups')}",
    "p5_images": f"with {_DTC} select record_id, cast(pos as integer) as pos, x.image_id, x.section_id, {_state(_n('sections', 'section_id', 'x.section_id'), 'x.section_id')} as section_link from {_child('d', 'images')}",
    "p5_blocks": f"""with {_CODE} select record_id, pos, block_id, block_type, {_VARIANT} as variant, page_link from (
 select record_id, cast(pos as integer) as pos, x.block_id as block_id, x.block_type as block_type, {_BLOCK_STATE} as page_link,
 case when coalesce(x.text, '') <> '' then 1 else 0 end as t, case when coalesce(len(list_filter(flatten(x.raw_rows), lambda v: coalesce(v, '') <> '')), 0) > 0 then 1 else 0 end as r,
 case when coalesce(x.image_ref.image_id, '') || coalesce(x.image_ref.path, '') || coalesce(x.image_ref.caption, '') <> '' then 1 else 0 end as i from {_child('c', 'content_blocks')})""",
}


def _list(cte: str, array: str, name: str, number: str = "no", start: int = 1) -> str:
    """Members of an array of a record with their places."""
    return f"select record_id, cast(generate_subscripts({array}, 1) - {1 - start} as integer) as {number}, unnest({array}) as {name} from {cte}"


def _inner(cte: str, array: str, path: str, name: str, number: str = "no", start: int = 1, pos: str = "pos") -> str:
    """Members of an array of a child object with the places of both."""
    return f"select record_id, cast(pos as integer) as {pos}, cast(generate_subscripts(a, 1) - {1 - start} as integer) as {number}, unnest(a) as {name} from (select record_id, pos, x.{path} as a from {_child(cte, array)})"


_LINK = _state(_n("sections", "section_id", "x.section_id"), "x.section_id")
_GRID = """case when coalesce(len(list_filter(flatten(x.raw_rows), lambda v: coalesce(v, '') <> '')), 0) = 0 then 'empty'
 when len(list_distinct(list_transform(x.raw_rows, lambda r: coalesce(len(r), -1)))) = 1 then 'grid' else 'ragged' end"""
_SECTION_KIND = """case when len(list_filter(x.type_markers_detected, lambda m: m is not null)) > 0 then 'typed' when coalesce(x.cleaned_text, '') <> '' then 'text' when coalesce(x.heading, '') <> '' then 'heading' else 'empty' end"""
_IMAGE_KIND = "case when coalesce(x.caption, '') <> '' then 'captioned' when coalesce(x.image_path, '') <> '' then 'plain' else 'empty' end"
_BLOCK_KIND = f"""(select *, {_VARIANT} as variant from (select *, case when coalesce(x.text, '') <> '' then 1 else 0 end as t, case when coalesce(len(list_filter(flatten(x.raw_rows), lambda v: coalesce(v, '') <> '')), 0) > 0 then 1 else 0 end as r,
 case when coalesce(x.image_ref.image_id, '') || coalesce(x.image_ref.path, '') || coalesce(x.image_ref.caption, '') <> '' then 1 else 0 end as i from {_child('c', 'content_blocks')}))"""
_POS = "record_id, cast(pos as integer) as pos"


def _block(variant: str, columns: str) -> str:
    return f"with {_CODE} select {_POS}, x.block_id as block_id, {columns} from {_BLOCK_KIND} where variant = '{variant}'"


_IMAGE = "x.image_ref.image_id as image_id, x.image_ref.path as path, x.image_ref.caption as caption"
SQL |= {
    "p5_records": f"with {_DTC} select record_id, document_id, record_type, title, location.start_pdf_page as start_pdf_page, location.end_pdf_page as end_pdf_page, location.section_code as section_code, extraction.status as extraction_status, extraction.page_ref_confidence as extraction_page_ref_confidence from d",
    "p5_record_codes": f"with {_DTC} {_list('d', 'codes', 'code')}",
    "p5_record_warnings": f"with {_DTC} {_list('d', 'extraction.warnings', 'warning')}",
    "p5_record_page_refs": f"with {_DTC} {_list('d', 'location.page_refs', 'page_ref', 'ref_no', 0)}",
    "p5_sections_typed": f"with {_DTC} select {_POS}, x.section_id as section_id, x.heading as heading, x.has_type_variants as has_type_variants from {_child('d', 'sections')} where {_SECTION_KIND} = 'typed'",
    "p5_sections_text": f"with {_DTC} select {_POS}, x.section_id as section_id, x.heading as heading, x.cleaned_text as cleaned_text from {_child('d', 'sections')} where {_SECTION_KIND} = 'text'",
    "p5_section_markers": f"with {_DTC} {_inner('d', 'sections', 'type_markers_detected', 'marker')}",
    "p5_tables_grid": f"with {_DTC} select {_POS}, x.table_id as table_id, {_LINK} as section_link, x.extraction.confidence as extraction_confidence, x.extraction.partial as extraction_partial from {_child('d', 'tables')} where {_GRID} = 'grid'",
    "p5_tables_ragged": f"with {_DTC} select {_POS}, x.table_id as table_id, {_LINK} as section_link, x.extraction.header_rows_hint as extraction_header_rows_hint from {_child('d', 'tables')} where {_GRID} = 'ragged'",
    "p5_tables_empty": f"with {_DTC} select {_POS}, x.table_id as table_id, {_LINK} as section_link from {_child('d', 'tables')} where {_GRID} = 'empty'",
    "p5_table_page_refs": f"with {_DTC} {_inner('d', 'tables', 'page_refs', 'page_ref')}",
    "p5_table_flags": f"with {_DTC} {_inner('d', 'tables', 'extraction.quality_flags', 'flag')}",
    "p5_group_tables": f"with {_DTC} {_inner('d', 'table_groups', 'source_table_ids', 'table_id', 'ref_no', 0, 'group_pos')}",
    "p5_groups_many": f"with {_DTC} select {_POS}, x.group_id as group_id, {_GROUP_STATE} as tables_link from {_child('d', 'table_groups')} where len(list_filter(x.source_table_ids, lambda q: q is not null)) > 1",
    "p5_images_captioned": f"with {_DTC} select {_POS}, x.image_id as image_id, x.caption as caption, {_LINK} as section_link from {_child('d', 'images')} where {_IMAGE_KIND} = 'captioned'",
    "p5_images_plain": f"with {_DTC} select {_POS}, x.image_id as image_id, x.image_path as image_path, {_LINK} as section_link from {_child('d', 'images')} where {_IMAGE_KIND} = 'plain'",
    "p5_code_records": f"with {_CODE} select record_id, document_id, record_type, title, location.start_pdf_page as start_pdf_page, location.section_ref as section_ref, extraction.status as extraction_status, extraction.ocr_used as extraction_ocr_used from c",
    "p5_code_warnings": f"with {_CODE} {_list('c', 'extraction.warnings', 'warning')}",
    "p5_identifiers": f"with {_CODE} select {_POS}, x.type as type, x.value as value, x.confidence as confidence from {_child('c', 'identifiers')}",
    "p5_code_page_refs": f"with {_CODE} {_list('c', 'location.page_refs', 'page_ref', 'ref_no', 0)}",
    "p5_blocks_text": _block("text", f"{_BLOCK_STATE} as page_link, x.text as text"),
    "p5_blocks_table": _block("table", f"{_BLOCK_STATE} as page_link, x.table_quality.status as table_quality_status, x.table_quality.confidence as table_quality_confidence"),
    "p5_blocks_image": _block("image", f"{_IMAGE}, x.image_ref.pdf_page as pdf_page"),
    "p5_blocks_mixed": _block("mixed", f"x.text as text, {_IMAGE}, x.table_quality.status as table_quality_status"),
    "p5_blocks_empty": _block("empty", "x.extraction.status as extraction_status"),
    "p5_block_rows": f"with {_CODE} select record_id, pos, row_no, cast(len(r) as integer) as n_cells from ({_inner('c', 'content_blocks', 'raw_rows', 'r', 'row_no', 0)})",
    "p5_block_page_refs": f"with {_CODE} {_inner('c', 'content_blocks', 'location.page_refs', 'page_ref', 'ref_no', 0)}",
    "p5_block_warnings": f"with {_CODE} {_inner('c', 'content_blocks', 'table_quality.warnings', 'warning')}",
    "p5_block_flags": f"with {_CODE} {_inner('c', 'content_blocks', 'table_quality.flags', 'flag')}",
    "p5_block_extraction_warnings": f"with {_CODE} {_inner('c', 'content_blocks', 'extraction.warnings', 'warning')}",
    # every kind of object by variant and link, from the same restatements
    "p5_links": f"""with {_DTC}, {_CODE} select child_kind, variant, link, count(*) as n from (
 select 'table' as child_kind, {_GRID} as variant, {_LINK} as link from {_child('d', 'tables')} union all select 'image', {_IMAGE_KIND}, {_LINK} from {_child('d', 'images')}
 union all select 'group', case when coalesce(len(list_filter(x.source_table_ids, lambda q: q is not null)), 0) > 1 then 'many' when len(list_filter(x.source_table_ids, lambda q: q is not null)) = 1 then 'single' else 'empty' end, {_GROUP_STATE} from {_child('d', 'table_groups')}
 union all select 'block', variant, {_BLOCK_STATE} from {_BLOCK_KIND}) group by 1, 2, 3""",
}
