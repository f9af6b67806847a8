"""Deeply nested records to related flat tables (problem 5).

Every nested object becomes a row of a child table that keeps the key of its record (``record_id``), its
1-based place in its array (``pos``) and its links to siblings, each with a ``*_link`` state: ``ok``,
``none`` (no id given), ``missing`` (leads nowhere) or ``ambiguous`` (several targets). Links are settled
inside the row of the record, so no join or shuffle is needed, and only the fields used are read.

Objects of one array may have different shapes. A bottom-up tree automaton gives each value a state
(``tree_state``): a leaf is absent or filled, an array has the set of its members' states, an object the
states of its filled fields. Two kinds of fields have transitions of their own: a grid of cells is ``grid`` or ``ragged``, and an id that
refers to a sibling takes the state of its link. The state of an object is all that routes it: its variant names the
typed subtype table it goes to, its link state goes with the keys that all variants of a kind share (``members``), and the report of broken links is read from these.

Arrays inside an object become child tables of their own (page refs, rows, flags, warnings, markers), so no field is lost.
A record delivered again counts once. Null records and arrays give no rows; null members of an array keep
their place and count as objects without any field; a null id or page ref is no link. Ids compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_KEYS = ["record_id", "document_id"]
STRINGS = "array<string>"


def once(records: DataFrame, key: str = "record_id") -> DataFrame:
    """Records without later deliveries of the same key; rows without a key are left out."""
    return records.where(F.col(key).isNotNull()).dropDuplicates([key])


Rules = dict[str, Callable[[Column], Column]]


def tree_state(value: Column, kind: T.DataType, rules: Rules | None = None, path: str = "") -> Column:
    """The automaton's state of ``value``: '' for absent, '1' for a filled leaf, '[..]' and '{..}' above.

    ``rules`` has the transitions of fields that have their own, by dotted path.
    """
    if rules and path in rules:
        return F.coalesce(rules[path](value), F.lit(""))
    if isinstance(kind, T.StructType):
        parts = [F.when(F.length(s := tree_state(value[f.name], f.dataType, rules, f"{path}.{f.name}".strip("."))) > 0, F.concat(F.lit(f.name + ":"), s)) for f in kind.fields]
        inner = F.array_join(F.array_compact(F.array(*parts)), ",")
        return F.when(value.isNull() | (inner == ""), F.lit("")).otherwise(F.concat(F.lit("{"), inner, F.lit("}")))
    if isinstance(kind, T.ArrayType):
        states = F.array_sort(F.array_distinct(F.transform(value, lambda x: tree_state(x, kind.elementType))))
        return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("["), F.array_join(states, "|"), F.lit("]")))
    if isinstance(kind, T.StringType):
        return F.when(value.isNull() | (value == ""), F.lit("")).otherwise(F.lit("1"))
    return F.when(value.isNull(), F.lit("")).otherwise(F.lit("1"))


def grid_state(rows: Column) -> Column:
    """grid if all rows are equally wide, ragged if not, '' where no cell is filled; a null row has no width."""
    filled = F.exists(rows, lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    wide = F.array_distinct(F.transform(rows, lambda r: F.coalesce(F.size(r), F.lit(-1))))
    return F.when(F.coalesce(filled, F.lit(False)), F.when(F.size(wide) == 1, "grid").otherwise("ragged")).otherwise("")


def list_state(values: Column) -> Column:
    """many, single or '' by the members that are not null."""
    n = F.size(F.filter(values, lambda x: x.isNotNull()))
    return F.when(F.coalesce(n, F.lit(0)) > 1, "many").when(n == 1, "single").otherwise("")


def link_state(target: Column, ids: Column) -> Column:
    """How often ``target`` is among ``ids``, as ok, none, missing or ambiguous."""
    n = F.size(F.filter(F.coalesce(ids, F.array().cast("array<string>")), lambda x: x == target))
    return F.when(target.isNull(), "none").when(n == 1, "ok").when(n == 0, "missing").otherwise("ambiguous")


def links_state(targets: Column, ids: Column) -> Column:
    """The worst ``link_state`` of several targets."""
    states = F.transform(F.coalesce(targets, F.array().cast("array<string>")), lambda t: link_state(t, ids))
    return (F.when(F.exists(states, lambda s: s == "missing"), "missing").when(F.exists(states, lambda s: s == "ambiguous"), "ambiguous")
            .when(F.exists(states, lambda s: s == "ok"), "ok").otherwise("none"))


def among_state(targets: Column, ids: Column) -> Column:
    """ok if every target is among ``ids``, missing if any is not, none without targets."""
    known = F.coalesce(ids, F.array().cast("array<string>"))
    given = F.filter(F.coalesce(targets, F.array().cast("array<string>")), lambda t: t.isNotNull())
    return F.when(F.size(given) == 0, "none").when(F.forall(given, lambda t: F.array_contains(known, t)), "ok").otherwise("missing")


def _children(records: DataFrame, array: str, **links: Column) -> DataFrame:
    """One row per member of ``array`` with its fields beside the record's keys; links are arrays by place."""
    zipped = F.arrays_zip(F.col(array).alias("item"), *(c.alias(n) for n, c in links.items())) if links else F.transform(array, lambda x: F.struct(x.alias("item")))
    rows = records.select(*RECORD_KEYS, F.posexplode(zipped).alias("_pos", "_row"))
    return rows.select(*RECORD_KEYS, (F.col("_pos") + 1).alias("pos"), "_row.item.*", *(f"_row.{n}" for n in links))


def _struct(*names: str) -> T.StructType:
    """The part of an object that its state is made of."""
    out = T.StructType()
    for name in names:
        first, _, rest = name.partition(".")
        out = out.add(first, _struct(rest) if rest else T.StringType())
    return out


class Kind:
    """Objects of one array: what their state is made of, and how it routes them.

    ``variants`` are tried in order: the first whose pattern the state holds is the object's, the last takes the rest.
    """

    def __init__(self, array: str, fields: T.StructType, rules: Rules, variants: tuple[tuple[str, str], ...], link: str) -> None:
        self.array, self.fields, self.rules, self.variants, self.link = array, fields, rules, variants, link

    def state(self, item: Column) -> Column:
        return tree_state(item, self.fields, self.rules)

    def states(self) -> Column:
        return F.transform(self.array, self.state)

    def variant_of(self, state: Column) -> Column:
        *some, (rest, _) = self.variants
        return reduce(lambda out, v: F.when(state.rlike(v[1]), v[0]).otherwise(out), reversed(some), F.lit(rest))

    def link_of(self, state: Column) -> Column:
        """The state of the link, none where the field is absent."""
        found = F.regexp_extract(state, rf"\b{self.link}:(\w+)", 1)
        return F.when(found == "", "none").otherwise(found)


def dtc_kinds() -> dict[str, Kind]:
    """The kinds of objects in dtc_records; links are to ids of the same record."""
    sections, tables = F.col("sections.section_id"), F.col("tables.table_id")
    to_section = {"section_id": lambda t: F.when(t.isNotNull(), link_state(t, sections))}
    return {
        "section": Kind("sections", _struct("heading", "cleaned_text", "type_markers_detected"), {"type_markers_detected": list_state},
                        (("typed", "type_markers_detected:"), ("text", "cleaned_text:"), ("heading", "heading:"), ("empty", "")), "no_link"),
        "table": Kind("tables", _struct("table_id", "section_id", "raw_rows"), to_section | {"raw_rows": grid_state}, (("grid", "raw_rows:grid"), ("ragged", "raw_rows:ragged"), ("empty", "")), "section_id"),
        "image": Kind("images", _struct("section_id", "image_path", "caption"), to_section, (("captioned", "caption:"), ("plain", "image_path:"), ("empty", "")), "section_id"),
        # the second reading of the ids tells how many there are
        "group": Kind("table_groups", _struct("source_table_ids", "group_id"), {"source_table_ids": lambda t: F.when(list_state(t) != "", F.concat(links_state(t, tables), F.lit("_"), list_state(t)))},
                      (("many", "source_table_ids:[a-z]+_many"), ("single", "source_table_ids:[a-z]+_single"), ("empty", "")), "source_table_ids"),
    }


def code_kinds() -> dict[str, Kind]:
    """The kinds of objects in code_records; a block's page refs are to be among its record's."""
    refs = F.col("location.page_refs")
    fields = T.StructType().add("text", T.StringType()).add("raw_rows", T.StringType()).add("image_ref", _struct("image_id").add("path", T.StringType()).add("caption", T.StringType())).add("location", _struct("page_refs"))
    two = "(?:text:.*raw_rows:)|(?:text:.*image_ref:)|(?:raw_rows:.*image_ref:)"
    return {"block": Kind("content_blocks", fields, {"raw_rows": grid_state, "location.page_refs": lambda t: F.when(among_state(t, refs) != "none", among_state(t, refs))},
                          (("mixed", two), ("text", "text:"), ("table", "raw_rows:"), ("image", "image_ref:"), ("empty", "")), "page_refs")}


def members(records: DataFrame, kinds: dict[str, Kind]) -> DataFrame:
    """(record_id, child_kind, variant, child_pos, link): what the objects of all variant tables share, read from their states."""
    out = None
    for name, kind in kinds.items():
        part = records.select("record_id", F.posexplode(kind.states()).alias("_pos", "state"))
        link = F.regexp_extract(kind.link_of(F.col("state")), "^[a-z]+", 0)
        part = part.select("record_id", F.lit(name).alias("child_kind"), kind.variant_of(F.col("state")).alias("variant"), (F.col("_pos") + 1).cast("int").alias("child_pos"), link.alias("link"))
        out = part if out is None else out.union(part)
    return out


def link_report(dtc_records: DataFrame, code_records: DataFrame) -> DataFrame:
    """(record_id, child_kind, variant, child_pos, link): the keys and links of all variant tables whose objects have links.

    A record delivered again has the same links; its rows come out once.
    """
    linked = {n: k for n, k in dtc_kinds().items() if n != "section"}
    return members(dtc_records, linked).union(members(code_records, code_kinds())).where("record_id is not null")


def broken_links(dtc_records: DataFrame, code_records: DataFrame) -> DataFrame:
    """(record_id, child_kind, child_pos) of every child whose link leads nowhere or is ambiguous.

    Rows are narrow by the time records delivered again are dropped.
    """
    broken = link_report(dtc_records, code_records).where("link in ('missing', 'ambiguous')")
    return broken.select("record_id", "child_kind", "child_pos").distinct()


def _routed(records: DataFrame, name: str, kind: Kind) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All objects of a kind with variant and link, and the same by variant."""
    rows = _children(records, kind.array, state=kind.states())
    rows = rows.withColumn("variant", kind.variant_of(F.col("state"))).withColumn("link", F.regexp_extract(kind.link_of(F.col("state")), "^[a-z]+", 0))
    return rows, {f"{name}_{v}": rows.where(F.col("variant") == v) for v, _ in kind.variants}


def _elements(rows: DataFrame, array: str, keys: list[str], name: str) -> DataFrame:
    """A child table of the members of an array of leaves, with their 1-based places."""
    found = rows.select(*keys, F.posexplode(array).alias("_no", name))
    return found.select(*keys, (F.col("_no") + 1).alias("no"), name)


def _parts(name: str, fields: tuple[str, ...]) -> list[Column]:
    return [F.col(f"{name}.{f}").alias(f"{name}_{f}") for f in fields]


def dtc_tables(records: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of dtc_records.

    record, record_code, record_note, record_warning, page_ref; section, table, table_group, image and their variants (``section_typed`` and so on);
    section_marker, table_row, table_page_ref, table_flag, group_table.
    """
    records = once(records)
    kinds = dtc_kinds()
    scalars = [f.name for f in records.schema.fields if not isinstance(f.dataType, T.ArrayType | T.StructType)]
    out = {
        "record": records.select(*scalars, *(F.col(f"location.{c}").alias(c) for c in ("start_pdf_page", "end_pdf_page", "section_code")), *_parts("extraction", ("status", "ocr_used", "page_ref_confidence"))),
        "record_code": _elements(records, "codes", RECORD_KEYS, "code"),
        "record_note": _elements(records, "notes", RECORD_KEYS, "note"),
        "record_warning": _elements(records, "extraction.warnings", RECORD_KEYS, "warning"),
        "page_ref": records.select(*RECORD_KEYS, F.posexplode("location.page_refs").alias("ref_no", "page_ref")),
    }
    shape = {
        "section": ["section_id", "heading", "role", "oem_content_id", "cleaned_text", "page_start", "page_end", "has_type_variants"],
        "table": ["table_id", "section_id", F.col("link").alias("section_link"), "heading_nearby", "role", "start_pdf_page", "end_pdf_page", *_parts("extraction", ("confidence", "header_rows_hint", "partial"))],
        "image": ["image_id", "section_id", F.col("link").alias("section_link"), "pdf_page", "page_ref", "image_path", "caption", "role"],
        "group": ["group_id", "section_id", F.col("link").alias("tables_link")],
    }
    for name, kind in kinds.items():
        rows, by_variant = _routed(records, name, kind)
        columns = [*RECORD_KEYS, "pos", "variant", *shape[name]]
        out["table_group" if name == "group" else name] = rows.select(*columns)
        out |= {n: r.select(*columns) for n, r in by_variant.items()}
        if name == "section":
            out["section_marker"] = _elements(rows, "type_markers_detected", [*RECORD_KEYS, "pos", "section_id"], "marker")
        elif name == "table":
            keys = [*RECORD_KEYS, "pos", "table_id"]
            out["table_row"] = rows.select(*RECORD_KEYS, F.col("pos").alias("table_pos"), "table_id", "variant", F.posexplode("raw_rows").alias("row_no", "cells"))
            out["table_page_ref"] = _elements(rows, "page_refs", keys, "page_ref")
            out["table_flag"] = _elements(rows, "extraction.quality_flags", keys, "flag")
        elif name == "group":
            out["group_table"] = rows.select(*RECORD_KEYS, F.col("pos").alias("group_pos"), "group_id", F.posexplode("source_table_ids").alias("ref_no", "table_id"))
    return out


def code_tables(records: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of code_records.

    record, record_warning, identifier, page_ref; block (supertype) and its subtypes block_text, block_table, block_image, block_mixed and block_empty;
    table_row, block_page_ref, block_warning, block_flag and block_extraction_warning.
    """
    records = once(records)
    block, by_variant = _routed(records, "block", code_kinds()["block"])
    keys = [*RECORD_KEYS, "pos", "block_id"]
    common = [*keys, "block_type", "heading", "role", "variant", F.col("link").alias("page_link"), *_parts("location", ("start_pdf_page", "end_pdf_page")), *_parts("extraction", ("status",))]
    quality, image = _parts("table_quality", ("status", "confidence")), ["image_ref.image_id", "image_ref.path", "image_ref.caption", "image_ref.pdf_page"]
    kept = {"text": ["text"], "table": quality, "image": image, "mixed": ["text", *quality, *image], "empty": []}
    return {
        "record": records.select(*(f.name for f in records.schema.fields if not isinstance(f.dataType, T.ArrayType | T.StructType)), *(F.col(f"location.{c}").alias(c) for c in ("start_pdf_page", "end_pdf_page", "section_ref")),
                                 *_parts("extraction", ("status", "confidence", "ocr_used"))),
        "record_warning": _elements(records, "extraction.warnings", RECORD_KEYS, "warning"),
        "identifier": _children(records, "identifiers"),
        "page_ref": records.select(*RECORD_KEYS, F.posexplode("location.page_refs").alias("ref_no", "page_ref")),
        "block": block.select(*common),
        **{n: r.select(*common, *kept[n.removeprefix("block_")]) for n, r in by_variant.items()},
        "table_row": block.select(*keys, F.posexplode("raw_rows").alias("row_no", "cells")),
        "block_page_ref": block.select(*keys, F.posexplode("location.page_refs").alias("ref_no", "page_ref")),
        "block_warning": _elements(block, "table_quality.warnings", keys, "warning"),
        "block_flag": _elements(block, "table_quality.flags", keys, "flag"),
        "block_extraction_warning": _elements(block, "extraction.warnings", keys, "warning"),
    }


def shape_counts(dtc_records: DataFrame, code_records: DataFrame) -> DataFrame:
    """(item_kind, state, n): the automaton's states of every kind of object and how often each occurs."""
    out = None
    for source, arrays in ((dtc_records, ("sections", "tables", "table_groups", "images")), (code_records, ("identifiers", "content_blocks"))):
        source = once(source)
        for array in arrays:
            kind = source.schema[array].dataType.elementType
            part = (source.select(F.explode(F.transform(array, lambda x: tree_state(x, kind))).alias("state"))
                    .groupBy("state").agg(F.count("*").alias("n")).select(F.lit(array).alias("item_kind"), "state", "n"))
            out = part if out is None else out.union(part)
    return out
