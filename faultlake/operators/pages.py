"""Pages, sections and zones of a manual: forward fills, record runs, zones, images and page verification.

Windows are partitioned by document and ordered by page; a document is a manual, so a window holds its pages only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.functions import text as T

# Section headings with their roles, and lines that are bold but no headings.
HEADINGS = (
    ("Description", "description"), ("DTC Logic", "dtc_logic"), ("DTC Confirmation Procedure", "dtc_confirmation_procedure"),
    ("Diagnosis Procedure", "diagnosis_procedure"), ("Component Inspection", "component_inspection"),
)
NO_HEADING = (
    r"(?i)^(CAUTION|WARNING|DANGER|NOTE|IMPORTANT)\s*:?\s*$", r"^[A-Za-z ]{1,20}:\s*$", r"^:", r"^[a-z]", r"^[•\-–—]",
    r"(?i)^[PBCU][0-9A-F]{4}[-–][PBCU][0-9A-F]{4}", r"(?i)^[PBCU][0-9A-F]{4}\s+\S", r"(?i)^[PBCU][0-9A-F]{4},", r".{30,}[.,]$",
    r".*[a-z].*[.)]$", r"\"\s*\.\s*$", r"(?i)^With\s+", r"(?i)^[PBCU][0-9A-F]{4}\.", r"^\[.*\]$",
    r"(?i)\b(the|a|an|of|with|using|for|to|in|on|at|by|from|and|or|but|if|that|which|this|these)\s*$",
)
LONGEST_HEADING, HEADER_CHARS, LEAST_IMAGE = 55, 300, 500


def _to_here(group: str, order: str):
    return W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)


def fill_types(pages: DataFrame, doc: str = "doc", page: str = "page", heading: str = "type_heading") -> DataFrame:
    """Pages with ``manual_type``: the last type heading up to the page."""
    return pages.withColumn("manual_type", F.last(heading, ignorenulls=True).over(_to_here(doc, page)))


def record_runs(starts: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, start_page, end_page): the pages a record runs on.

    A run goes on while the page's header names one of the record's codes, and stops before a page of another
    section prefix or another type. Runs of different records may overlap. A run never leaves the stretch of pages of
    one type it starts in, so the join is by document and stretch. A start whose page is unknown is a run of one page.
    ``starts``: doc, start_page, codes, prefix, type; ``pages``: doc, page, header, prefix, type.
    """
    w = W.partitionBy("doc").orderBy("page")
    changed = F.when((F.row_number().over(w) > 1) & F.lag("type").over(w).eqNullSafe(F.col("type")), 0).otherwise(1)
    p = pages.withColumn("_c", changed).select("doc", "page", F.upper(F.substring("header", 1, HEADER_CHARS)).alias("_head"), F.col("prefix").alias("_prefix"), F.col("type").alias("_type"),
                                               F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_stretch"))
    own = starts.join(p.select("doc", F.col("page").alias("start_page"), "_stretch", F.col("_type").alias("_own")), ["doc", "start_page"], "left")
    after = own.where(F.col("type").eqNullSafe(F.col("_own"))).join(p, ["doc", "_stretch"]).where("page > start_page")
    named = F.exists("codes", lambda c: F.contains(F.col("_head"), F.upper(c)))
    other = F.col("_prefix").isNotNull() & F.col("prefix").isNotNull() & (F.col("_prefix") != F.col("prefix"))
    stops = after.groupBy("doc", "start_page").agg(F.min(F.when(~F.coalesce(named, F.lit(False)) | F.coalesce(other, F.lit(False)), F.col("page"))).alias("stop"), F.max("page").alias("last"))
    return starts.join(stops, ["doc", "start_page"], "left").select(
        "doc", "start_page", F.coalesce(F.col("stop") - 1, F.col("last"), F.col("start_page")).cast("int").alias("end_page"))


def type_segments(pages: DataFrame) -> DataFrame:
    """(doc, record, segment, type, first_page, last_page): a record's run cut where the type changes."""
    w = W.partitionBy("doc", "record").orderBy("page")
    change = F.when((F.row_number().over(w) > 1) & F.lag("type").over(w).eqNullSafe(F.col("type")), 0).otherwise(1)
    cut = pages.withColumn("_c", change).withColumn("segment", F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return cut.groupBy("doc", "record", "segment").agg(F.first("type").alias("type"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))


def zones(breaks: DataFrame) -> DataFrame:
    """Breaks with ``zone_end``: the top of the next heading on the page, or the page's bottom."""
    w = W.partitionBy("page_id").orderBy("y_top", "ord")
    return breaks.withColumn("zone_end", F.coalesce(F.lead("y_top").over(w), F.col("page_height")))


def continue_sections(parts: DataFrame, record: str = "record", order: str = "ord") -> DataFrame:
    """Parts with the section open where they stand; parts before a record's first heading are left out."""
    return parts.withColumn("open_section", F.last("section", ignorenulls=True).over(_to_here(record, order))).where("open_section is not null")


def section_texts(parts: DataFrame) -> DataFrame:
    """(record, section, cleaned_text): parts joined by a blank line; null where nothing is left."""
    joined = parts.groupBy("record", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n\n").alias("t"))
    return joined.select("record", "section", T.none_if_blank(T.trim_ws(F.col("t"))).alias("cleaned_text"))


def known_headings(lines: DataFrame) -> DataFrame:
    """(page_id, ord, heading, role): first line of each known heading on each page."""
    listed = lines.sparkSession.createDataFrame([(h.lower(), h, r) for h, r in HEADINGS], "key string, heading string, role string")
    hits = lines.withColumn("key", T.normal_heading(F.col("text"))).join(F.broadcast(listed), "key")
    return hits.groupBy("page_id", "heading", "role").agg(F.min("ord").alias("ord"))


def unknown_headings(lines: DataFrame) -> DataFrame:
    """Lines that look like headings but are unknown: all bold, short, two words or more, no furniture, no excluded form."""
    text = T.trim_ws(F.col("text"))
    excluded = F.lit(False)
    for pattern in NO_HEADING:
        excluded = excluded | text.rlike(pattern)
    known = T.normal_heading(text).isin(*(h.lower() for h, _ in HEADINGS))
    return lines.where(F.col("all_bold") & (F.length(text) <= LONGEST_HEADING) & (F.size(F.split(T.collapse_ws(text), " ")) >= 2) & ~T.is_noise(text) & ~excluded & ~known)


def headings_by_record(lines: DataFrame) -> DataFrame:
    """(record, headings): distinct unknown headings of a record, sorted."""
    return lines.groupBy("record").agg(F.array_sort(F.collect_set("text")).alias("headings"))


def images_to_sections(images: DataFrame, sections: DataFrame, doc: str = "doc") -> DataFrame:
    """Images with the last section that starts on or before their page; ``sections``: doc, idx, page_start, section_id."""
    tagged = sections.select(doc, F.col("page_start").alias("_at"), F.struct("page_start", "idx", "section_id").alias("_s"), F.lit(None).cast("long").alias("image"))
    shown = images.select(doc, F.col("page").alias("_at"), F.lit(None).cast(tagged.schema["_s"].dataType).alias("_s"), "image")
    w = W.partitionBy(doc).orderBy(F.col("_at"), F.col("image").isNotNull(), F.col("_s.idx")).rowsBetween(W.unboundedPreceding, W.currentRow)
    both = tagged.unionByName(shown).withColumn("_last", F.max("_s").over(w))
    return both.where("image is not null").select(doc, "image", F.col("_at").alias("page"), F.col("_last.section_id").alias("section_id"))


def captions(images: DataFrame, spans: DataFrame) -> DataFrame:
    """(page_id, image, caption): first span in document order that is an image id near the image's lower edge."""
    ids = spans.where(T.trim_ws(F.col("text")).rlike(T.IMAGE_ID)).select("page_id", "ord", "y0", T.trim_ws(F.col("text")).alias("caption"))
    near = images.join(ids, "page_id").where("y0 >= y1 - 40 and y0 <= y1 + 60")
    return near.groupBy("page_id", "image").agg(F.min_by("caption", "ord").alias("caption"))


def large_images(images: DataFrame) -> DataFrame:
    return images.where((F.col("width") >= LEAST_IMAGE) & (F.col("height") >= LEAST_IMAGE))


def dedup_images(images: DataFrame) -> DataFrame:
    """Images of a document once for each xref (the first record owns it), with the file name of the first equal content.

    ``images``: doc, ord, xref, md5, width, height, name. An xref counts as seen before its size is looked at.
    """
    first = images.groupBy("doc", "xref").agg(F.min(F.struct("ord", "md5", "width", "height", "name")).alias("f")).select("doc", "xref", "f.*")
    large = large_images(first)
    names = large.groupBy("doc", "md5").agg(F.min_by("name", "ord").alias("file_name"))
    return large.join(names, ["doc", "md5"]).select("doc", "xref", "ord", "md5", "file_name")


def page_codes_verified(pages: DataFrame) -> DataFrame:
    """Pages with code_match, detected_ref, confidence and warning. ``pages``: page, header, footer, codes, expected_ref."""
    head = F.upper(F.substring("header", 1, HEADER_CHARS))
    code = F.coalesce(F.exists("codes", lambda c: F.contains(head, F.upper(c))), F.lit(False))
    seen = T.footer_ref(F.col("footer"))
    both = seen.isNotNull() & F.col("expected_ref").isNotNull()
    same = both & (F.upper(seen) == F.upper("expected_ref"))
    level = F.when(code & same, "high").when(code & ~both, "medium").when(~code & same, "low").otherwise("conflict")
    out = pages.withColumn("code_match", code).withColumn("detected_ref", seen).withColumn("confidence", level)
    return out.withColumn("warning", verification_warning())


def verification_warning() -> Column:
    """Text for a page whose confidence is not high, null for the others."""
    start = F.concat(F.lit("page_ref_confidence="), F.col("confidence"), F.lit(" on PDF page "), F.col("page").cast("string"), F.lit(": "))
    seen, want = F.col("detected_ref"), F.col("expected_ref")
    refs = (F.when(seen.isNotNull() & want.isNotNull(), F.concat(F.lit("index ref='"), want, F.lit("', footer ref='"), seen, F.lit("'")))
            .when(want.isNotNull(), F.concat(F.lit("index ref='"), want, F.lit("', no footer ref detected")))
            .when(seen.isNotNull(), F.concat(F.lit("no index ref, footer ref='"), seen, F.lit("'"))))
    head = F.when(F.col("code_match"), "DTC code confirmed in header").otherwise("DTC code NOT found in header")
    return (F.when(F.col("confidence") == "medium", F.concat(start, F.lit("DTC code confirmed in header, no printed page ref detected")))
            .when(F.col("confidence") == "low", F.concat(start, F.lit("footer ref '"), seen, F.lit("' matches index but DTC code not found in page header")))
            .when(F.col("confidence") == "conflict", F.concat(start, F.concat_ws("; ", head, refs))))


def record_types(pages: DataFrame) -> DataFrame:
    """(doc, types): distinct types other than null, sorted."""
    return pages.groupBy("doc").agg(F.array_sort(F.collect_set("manual_type")).alias("types"))


def section_codes(pages: DataFrame) -> DataFrame:
    """(doc, codes): distinct section prefixes in order of their first page."""
    first = pages.where("prefix is not null").groupBy("doc", "prefix").agg(F.min("page").alias("page"))
    return first.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "prefix"))), lambda x: x["prefix"]).alias("codes"))
