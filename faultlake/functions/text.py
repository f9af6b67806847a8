"""Scalar text functions as Column expressions that stay inside the JVM.

Patterns follow the semantics of Unicode-aware regular expressions: ``(?U)`` makes \\w, \\s and \\d Unicode
classes, and 0x1C-0x1F count as white space. Null stays null unless a function says otherwise.
"""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WS = r"[\s\x1c-\x1f]"

# Patterns of codes, references and page furniture.
DTC_CODE = r"^[PBCU][0-9A-F]{4}$"
REF = r"(?i)[A-Z]{2,10}-\d+"
FOOTER_REF = r"\b([A-Z]{1,4}-\d+[A-Z]?)\b"
OEM_ID = r"INFOID:\d+"
IMAGE_ID = r"^[A-Z]{1,8}[0-9]{2,}[A-Z0-9]{0,8}$"
SIDEBAR_LINE = r"(?md)^[^\S\n]*[A-Z][^\S\n]*$"
NOISE = (
    r"(?i)^Revision:\s+",
    r"(?i)^<\s*DTC/CIRCUIT DIAGNOSIS\s*>$",
    r"^[A-Z]{1,4}-\d+[A-Z]?$",
    r"^[PBCU][0-9A-F]{4}\s+[A-Z][A-Z\s]*$",
    r"^\d{4}\s+[A-Z][A-Z\s]*$",
)
FAULT_LABEL = r"\bfaults?\b|\berrors?\b|\bfault code\b|\berror code\b"
PART_LABEL = r"part numbers?|part no\b|part#|part number"
P_CODE = r"\b[Pp]\d{3,}\b"
MAKER_CODE = r"\b\d{2}[A-Za-z0-9]{3,}\b"
PART_NUMBER = r"\b(?=[0-9A-Za-z-]*\d)([0-9A-Za-z-]{5,})\b"
ENGLISH_WORDS = r"(?iU)\b(the|and|is|are|in|on|for|with|that|this|it)\b"
TYPE_MARKER = r"(?i)\[TYPE [A-Z0-9]+\]"


def lit(pattern: str) -> Column:
    return F.lit(pattern)


def trim_ws(text: Column) -> Column:
    """Strip all white space at both ends, not blanks alone."""
    return F.regexp_replace(text, rf"(?U)^{WS}+|{WS}+$", "")


def collapse_ws(text: Column) -> Column:
    """Runs of white space become one blank; ends are stripped; null becomes ''."""
    return F.coalesce(trim_ws(F.regexp_replace(text, rf"(?U){WS}+", " ")), F.lit(""))


def none_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def dehyphenate(text: Column) -> Column:
    """Join a word broken by a hyphen at the end of a line."""
    return F.regexp_replace(text, r"(?U)(\w+)-\n([A-Za-z])", "$1$2")


def is_noise(line: Column) -> Column:
    """Page furniture by the five start-anchored patterns."""
    stripped = trim_ws(line)
    out = F.lit(False)
    for pattern in NOISE:
        out = out | stripped.rlike(pattern)
    return out


def clean_zone(text: Column, section_code: Column | None = None) -> Column:
    """Zone text: no content ids, side tabs, broken words, furniture lines, section-code lines or long gaps."""
    plain = F.regexp_replace(F.regexp_replace(text, OEM_ID, ""), SIDEBAR_LINE, "")
    lines = F.filter(F.split(dehyphenate(plain), "\n"), lambda x: ~is_noise(x))
    if section_code is not None:
        lines = F.filter(lines, lambda x: section_code.isNull() | (section_code == "") | (trim_ws(x) != section_code))
    return trim_ws(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def clean_cell(cell: Column) -> Column:
    """A table cell on one line."""
    return collapse_ws(F.regexp_replace(dehyphenate(cell), "\n", " "))


def normal_cell(cell: Column) -> Column:
    """A cell with white space collapsed line by line; null is ''."""
    return F.array_join(F.transform(F.split(F.coalesce(cell, F.lit("")), "\n"), collapse_ws), "\n")


def normal_heading(text: Column) -> Column:
    return F.lower(F.regexp_replace(trim_ws(text), rf"(?U){WS}+", " "))


def slug(text: Column) -> Column:
    """Lower case, other signs as single underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def canonical_stem(make: Column, model: Column, year: Column, section: Column, file_stem: Column) -> Column:
    """make_model_year_section without blank parts, or the file's stem in lower case."""
    parts = F.concat_ws("_", *(F.nullif(slug(F.coalesce(c, F.lit(""))), F.lit("")) for c in (make, model, year, section)))
    return F.coalesce(F.nullif(parts, F.lit("")), F.lower(file_stem))


def footer_ref(footer: Column) -> Column:
    return none_if_blank(F.regexp_extract(footer, FOOTER_REF, 1))


def ref_in(text: Column) -> Column:
    return none_if_blank(F.regexp_extract(text, REF, 0))


def record_id(document_id: Column, manual_type: Column, start_page: Column) -> Column:
    """First 16 hex digits of the hash of document, type and start page."""
    return F.substring(F.sha2(F.concat(document_id, F.coalesce(manual_type, F.lit("")), start_page.cast("string")), 256), 1, 16)


def code_of(text: Column) -> Column:
    """The fault code a cell holds once other signs are removed, or null."""
    plain = F.regexp_replace(F.upper(trim_ws(text)), "[^A-Z0-9]", "")
    return F.when(plain.rlike(DTC_CODE), plain)


def without_code_echo(title: Column, ignore_case: bool = False) -> Column:
    return trim_ws(F.regexp_replace(title, ("(?i)" if ignore_case else "") + r"\[[PBCU][0-9A-F]{4}\]", ""))


def is_english(text: Column) -> Column:
    """A common English word, or more than four fifths of the letters in ASCII. Null and '' are not."""
    letters = F.length(F.regexp_replace(text, r"\P{L}", ""))
    plain = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.coalesce((text != "") & (text.rlike(ENGLISH_WORDS) | ((letters > 0) & (plain / F.greatest(letters, F.lit(1)) > 0.8))), F.lit(False))


def title_case(text: Column) -> Column:
    """Each run of letters with a capital first letter and small ones after, also behind hyphens and digits."""
    parts = F.regexp_extract_all(text, F.lit(r"(?U)\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(parts, F.initcap), "")


def last_of_srcset(srcset: Column) -> Column:
    """URL of the last candidate of a srcset, or null."""
    parts = F.filter(F.transform(F.split(srcset, ","), trim_ws), lambda x: x != "")
    return F.when(F.size(parts) > 0, F.regexp_extract(F.element_at(parts, -1), r"^\S+", 0))


def image_candidate(data_src: Column, data_lazy_src: Column, data_srcset: Column, srcset: Column, src: Column) -> Column:
    """The best address of an image: lazy-loaded ones first, no inline SVG; a data-srcset is taken whole."""
    plain = F.when(~F.coalesce(src.startswith("data:image/svg+xml"), F.lit(False)), none_if_blank(src))
    return F.coalesce(none_if_blank(data_src), none_if_blank(data_lazy_src), none_if_blank(data_srcset), last_of_srcset(srcset), plain)


def is_fault_label(label: Column) -> Column:
    return F.lower(label).rlike(FAULT_LABEL)


def is_part_label(label: Column) -> Column:
    return F.lower(label).rlike(PART_LABEL)


def list_fault_codes(items: Column, label: Column) -> Column:
    """Fault codes of a list labelled as faults, P-codes first, in capitals; empty for other lists."""
    found = F.concat(F.regexp_extract_all(items, F.lit(P_CODE), F.lit(0)), F.regexp_extract_all(items, F.lit(MAKER_CODE), F.lit(0)))
    return F.when(F.coalesce(is_fault_label(label), F.lit(False)), F.transform(found, F.upper)).otherwise(F.array().cast("array<string>"))


def list_part_numbers(items: Column, label: Column) -> Column:
    """Part numbers of a list that gave no fault codes and is labelled as parts or has no P-code."""
    fault = F.coalesce(is_fault_label(label), F.lit(False))
    some = items.rlike(P_CODE) | (fault & items.rlike(MAKER_CODE))
    use = ~(some & fault) & (F.coalesce(is_part_label(label), F.lit(False)) | ~some)
    return F.when(use, F.regexp_extract_all(items, F.lit(PART_NUMBER), F.lit(1))).otherwise(F.array().cast("array<string>"))


def type_markers(text: Column) -> Column:
    """Distinct variant markers of a text in capitals, in order of appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TYPE_MARKER), F.lit(0)), F.upper))


def render_rows(rows: Column) -> Column:
    """Rows as lines with cells joined by ' | '."""
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, " | ", "")), "\n")


@F.pandas_udf(StringType())
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """href resolved against its page; null without href."""
    return pd.Series([None if not h else urljoin(b or "", h) for b, h in zip(base, href, strict=True)], dtype=object)

