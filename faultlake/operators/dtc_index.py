"""Fault-code index pages: locating the index, reading its rows and resolving codes to pages.

Joins are by document or page plus a band, so Spark uses hash or sort-merge joins with the band as the
residual; order-dependent rules run as folds over arrays sorted by an explicit ordinal, one array for each table of a page.
Ties are always broken by the ordinal. Codes without a page are left out. A reference or page means one of its own manual: tables
of several manuals have a ``doc`` column, which is part of every key; tables of one manual may leave it out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.functions import text as T
from faultlake.session import map_groups

# Headings that open a code index, and those too ambiguous for bookmarks.
HEADINGS = (
    "dtc index", "dtc list", "dtc table", "dtc chart", "dtc lookup table", "dtc inspection index",
    "diagnostic trouble code list", "diagnostic trouble code chart", "diagnostic trouble code index", "trouble code list",
    "fault code list", "fault code table", "error code list", "self-diagnosis results", "self-diagnostic results", "symptom/dtc index",
)
AMBIGUOUS = ("self-diagnosis results", "self-diagnostic results")
STRICT_HEADINGS = tuple(h for h in HEADINGS if h not in AMBIGUOUS)
ROW_BAND, LINK_BAND, BLOCK_GAP, LINE_BAND = 4.0, 20.0, 40.0, 3.0


def _doc(table: DataFrame) -> list[str]:
    """The manual as part of a key, where the table has several."""
    return ["doc"] if "doc" in table.columns else []


def mentions_index(text: Column, headings: tuple[str, ...] = HEADINGS) -> Column:
    """Cheap test before anything else is read from a page."""
    low = F.lower(text)
    out = F.lit(False)
    for h in headings:
        out = out | F.contains(low, F.lit(h))
    return out


def heading_y(blocks: DataFrame) -> DataFrame:
    """(page_id, y): bottom of the first block whose first line is an index heading, else top of the first header block."""
    low = F.lower(T.trim_ws(F.col("text")))
    exact = T.trim_ws(F.substring_index(low, "\n", 1)).isin(*HEADINGS)
    header = F.contains(low, F.lit("dtc")) & (F.contains(low, F.lit("display item")) | F.contains(low, F.lit("refer to")))
    found = blocks.select("page_id", "ord", F.when(exact, F.struct(F.lit(0).alias("rank"), "ord", F.col("y1").alias("y")))
                          .when(header, F.struct(F.lit(1).alias("rank"), "ord", F.col("y0").alias("y"))).alias("hit"))
    return found.groupBy("page_id").agg(F.min("hit").alias("hit")).where("hit is not null").select("page_id", "hit.y")


def choose_table(tables: DataFrame, headings: DataFrame) -> DataFrame:
    """(page_id, ord): the index table below the heading; one with a reference column is preferred.

    Without one, the first table is taken unless its header speaks of descriptions, actions, malfunctions or factors.
    """
    header = F.lower(F.array_join(F.transform("header", lambda c: F.coalesce(c, F.lit(""))), " | "))
    below = tables.join(headings, "page_id").where("y0 >= y").select("page_id", "ord", header.alias("h"))
    ranked = below.groupBy("page_id").agg(
        F.min(F.when(F.contains("h", F.lit("reference")), F.col("ord"))).alias("with_ref"), F.min_by("h", "ord").alias("first_header"), F.min("ord").alias("first"))
    other = F.col("first_header").rlike("description|action|malfunction|factor")
    return ranked.select("page_id", F.coalesce("with_ref", F.when(~other, F.col("first"))).alias("ord")).where("ord is not null")


def table_format(header: Column) -> Column:
    """A if a header cell speaks of DTC, else B."""
    return F.when(F.exists(header, lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit("dtc"))), "A").otherwise("B")


def reference_column(header: Column) -> Column:
    """0-based place of the first header cell with 'reference', else the last cell."""
    hits = F.transform(header, lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit("reference")))
    return F.when(F.array_position(hits, True) > 0, F.array_position(hits, True) - 1).otherwise(F.size(header) - 1).cast("int")


def in_reference_zone(x0: Column, table_x0: Column, table_x1: Column) -> Column:
    """Links in the right two fifths of the table."""
    return x0 >= table_x0 + (table_x1 - table_x0) * 0.60


def title_of(cells: Column) -> Column:
    """Words right of a code up to a dash, cross, number or code; bullets are skipped; the first reference ends the row.

    Returns a struct (title, ref). ``cells`` are the words of the visual line in order.
    """
    start = F.struct(F.array().cast("array<string>").alias("words"), F.lit(False).alias("closed"), F.lit(None).cast("string").alias("ref"))

    def step(s, c):
        ref = T.none_if_blank(F.regexp_extract(c, r"(?i)^[A-Z]{2,10}-\d+", 0))
        stop = c.rlike(r"(?i)^[×—x]$") | c.rlike(r"(?U)^\d+$") | F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", "")).rlike(T.DTC_CODE)
        bullet = c.rlike(r"^[•·‣◦]$")
        return F.when(s["ref"].isNotNull(), s).when(ref.isNotNull(), F.struct(s["words"].alias("words"), s["closed"].alias("closed"), ref.alias("ref"))).otherwise(F.struct(
            F.when(s["closed"] | stop | bullet, s["words"]).otherwise(F.concat(s["words"], F.array(c))).alias("words"),
            (s["closed"] | (stop & ~bullet)).alias("closed"), s["ref"].alias("ref")))

    return F.aggregate(cells, start, step, lambda s: F.struct(T.without_code_echo(F.array_join(s["words"], " "), ignore_case=True).alias("title"), s["ref"].alias("ref")))


def codes_with_y(words: DataFrame, min_y: float | Column = 0.0, form: str = "A") -> DataFrame:
    """(page_id, ord, code, y, title, ref) of every code word of a page.

    Form A: a code's row is the words of the same visual line (less than 3 points apart) to its right, in document order;
    bracket echoes are no codes. The self-join is by page and band. Form B: codes stand in brackets at the start of a word and have neither title nor reference.
    """
    usable = words.where(F.col("y0") >= min_y)
    if form == "B":
        code = F.upper(T.none_if_blank(F.regexp_extract("text", r"(?i)^\[([PBCU][0-9A-F]{4})\]", 1)))
        return usable.withColumn("code", code).where("code is not null").select("page_id", "ord", "code", F.col("y0").alias("y"), F.lit("").alias("title"), F.lit(None).cast("string").alias("ref"))
    code = usable.where(~F.col("text").rlike(r"(?i)^\[[PBCU][0-9A-F]{4}\]$")).withColumn("code", T.code_of(F.col("text"))).where("code is not null")
    right = words.select("page_id", F.col("ord").alias("w_ord"), F.col("x0").alias("w_x0"), F.col("y0").alias("w_y0"), T.trim_ws(F.col("text")).alias("w_text"))
    row = code.join(right, "page_id", "left").where((F.abs(F.col("w_y0") - F.col("y0")) < LINE_BAND) & (F.col("w_x0") > F.col("x1")) | F.col("w_ord").isNull() | (F.col("w_ord") == F.col("ord")))
    cells = row.groupBy("page_id", "ord", "code", "y0").agg(F.array_sort(F.collect_list(F.when(F.col("w_ord") != F.col("ord"), F.struct("w_ord", "w_text")))).alias("cells"))
    return cells.withColumn("t", title_of(F.transform("cells", lambda c: c["w_text"]))).select("page_id", "ord", "code", F.col("y0").alias("y"), "t.title", "t.ref")


def nearest_link(codes: DataFrame, links: DataFrame, band: float = LINK_BAND) -> DataFrame:
    """Each code row with the target of its nearest link within the band; ties go to the earlier link.

    ``codes``: page_id, code, y; ``links``: page_id, ord, mid, target. Unmatched codes have a null target.
    """
    near = codes.join(links, "page_id").where(F.abs(F.col("mid") - F.col("y")) <= band)
    best = near.groupBy("page_id", "code", "y").agg(F.min(F.struct(F.abs(F.col("mid") - F.col("y")).alias("d"), "ord", "target")).alias("m"))
    return codes.join(best, ["page_id", "code", "y"], "left").select(*codes.columns, F.col("m.target").alias("target"))


def resolve_page(matches: DataFrame, footer_map: DataFrame, drop_unresolved: bool) -> DataFrame:
    """Pages of matches: the link's page where its reference agrees (or none is printed), else the footer map's.

    ``matches``: ref, link_ref, link_page; ``footer_map``: page_ref, page. References agree regardless of case, the map is
    exact. Where the map fails too, the mismatched link is kept unless ``drop_unresolved``.
    """
    mismatch = F.col("ref").isNotNull() & F.col("link_ref").isNotNull() & (F.upper("ref") != F.upper("link_ref"))
    doc = _doc(matches)
    joined = matches.join(footer_map.select(*doc, F.col("page_ref").alias("ref"), F.col("page").alias("_mapped")), [*doc, "ref"], "left")
    page = F.when(F.col("link_page").isNull(), F.col("_mapped")).when(mismatch, F.coalesce("_mapped", F.lit(None).cast("int") if drop_unresolved else F.col("link_page"))).otherwise(F.col("link_page"))
    return joined.select(*matches.columns, page.alias("page"))


def merge_groups_with_links(rows: DataFrame, links: DataFrame, footer_map: DataFrame) -> DataFrame:
    """Rows of an index table with the pages of their reference groups: ([doc,] table_id, row_no, code, page, ref).

    A row with a reference opens a group and takes the next unused link; links that lead to the same place are
    used up with it. A link whose printed reference differs is left for the group that owns it, and the group goes to the
    footer map. Rows without reference inherit page and reference. One ordered fold for each table over its own rows and links.
    """
    doc = _doc(rows)
    key = [*doc, "table_id"]
    mapped = rows.join(footer_map.select(*doc, F.col("page_ref").alias("ref"), F.col("page").alias("mapped")), [*doc, "ref"], "left")
    r = mapped.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("row_no", "code", "has_ref", "ref", "mapped"))).alias("rows"))
    k = links.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("y0", "ord", "link_ref", "link_page", "dest"))).alias("links"))
    both = r.join(k, key, "left").withColumn("links", F.coalesce("links", F.array().cast(k.schema["links"].dataType)))
    state = F.struct(F.lit(0).alias("next"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("ref"),
                     F.array().cast("array<struct<row_no:bigint,code:string,page:int,ref:string>>").alias("out"))

    def step(s, x):
        link = F.get(F.col("links"), s["next"])
        there = s["next"] < F.size("links")
        differs = x["ref"].isNotNull() & link["link_ref"].isNotNull() & (F.upper(x["ref"]) != F.upper(link["link_ref"]))
        taken = there & ~F.coalesce(differs, F.lit(False))
        rest = F.slice(F.col("links"), s["next"] + 2, F.greatest(F.size("links") - s["next"] - 1, F.lit(0)))
        # how many of the following links lead to the same place, one after another
        run = F.aggregate(rest, F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda a, y: F.when(
            a["go"] & (y["dest"] == link["dest"]), F.struct((a["n"] + 1).alias("n"), F.lit(True).alias("go"))).otherwise(F.struct(a["n"].alias("n"), F.lit(False).alias("go"))), lambda a: a["n"])
        opens = x["has_ref"]
        page = F.when(~opens, s["page"]).when(taken, link["link_page"].cast("int")).otherwise(x["mapped"].cast("int"))
        ref = F.when(opens, x["ref"]).otherwise(s["ref"])
        after = F.when(opens & taken, s["next"] + 1 + run).otherwise(s["next"])
        row = F.struct(x["row_no"].cast("bigint").alias("row_no"), x["code"].alias("code"), page.alias("page"), ref.alias("ref"))
        return F.struct(after.alias("next"), page.alias("page"), ref.alias("ref"), F.concat(s["out"], F.array(row)).alias("out"))

    done = both.select(*key, F.aggregate("rows", state, step, lambda s: s["out"]).alias("out"))
    return done.select(*key, F.explode("out").alias("o")).select(*key, "o.*").where("page is not null")


def carry_reference(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Rows with the reference and page of the last row that had one; rows before any are left out."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    marked = rows.withColumn("grp", F.count("ref").over(w))
    inside = W.partitionBy(group, "grp")
    return (marked.withColumn("group_ref", F.max("ref").over(inside)).withColumn("group_page", F.max(F.when(F.col("ref").isNotNull(), F.col("page"))).over(inside))
            .where("grp > 0 and group_page is not null").drop("grp"))


def visual_rows(words: DataFrame, group: str, tolerance: float = ROW_BAND) -> DataFrame:
    """(group, ord, row_no): words clustered by distance to the first word of the row (an anchor, so no lag)."""
    sorted_words = words.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("y0", "ord"))).alias("w"))
    start = F.struct(F.lit(-1).alias("row"), F.lit(None).cast("double").alias("anchor"), F.array().cast("array<struct<ord:bigint,row_no:int>>").alias("out"))

    def step(s, x):
        new = s["anchor"].isNull() | (F.abs(x["y0"] - s["anchor"]) > tolerance)
        row = F.when(new, s["row"] + 1).otherwise(s["row"])
        return F.struct(row.alias("row"), F.when(new, x["y0"]).otherwise(s["anchor"]).alias("anchor"),
                        F.concat(s["out"], F.array(F.struct(x["ord"].cast("bigint").alias("ord"), row.alias("row_no")))).alias("out"))

    return sorted_words.select(group, F.explode(F.aggregate("w", start, step, lambda s: s["out"])).alias("o")).select(group, "o.*")


def blocks_by_gap(rows: DataFrame, group: str, y: str, order: list[str], gap: float = BLOCK_GAP) -> DataFrame:
    """Rows with ``block``: a new block begins after a gap."""
    w = W.partitionBy(group).orderBy(*order)
    jump = F.when(F.col(y) - F.lag(y).over(w) > gap, 1).otherwise(0)
    return rows.withColumn("_jump", jump).withColumn("block", F.sum("_jump").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_jump")


def index_runs(pages: DataFrame) -> DataFrame:
    """(doc, page, run): index pages with the pages that continue them, up to the next heading or page without codes.

    ``pages``: doc, page, has_heading, has_codes. A run begins at a heading.
    """
    w = W.partitionBy("doc").orderBy("page").rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = pages.withColumn("run", F.sum(F.col("has_heading").cast("int")).over(w)).where("run > 0")
    inside = W.partitionBy("doc", "run").orderBy("page").rowsBetween(W.unboundedPreceding, W.currentRow)
    return numbered.withColumn("_gap", F.max(F.when(~F.col("has_codes") & ~F.col("has_heading"), 1).otherwise(0)).over(inside)).where("_gap = 0").select("doc", "page", "run")


def codes_by_page(index: DataFrame) -> DataFrame:
    """([doc,] page, codes, page_ref): distinct codes in index order and the first claimed reference of each page."""
    key = [*_doc(index), "page"]
    first = index.groupBy(*key, "code").agg(F.min("seq").alias("seq"))
    codes = first.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "code"))), lambda x: x["code"]).alias("codes"))
    refs = index.groupBy(*key).agg(F.min_by(F.col("page_ref"), F.when(F.col("page_ref").isNotNull(), F.col("seq"))).alias("page_ref"))
    return codes.join(refs, key)


def pages_by_code(index: DataFrame) -> DataFrame:
    """([doc,] code, pages, page_refs, title): distinct pages in order with their references, title of the first mention."""
    key = [*_doc(index), "code"]
    once = index.groupBy(*key, "page").agg(F.min(F.struct("seq", "page_ref")).alias("f"), F.min(F.struct("seq", "title")).alias("t"))
    lists = once.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("f.seq").alias("seq"), "page", F.col("f.page_ref").alias("page_ref")))).alias("x"), F.min("t").alias("t"))
    return lists.select(*key, F.transform("x", lambda p: p["page"]).alias("pages"), F.transform("x", lambda p: p["page_ref"]).alias("page_refs"), F.col("t.title").alias("title"))


def union_of_pages(index: DataFrame) -> DataFrame:
    """([doc,] code, page, seq): what the index pages list, a repeated code and page once, at its first place."""
    return index.groupBy(*_doc(index), "code", "page").agg(F.min("seq").alias("seq"))


def footer_map(pages: DataFrame) -> DataFrame:
    """([doc,] page_ref, page): the last page that prints a reference."""
    return pages.where("page_ref is not null").groupBy(*_doc(pages), "page_ref").agg(F.max("page").alias("page"))


def bookmark_pages(toc: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, page) of bookmarks whose title contains an unambiguous index heading."""
    return toc.where(mentions_index(F.col("title"), STRICT_HEADINGS)).select(doc, "page").distinct()


def link_texts(links: DataFrame, words: DataFrame) -> DataFrame:
    """(page_id, link_ord, ref_text): the reference printed under each link's rectangle."""
    inside = links.join(words, "page_id").where("x1 > lx0 and x0 < lx1 and y1 > ly0 and y0 < ly1")
    text = inside.groupBy("page_id", "link_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda w: w["text"]), " ").alias("t"))
    return text.select("page_id", "link_ord", T.ref_in(F.col("t")).alias("ref_text")).where("ref_text is not null")


def words_right(words: DataFrame, together: bool = False) -> DataFrame:
    """(page_id, ord, n): how many words begin right of a word on its line, less than LINE_BAND points above or below; words with none are left out.

    A page is sorted by height once and each word compared with those after it while they are within the band, so pages are never joined with themselves.
    ``together``: the words of a page are one after another already.
    """
    # what is null is right of nothing, or has nothing right of it
    known = words.where("page_id is not null and y0 is not null").select("page_id", "ord", *(F.coalesce(F.col(c).cast("double"), F.lit(at)).alias(c) for c, at in (("x0", -np.inf), ("x1", np.inf))), F.col("y0").cast("double").alias("y0"))

    def run(rows: pa.Table, sizes: np.ndarray) -> pa.Table:
        page, y = np.repeat(np.arange(len(sizes)), sizes), rows["y0"].to_numpy()
        order = np.lexsort((y, page))
        page, y, x0, x1 = page[order], y[order], rows["x0"].to_numpy()[order], rows["x1"].to_numpy()[order]
        n = ((x0 > x1) & (y - y < LINE_BAND)).astype(np.int64)  # a word that ends before it begins is right of itself
        i, step = np.arange(len(y)), 1
        while i.size:
            i = i[i + step < len(y)]
            i = i[(page[i + step] == page[i]) & (y[i + step] - y[i] < LINE_BAND)]
            n[i] += x0[i + step] > x1[i]
            n[i + step] += x0[i] > x1[i + step]
            step += 1
        some = np.flatnonzero(n)
        found = rows.select(["page_id", "ord"]).take(order[some]).append_column("n", pa.array(n[some]))
        return found.group_by(["page_id", "ord"], use_threads=False).aggregate([("n", "sum")]).select(["page_id", "ord", "n_sum"]).rename_columns(["page_id", "ord", "n"])

    return map_groups(known, "page_id", run, ", ".join(f"{c} {words.schema[c].dataType.simpleString()}" for c in ("page_id", "ord")) + ", n long", together)


def common_prefix(titles: Column) -> Column:
    """Longest common prefix of whole words of an array of titles, '' if there is none."""
    split = F.transform(titles, lambda t: F.split(T.collapse_ws(t), " "))
    first = F.get(split, 0)
    depth = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(first), F.lit(1))), F.lit(0), lambda n, k: F.when(
        (n == k - 1) & F.forall(split, lambda s: F.coalesce(F.get(s, k - 1) == F.get(first, k - 1), F.lit(False))), k).otherwise(n))
    return F.when(F.size(titles) > 0, F.array_join(F.slice(first, 1, depth), " ")).otherwise("")


def record_title(titles: Column, n_codes: Column) -> Column:
    """Title of a record: the only one, or what its codes' titles share; side letters are stripped; null if nothing."""
    clean = F.filter(F.transform(F.filter(titles, lambda t: t.isNotNull() & (t != "")), lambda t: T.trim_ws(F.regexp_replace(t, "^[A-Z] ", ""))), lambda t: t != "")
    return F.when(F.size(clean) == 0, None).when(n_codes == 1, F.get(clean, 0)).otherwise(T.none_if_blank(common_prefix(clean)))
