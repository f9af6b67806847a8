"""Ruled tables: cells, merged cells, headers, continuation over pages, rebuilding from words, and quality.

Cells are kept in long form (table, row, col, value) where a rule looks along a column, and as arrays where it looks at
a row. '' means an empty cell. Half values round to even, as in the folds over word positions.
"""

from __future__ import annotations

from bisect import bisect_left
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.functions import text as T
from faultlake.session import map_groups

LOW, MEDIUM = ("blob_row_detected", "single_row_table", "single_column_table"), ("bbox_reconstruction_used", "outer_column_recovered", "bbox_clipped_by_drawings", "wide_bbox_uncorrected")
WORD_GAP, COLUMN_GAP, OVERLAP = 8.0, 5.0, 0.5


def _column(order: str = "row", to: int = -1):
    return W.partitionBy("tbl", "col").orderBy(order).rowsBetween(W.unboundedPreceding, to)


def clear_repeats(cells: DataFrame) -> DataFrame:
    """Cells without values that repeat the last filled value above them (merged cells)."""
    above = F.last(F.nullif(F.col("value"), F.lit("")), ignorenulls=True).over(_column())
    return cells.withColumn("value", F.when((F.col("value") != "") & (F.col("value") == above), "").otherwise(F.col("value")))


def fill_down_flags(cells: DataFrame, headers: int = 1) -> DataFrame:
    """(tbl, filled): whether an empty cell below the headers could be filled from the cell above it."""
    up = F.lag("value").over(W.partitionBy("tbl", "col").orderBy("row"))
    fillable = (F.col("row") > headers) & (F.col("value") == "") & (up != "")
    return cells.withColumn("_f", F.coalesce(fillable, F.lit(False))).groupBy("tbl").agg(F.max("_f").alias("filled"))


def filled_down(rows: Column, headers: Column) -> Column:
    """Rows with empty cells below the first data row filled from the row above, which may itself have been filled.

    Header rows and the first data row stay; a shorter row interrupts its missing columns. Null cells and rows count as empty.
    """
    plain = F.transform(F.coalesce(rows, F.array().cast("array<array<string>>")), lambda r: F.transform(F.coalesce(r, F.array().cast("array<string>")), lambda c: F.coalesce(c, F.lit(""))))
    start = F.struct(F.array().cast("array<string>").alias("above"), F.array().cast("array<array<string>>").alias("out"))

    def step(s, r):
        full = F.transform(r, lambda c, j: F.when((F.size(s["out"]) > headers) & (c == ""), F.coalesce(F.get(s["above"], j), F.lit(""))).otherwise(c))
        return F.struct(full.alias("above"), F.concat(s["out"], F.array(full)).alias("out"))

    return F.aggregate(plain, start, step, lambda s: s["out"])


def without_repeats(rows: Column) -> Column:
    """Rows without values that repeat the last filled value above them in their column; see ``clear_repeats`` for long tables of cells."""
    start = F.struct(F.array().cast("array<string>").alias("above"), F.array().cast("array<array<string>>").alias("out"))

    def step(s, r):
        wide = F.sequence(F.lit(1), F.greatest(F.size(r), F.size(s["above"]), F.lit(1)))
        last = F.transform(wide, lambda k: F.when(F.coalesce(F.get(r, k - 1), F.lit("")) != "", F.get(r, k - 1)).otherwise(F.get(s["above"], k - 1)))
        kept = F.transform(r, lambda c, j: F.when((c != "") & F.coalesce(c == F.get(s["above"], j), F.lit(False)), "").otherwise(c))
        return F.struct(last.alias("above"), F.concat(s["out"], F.array(kept)).alias("out"))

    return F.aggregate(rows, start, step, lambda s: s["out"])


def header_labels(rows: Column, headers: Column) -> Column:
    """One label for each column: the first row's, or with two header rows what both say, joined by a blank."""
    cell = lambda i, j: T.trim_ws(F.coalesce(F.get(F.get(rows, i), j), F.lit("")))
    n = F.greatest(F.size(F.get(rows, 0)), F.when(headers == 2, F.size(F.get(rows, 1))).otherwise(0), F.lit(0))
    both = lambda j: F.concat_ws(" ", T.none_if_blank(cell(0, j)), F.when(headers == 2, T.none_if_blank(cell(1, j))))
    return F.when(F.size(rows) > 0, F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), both)).otherwise(F.array().cast("array<string>")))


def reconstructed(rows: Column, blob: Column, codes: Column | None = None) -> Column:
    """Struct (headers, rows, steps): a table made readable by itself, and what was done to it; rows are null where nothing was.

    A blob row at the top is left out, empty cells are filled down below the headers, and values that repeat the one above are cleared.
    """
    none = F.array().cast("array<string>")
    body = F.transform(rows, lambda r: F.transform(F.coalesce(r, none), lambda c: F.coalesce(c, F.lit(""))))
    strip = F.coalesce(blob & is_blob_row(F.get(body, 0)), F.lit(False))
    used = F.when(strip, F.slice(body, 2, F.greatest(F.size(body) - 1, F.lit(0)))).otherwise(body)
    headers = header_rows(used, codes)
    filled = filled_down(used, headers)
    clear = without_repeats(filled)
    steps = F.array_compact(F.array(F.when(strip, "blob_row_stripped"), F.when(filled != used, "carry_forward_fill"), F.when(clear != filled, "merged_cell_dedup")))
    return F.struct(headers.alias("headers"), F.when(F.size(steps) > 0, clear).alias("rows"), steps.alias("steps"))


def is_subheader(row: Column, codes: Column | None = None) -> Column:
    """No cell is a known code, of a code's form, or a plain number; five-letter words have a code's form too."""
    def fits(cell: Column) -> Column:
        v = T.trim_ws(F.coalesce(cell, F.lit("")))
        data = v.rlike("^[A-Z][0-9A-Z]{4}$") | v.rlike(r"(?U)^\d+$")
        if codes is not None:
            data = data | F.coalesce(F.array_contains(codes, v), F.lit(False))
        return (v == "") | ~data
    return F.forall(row, fits)


def header_rows(rows: Column, codes: Column | None = None) -> Column:
    """1 or 2: the second row is a header if it fills gaps of the first, or the first has labels only above it."""
    first, second = F.get(rows, 0), F.get(rows, 1)
    a = lambda i: T.trim_ws(F.coalesce(F.get(first, i), F.lit("")))
    b = lambda i: T.trim_ws(F.coalesce(F.get(second, i), F.lit("")))
    places = F.sequence(F.lit(0), F.greatest(F.size(first), F.size(second), F.lit(1)) - 1)
    gap = F.exists(places, lambda i: (a(i) == "") & (b(i) != ""))
    both = F.exists(places, lambda i: (a(i) != "") & (b(i) != ""))
    labels = F.forall(first, lambda c: T.trim_ws(F.coalesce(c, F.lit(""))).rlike(r"^[A-Za-z\s]*$"))
    return F.when(F.size(rows) < 3, 1).when(~is_subheader(second, codes), 1).when(gap | (labels & both), 2).otherwise(1)


def is_partial(rows: Column, headers: Column, codes: Column | None = None) -> Column:
    """The row after the headers is one more sub-header."""
    following = F.get(rows, headers)
    return F.coalesce(following.isNotNull() & is_subheader(following, codes), F.lit(False))


def is_blob_start(rows: Column) -> Column:
    """The first cell of the first row holds several lines and the rest of the row nothing; more than one row."""
    first = F.get(rows, 0)
    return F.coalesce((F.size(rows) > 1) & F.contains(F.get(first, 0), F.lit("\n")) & F.forall(F.slice(first, 2, F.greatest(F.size(first) - 1, F.lit(0))), lambda c: F.coalesce(c, F.lit("")) == ""), F.lit(False))


def is_blob_row(row: Column) -> Column:
    """A first cell of more than 50 signs over several lines, the others blank."""
    first = T.trim_ws(F.get(row, 0))
    return F.coalesce((F.length(first) > 50) & F.contains(first, F.lit("\n")) & F.forall(F.slice(row, 2, F.greatest(F.size(row) - 1, F.lit(0))), lambda c: T.trim_ws(F.coalesce(c, F.lit(""))) == ""), F.lit(False))


def is_image_box(rows: Column) -> Column:
    """Nothing but image ids, dots and empty cells, and at least one id; null rows hold nothing."""
    cells = F.transform(F.flatten(F.filter(rows, lambda r: r.isNotNull())), lambda c: T.trim_ws(F.coalesce(c, F.lit(""))))
    return F.forall(cells, lambda c: c.isin("", ".") | c.rlike(T.IMAGE_ID)) & F.exists(cells, lambda c: c.rlike(T.IMAGE_ID))


def only_side_tabs(values: Column) -> Column:
    """Every filled value is a side tab of one to four capitals."""
    return F.forall(F.filter(values, lambda v: v != ""), lambda v: v.rlike("^[A-Z]{1,4}$"))


def confidence(flags: Column, reconstructed: Column) -> Column:
    """Lowest signal wins; a reconstructed table is medium at best."""
    return F.when(F.arrays_overlap(flags, F.array(*map(F.lit, LOW))), "low").when(F.arrays_overlap(flags, F.array(*map(F.lit, MEDIUM))) | reconstructed, "medium").otherwise("high")


def _stripped(row: Column) -> Column:
    filled = F.filter(F.transform(row, lambda c, i: F.when(c != "", i + 1)), lambda n: n.isNotNull())
    return F.slice(row, 1, F.coalesce(F.array_max(filled), F.lit(0)).cast("int"))


def headers_match(a: Column, b: Column) -> Column:
    """Equal without trailing empty cells, or the shorter, not empty, begins the longer."""
    x, y = _stripped(a), _stripped(b)
    n = F.least(F.size(x), F.size(y))
    return (x == y) | ((n > 0) & (F.slice(x, 1, n) == F.slice(y, 1, n)))


def continued_tables(tables: DataFrame) -> DataFrame:
    """(record, head, table_ids, pages, rows): runs of two or more tables that continue over pages.

    A table continues its run if it is in the head's section, on another page than the table before and under the head's
    header row, which is dropped. The comparison is with the head, so it is a fold over each record's tables in order.
    ``tables``: record, ord, table_id, section_id, page, rows.
    """
    fields = F.struct("ord", "table_id", "section_id", "page", "rows")
    ordered = tables.groupBy("record").agg(F.array_sort(F.collect_list(fields)).alias("t"))
    group = "struct<head:string,section_id:string,header:array<string>,page:int,table_ids:array<string>,pages:array<int>,rows:array<array<string>>>"

    def open_(x):
        return F.struct(x["table_id"].alias("head"), x["section_id"].alias("section_id"), F.get(x["rows"], 0).alias("header"), x["page"].cast("int").alias("page"),
                        F.array(x["table_id"]).alias("table_ids"), F.array(x["page"].cast("int")).alias("pages"), x["rows"].alias("rows")).cast(group)

    def step(s, x):
        g = F.element_at(s, -1)
        fits = F.coalesce((F.size(s) > 0) & x["section_id"].eqNullSafe(g["section_id"]) & (F.size(x["rows"]) > 0) & (F.size(g["rows"]) > 0)
                          & (x["page"] != g["page"]) & headers_match(F.get(x["rows"], 0), g["header"]), F.lit(False))
        longer = F.struct(g["head"].alias("head"), g["section_id"].alias("section_id"), g["header"].alias("header"), x["page"].cast("int").alias("page"),
                          F.concat(g["table_ids"], F.array(x["table_id"])).alias("table_ids"), F.concat(g["pages"], F.array(x["page"].cast("int"))).alias("pages"),
                          F.concat(g["rows"], F.slice(x["rows"], 2, F.greatest(F.size(x["rows"]) - 1, F.lit(0)))).alias("rows")).cast(group)
        return F.when(fits, F.concat(F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(s, F.array(open_(x))))

    # element_at on an empty array is null under try semantics only; the first table always opens a group
    def safe(s, x):
        return F.when(F.size(s) == 0, F.array(open_(x))).otherwise(step(s, x))

    folded = ordered.select("record", F.explode(F.aggregate("t", F.array().cast(f"array<{group}>"), safe)).alias("g"))
    return folded.select("record", "g.*").where(F.size("table_ids") > 1).select("record", "head", "table_ids", "pages", "rows")


def tables_in_zones(tables: DataFrame, zones: DataFrame) -> DataFrame:
    """(page_id, table_id, zone): tables of which at least half the area lies in a zone; tables without area are skipped."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    wide = F.greatest(F.least("x1", "zx1") - F.greatest("x0", "zx0"), F.lit(0.0))
    high = F.greatest(F.least("y1", "zy1") - F.greatest("y0", "zy0"), F.lit(0.0))
    return tables.where(area > 0).join(zones, "page_id").where(wide * high >= OVERLAP * area).select("page_id", "table_id", "zone")


def rule_extent(tables: DataFrame, rules: DataFrame) -> DataFrame:
    """Tables widened to the horizontal rules that cross their height: thin, 20 points wide or more."""
    thin = rules.where("ry1 - ry0 <= 3 and rx1 - rx0 >= 20")
    near = tables.join(thin, "page_id").where("ry0 <= y1 and ry1 >= y0").groupBy("page_id", "table_id").agg(F.min("rx0").alias("_l"), F.max("rx1").alias("_r"))
    return tables.join(near, ["page_id", "table_id"], "left").withColumn("rule_x0", F.least("x0", F.coalesce("_l", "x0"))).withColumn("rule_x1", F.greatest("x1", F.coalesce("_r", "x1"))).drop("_l", "_r")


def drawn_border(tables: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, table_id, bx0, bx1): hull of the dark border rules around a table, from at least two of them."""
    dark = rules.where("ry1 - ry0 <= 3 and rx1 - rx0 >= 20 and rx1 < page_width - 5 and coalesce(darkness, 0) < 0.3")
    near = tables.join(dark, "page_id").where("ry0 >= y0 - 20 and ry1 <= y1 + 20")
    return near.groupBy("page_id", "table_id").agg(F.min("rx0").alias("bx0"), F.max("rx1").alias("bx1"), F.count("*").alias("n")).where("n >= 2").drop("n")


def outer_words(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(table_id, row_no, side, text): words left and right of a table in each row's height, in reading order."""
    inside = rows.join(words, "page_id").where("(wy0 + wy1) / 2 >= ry0 and (wy0 + wy1) / 2 < ry1 and (wx0 < tx0 or wx0 >= tx1)")
    side = F.when(F.col("wx0") < F.col("tx0"), "left").otherwise("right")
    return inside.groupBy("table_id", "row_no", side.alias("side")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("wy0", "wx0", "ord", "text"))), lambda w: w["text"]), " ").alias("text"))


def row_ranges(cells: DataFrame) -> DataFrame:
    """(table_id, y0, y1): heights of the rows between distinct cell edges."""
    edges = cells.select("table_id", F.explode(F.array("y0", "y1")).alias("y0")).distinct()
    return edges.withColumn("y1", F.lead("y0").over(W.partitionBy("table_id").orderBy("y0"))).where("y1 is not null")


def upper_median(values: Column) -> Column:
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def word_rows(words: DataFrame, group: str) -> DataFrame:
    """(group, ord, row_no): words clustered by the running mean of the row's centres; tolerance max(2, 0.4 * median height)."""
    box = F.struct("y0", "ord", ((F.col("y0") + F.col("y1")) / 2).alias("c"))
    sized = words.groupBy(group).agg(F.array_sort(F.collect_list(box)).alias("w"), upper_median(F.collect_list(F.col("y1") - F.col("y0"))).alias("h"))
    tolerance = F.greatest(F.lit(2.0), F.col("h") * 0.4)
    start = F.struct(F.lit(-1).alias("row"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.array().cast("array<struct<ord:bigint,row_no:int>>").alias("out"))

    def step(s, x):
        same = (s["n"] > 0) & (F.abs(x["c"] - s["sum"] / F.greatest(s["n"], F.lit(1))) <= tolerance)
        row = F.when(same, s["row"]).otherwise(s["row"] + 1)
        return F.struct(row.alias("row"), F.when(same, s["sum"] + x["c"]).otherwise(x["c"]).alias("sum"), F.when(same, s["n"] + 1).otherwise(1).alias("n"),
                        F.concat(s["out"], F.array(F.struct(x["ord"].cast("bigint").alias("ord"), row.alias("row_no")))).alias("out"))

    return sized.select(group, F.explode(F.aggregate("w", start, step, lambda s: s["out"])).alias("o")).select(group, "o.*")


def cell_tokens(words: DataFrame, group: str) -> DataFrame:
    """(group, row_no, token, x0, x1, text): neighbouring words of a row joined where the gap is 8 points or less."""
    w = W.partitionBy(group, "row_no").orderBy("x0", "ord")
    new = F.when(F.coalesce(F.col("x0") - F.lag("x1").over(w) <= WORD_GAP, F.lit(False)), 0).otherwise(1)
    numbered = words.withColumn("_n", new).withColumn("token", F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return numbered.groupBy(group, "row_no", "token").agg(F.min("x0").alias("x0"), F.max_by("x1", F.struct("x0", "ord")).alias("x1"),
                                                          F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "ord", "text"))), lambda t: t["text"]), " ").alias("text"))


def column_starts(tokens: DataFrame, group: str) -> DataFrame:
    """(group, starts): distinct rounded positions, a new column from 5 points after the last start."""
    xs = tokens.groupBy(group).agg(F.array_sort(F.collect_set(F.bround("x0").cast("double"))).alias("xs"))
    empty = F.array().cast("array<double>")
    return xs.select(group, F.aggregate("xs", empty, lambda s, x: F.when((F.size(s) == 0) | (x - F.coalesce(F.get(s, F.size(s) - 1), F.lit(-1e9)) >= COLUMN_GAP), F.concat(s, F.array(x))).otherwise(s)).alias("starts"))


def nearest_column(x0: Column, starts: Column) -> Column:
    """0-based place of the nearest start; ties go to the left."""
    return F.array_min(F.transform(starts, lambda s, i: F.struct(F.abs(x0 - s).alias("d"), i.alias("i"))))["i"]


def rebuild(words: DataFrame, group: str, together: bool = False) -> DataFrame:
    """(group, row_no, cells): table cells from words alone.

    Rows by running mean, tokens by gap, columns by start; a column filled in fewer than max(2, a quarter) of the rows is
    dropped; nothing comes out with fewer than two rows or columns. ``words``: group, ord, x0, y0, x1, y1, text. The words of a page are
    brought together once (``together``: they are so already) and folded in one pass of Arrow batches, where the single steps (``word_rows``, ``cell_tokens``,
    ``column_starts``) would shuffle five times. They come as rows, not as a list for each page, so a worker holds no more pages than begin in a batch.
    """
    plain = words.select(group, "y0", "ord", "x0", "x1", "y1", F.coalesce("text", F.lit("")).alias("text"))

    def run(rows: pa.Table, sizes: np.ndarray) -> pa.Table:
        all_words = list(zip(*(c.to_pylist() if c.null_count else c.to_numpy().tolist() for c in rows.columns[1:]), strict=True))  # the second takes a tenth of the time
        at, numbers, cells, start = [], [], [], 0
        for size in sizes.tolist():
            for n, row in _rebuilt(sorted(all_words[start:start + size])):
                at.append(start)
                numbers.append(n)
                cells.append(row)
            start += size
        return pa.table([rows.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()), pa.array(cells, pa.list_(pa.string()))], names=[group, "row_no", "cells"])

    return map_groups(plain, group, run, f"{group} {words.schema[group].dataType.simpleString()}, row_no int, cells array<string>", together)


def _rebuilt(page: list[tuple]) -> list[tuple[int, list[str]]]:
    """Rows of cells of one page, whose words (y0, ord, x0, x1, y1, text) are in order of height."""
    heights = sorted(y1 - y0 for y0, _, _, _, y1, _ in page)
    tolerance = max(2.0, 0.4 * heights[len(heights) // 2])
    rows: list[list[tuple]] = []
    total = 0.0
    for w in page:
        centre = (w[0] + w[4]) / 2
        if rows and abs(centre - total / len(rows[-1])) <= tolerance:
            rows[-1].append(w)
            total += centre
        else:
            rows.append([w])
            total = centre
    if len(rows) < 2:
        return []
    lines, starts = [], set()
    for row in rows:
        tokens: list[list] = []
        for _, _, x0, x1, _, text in sorted(row, key=itemgetter(2, 1)):
            if tokens and x0 - tokens[-1][1] <= WORD_GAP:
                tokens[-1][1] = x1
                tokens[-1][2].append(text)
            else:
                tokens.append([x0, x1, [text]])
        lines.append(tokens)
        starts.update(float(round(t[0])) for t in tokens)
    columns: list[float] = []
    for x in sorted(starts):
        if not columns or x - columns[-1] >= COLUMN_GAP:
            columns.append(x)
    table = []
    for tokens in lines:
        cells: list[list[str]] = [[] for _ in columns]
        for x, _, texts in tokens:
            k = bisect_left(columns, x)  # the nearest start; the left one of two equally near
            if k == len(columns) or (k > 0 and x - columns[k - 1] <= columns[k] - x):
                k -= 1
            cells[k] += texts
        table.append([" ".join(c) for c in cells])
    least = max(2, round(len(table) * 0.25))
    kept = [k for k in range(len(columns)) if sum(row[k] != "" for row in table) >= least]
    return [(n, [row[k] for k in kept]) for n, row in enumerate(table)] if len(kept) >= 2 else []


def fill_share(tables: DataFrame) -> DataFrame:
    """Tables with ``filled_share``, the share of rows at least half filled (null and empty rows are not), and ``accepted`` (half of the rows or more)."""
    filled = lambda r: F.coalesce(F.size(F.filter(r, lambda c: F.coalesce(c, F.lit("")) != "")) >= F.greatest(F.lit(1), F.floor(F.size(r) / 2)), F.lit(False))
    rows = F.transform("rows", lambda r: filled(r).cast("int"))
    share = F.aggregate(rows, F.lit(0), lambda a, x: a + x) / F.greatest(F.size("rows"), F.lit(1))
    return tables.withColumn("filled_share", share).withColumn("accepted", share >= 0.5)


def repair(tables: DataFrame) -> DataFrame:
    """Tables with outer columns recovered and rows rebuilt where that is better: rows, cleaned_rows, flags, confidence.

    ``tables`` has rows, left_words and right_words (texts by row, null where the rules do not reach beyond the table), x1, page_width,
    border_x1 (right edge of a drawn border, null without one) and rebuilt (rows from words, null without any). A right column of side
    tabs only is not taken. A table at the page's right edge is clipped by its border or flagged. Rebuilt rows replace the others if the
    border clipped them, or if they have more columns, at most half as many more, and half of their rows at least half filled. Tables
    without rows and boxes of image ids are left out.
    """
    none = F.array().cast("array<string>")
    flag = lambda condition, name: F.when(condition, F.array(F.lit(name))).otherwise(none)
    first = F.get("rows", F.lit(0))
    plain = F.transform("rows", lambda r: F.transform(r, T.normal_cell))
    right = F.filter(F.transform(F.coalesce("right_words", none), T.trim_ws), lambda v: v != "")
    take_right = F.col("right_words").isNotNull() & (F.size(right) > 0) & ~only_side_tabs(right)
    wider = F.transform(plain, lambda r, i: F.concat(F.when(F.col("left_words").isNotNull(), F.array(F.coalesce(F.get("left_words", i), F.lit("")))).otherwise(none), r,
                                                     F.when(take_right, F.array(F.coalesce(F.get("right_words", i), F.lit("")))).otherwise(none)))
    at_edge = F.coalesce(F.col("x1") >= F.col("page_width") - 5, F.lit(False))
    clipped = at_edge & F.coalesce(F.col("border_x1") < F.col("x1") - 5, F.lit(False))
    made = tables.where(F.size("rows") > 0).withColumn("_wide", wider).withColumn("_clipped", clipped)
    n_new, n_old = F.size(F.get("rebuilt", F.lit(0))), F.size(F.get("_wide", F.lit(0)))
    good = F.size(F.filter("rebuilt", lambda r: F.size(F.filter(r, lambda c: F.coalesce(c, F.lit("")) != "")) >= F.greatest(F.lit(1), F.floor(F.size(r) / 2))))
    better = (n_new > n_old) & (n_new <= 1.5 * n_old) & (good >= 0.5 * F.size("rebuilt"))
    use = F.coalesce((F.size("rebuilt") > 0) & (F.col("_clipped") | better), F.lit(False))
    blob = is_blob_start(F.col("rows"))
    flags = F.concat(flag(F.size("rows") < 2, "single_row_table"), flag((F.size(first) > 0) & (F.size(first) < 2), "single_column_table"), flag(blob, "blob_row_detected"),
                     flag(F.col("left_words").isNotNull() | take_right, "outer_column_recovered"), flag(F.col("_clipped"), "bbox_clipped_by_drawings"), flag(at_edge & ~F.col("_clipped"), "wide_bbox_uncorrected"),
                     flag(use, "bbox_reconstruction_used"))
    rows = F.when(use, F.transform("rebuilt", lambda r: F.transform(r, T.normal_cell))).otherwise(F.col("_wide"))
    kept = made.withColumn("flags", flags).withColumn("_rows", rows).where(~is_image_box(F.col("_rows")))
    cleaned = F.transform("_rows", lambda r, i: F.when(F.array_contains("flags", "blob_row_detected") & (i == 0), r).otherwise(F.transform(r, T.clean_cell)))
    return kept.select(*(c for c in tables.columns if c not in ("rows", "cleaned_rows", "flags", "confidence")), F.col("_rows").alias("rows"), cleaned.alias("cleaned_rows"), "flags",
                       confidence(F.col("flags"), F.lit(False)).alias("confidence"))
