"""Whole pipelines and table reconstruction on small inputs."""

import random

from pyspark.sql import functions as F

from faultlake.operators import pipelines as L
from faultlake.operators import tables as X


def plain_fill(rows, h):
    out = [["" if c is None else c for c in (r or [])] for r in rows]
    for i in range(h + 1, len(out)):
        for j in range(min(len(out[i - 1]), len(out[i]))):
            if out[i][j] == "" and out[i - 1][j] != "":
                out[i][j] = out[i - 1][j]
    return out


def plain_clear(rows):
    above, out = {}, []
    for r in rows:
        out.append([])
        for j, c in enumerate(r):
            out[-1].append("" if c != "" and above.get(j) == c else c)
            if c != "":
                above[j] = c
    return out


def plain_labels(rows, h):
    if not rows:
        return None
    a, b = rows[0] or [], (rows[1] or [] if h == 2 else [])
    get = lambda r, j: (r[j] or "").strip() if j < len(r) else ""
    return [" ".join(x for x in (get(a, j), get(b, j)) if x) for j in range(max(len(a), len(b)))]


def test_filled_cleared_and_labelled_tables(spark):
    rng = random.Random(1)
    cell = lambda: rng.choice(["", "", "a", "b", None, " c "])
    data = [(k, rng.randint(1, 2), [None if rng.random() < 0.05 else [cell() for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(0, 7))]) for k in range(300)]
    df = spark.createDataFrame(data, "k int, h int, rows array<array<string>>")
    filled = X.filled_down(F.col("rows"), F.col("h"))
    got = df.select("k", filled.alias("f"), X.without_repeats(filled).alias("c"), F.when(F.size("rows") >= F.col("h"), X.header_labels(F.col("rows"), F.col("h"))).alias("l")).collect()
    for r in got:
        _, h, rows = data[r.k]
        want = plain_fill(rows, h)
        assert r.f == want and r.c == plain_clear(want)
        if len(rows) >= h:
            assert r.l == plain_labels(rows, h)


def test_reconstructed_tables(spark):
    blob = "all of the headers of this table stand in one cell, over\nseveral lines"
    data = [(1, [["Module", "Pin"], ["", "No."], ["A", "1"], ["", "2"], ["B", "3"]], False), (2, [[blob, "", ""], ["Code", "Part", "Note"], ["P0A0D", "pump", "x"], ["", "fan", ""]], True), (3, [["A", "B"], ["P0A0D", "y"]], False), (4, [], False), (5, None, False)]
    got = {r.k: r.r for r in spark.createDataFrame(data, "k int, rows array<array<string>>, blob boolean").select("k", X.reconstructed(F.col("rows"), F.col("blob")).alias("r")).collect()}
    assert got[1].headers == 2 and got[1].rows == [["Module", "Pin"], ["", "No."], ["A", "1"], ["", "2"], ["B", "3"]] and got[1].steps == ["carry_forward_fill", "merged_cell_dedup"]
    assert got[2].steps == ["blob_row_stripped", "carry_forward_fill", "merged_cell_dedup"] and got[2].rows[0] == ["Code", "Part", "Note"]
    assert got[3].rows is None and got[3].steps == [] and not got[4].rows and not got[5].rows


def manual(doc, shift):
    """A manual with an index table on page 2 that goes on on page 3, and records from page 10 on."""
    pages = [(doc, p, "DTC Index" if p == 2 else "text", f"EVB-{p}", f"header {h}", t) for p, h, t in
             [(1, "", None), (2, "", None), (3, "", None), (10 + shift, "P0A0D P0A1F", "TYPE 1"), (11 + shift, "P0A0D", None), (12 + shift, "P0A0D", "TYPE 2"), (13 + shift, "none", None), (20 + shift, "U1000", None)]]
    rows = [["DTC", "Display Item", "Reference"], ["P0A0D", "PUMP [P0A0D]", f"EVB-{10 + shift}"], ["P0A1F", "FAN", ""], ["U1000", "BUS", f"EVB-{20 + shift}"]]
    words = [(doc, 3, k, x, 100.0, x + 30, 110.0, t) for k, (x, t) in enumerate([(10.0, "B1000"), (60.0, "LAMP"), (300.0, f"EVB-{20 + shift}")])] + [(doc, 2, 0, 400.0, 50.0, 450.0, 60.0, f"EVB-{10 + shift}")]
    return {"pages": pages, "tables": [(doc, 2, 1, 0.0, 500.0, 40.0, rows)], "words": words, "blocks": [(doc, 2, 1, "DTC Index\nx", 10.0, 30.0), (doc, 1, 1, "cover", 10.0, 30.0)],
            "links": [(doc, 2, 1, 400.0, 48.0, 450.0, 62.0, 10 + shift, "d1")]}


def test_build_index_and_records(spark):
    one, two = manual("a", 0), manual("b", 30)
    both = {k: one[k] + two[k] for k in one}
    pages = spark.createDataFrame(both["pages"], "doc string, page int, text string, footer string, header string, type_heading string")
    index = L.build_index(pages, spark.createDataFrame(both["blocks"], "doc string, page int, ord long, text string, y0 double, y1 double"),
                          spark.createDataFrame(both["tables"], "doc string, page int, ord long, x0 double, x1 double, y0 double, rows array<array<string>>"),
                          spark.createDataFrame(both["words"], "doc string, page int, ord long, x0 double, y0 double, x1 double, y1 double, text string"),
                          spark.createDataFrame(both["links"], "doc string, page int, ord long, lx0 double, ly0 double, lx1 double, ly1 double, target int, dest string"),
                          spark.createDataFrame([], "doc string, page int, title string"))
    got = sorted((r.doc, r.code, r.page, r.page_ref, r.title) for r in index.collect())
    assert got == sorted((d, c, p + s, f"EVB-{p + s}", t) for d, s in (("a", 0), ("b", 30)) for c, p, t in (("P0A0D", 10, "PUMP"), ("P0A1F", 10, "FAN"), ("U1000", 20, "BUS"), ("B1000", 20, "LAMP")))
    docs = spark.createDataFrame([("a", "f" * 64), ("b", "0" * 64)], "doc string, document_id string")
    records = sorted((r.doc, r.record_no, r.codes, r.start_page, r.end_page, r.manual_type, r.page_refs, r.page_ref_confidence) for r in L.extract_records(index, pages, docs).collect())
    assert records[:3] == [("a", 1, ["P0A0D", "P0A1F"], 10, 11, "TYPE 1", ["EVB-10", "EVB-11"], "high"), ("a", 2, ["P0A0D", "P0A1F"], 12, 12, "TYPE 2", ["EVB-12"], "medium"), ("a", 3, ["U1000", "B1000"], 20, 20, "TYPE 2", ["EVB-20"], "high")]
    assert [(r[1], r[3], r[4]) for r in records[3:]] == [(1, 40, 41), (2, 42, 42), (3, 50, 50)]


def test_run_site(spark, tmp_path):
    site = {"https://s.example/": '<a class="tpg-post-link" href="/1">a</a><a class="tpg-post-link" href="/2">b</a><a class="tpg-post-link" href="/1">a</a><a class="tpg-post-link" href="/3">c</a>',
            "https://s.example/1": "<h1> Test  Title </h1><div class='futurio-content single-content'><p>The pump is dry.</p><p>Faults:</p><ul><li>P1570</li></ul></div>",
            "https://s.example/2": "<h1>TEST title</h1><p>again</p>"}
    pages = spark.createDataFrame([(1, "https://s.example/"), (2, "https://s.example/gone")], "page_id long, url string")
    got = L.run_site(pages, site.get, delay=0, output=f"file://{tmp_path}/articles").collect()
    assert [(r.title, r.source, r.fault_codes) for r in got] == [("Test Title", "https://s.example/1", ["P1570"])]
    assert "The pump is dry." in got[0].content and got[0].summary == got[0].content[:200]
    assert L.run_site(pages, site.get, max_articles=1, delay=0).count() == 1
