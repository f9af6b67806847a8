"""Order-dependent operators against plain restatements of their rules, on random input."""

import random

from pyspark.sql import functions as F

from faultlake.operators import dtc_index as I
from faultlake.operators import pages as P
from faultlake.operators import tables as X
from faultlake.operators import vehicle as V


def test_merge_groups_with_links(spark):
    rng = random.Random(5)
    rows, links, want = [], [], []
    foot = {"AB-1": 10, "AB-2": 20, "AB-3": 30}
    for t in range(60):
        own_links = [(t, float(y), y, rng.choice([None, "ab-1", "AB-2", "AB-9"]), rng.randint(1, 5), rng.choice("xyz")) for y in range(rng.randint(0, 6))]
        own_rows = [(t, n, f"P{n:04d}", *(lambda r: (r is not None, None if r == "zz" else r))(rng.choice([None, "AB-1", "AB-2", "AB-9", "zz"]))) for n in range(rng.randint(1, 8))]
        rows += own_rows
        links += own_links
        k, page, ref = 0, None, None
        for _, n, code, has, r in own_rows:
            if has:
                ref = r
                if k < len(own_links) and not (r and own_links[k][3] and r.upper() != own_links[k][3].upper()):
                    page, dest = own_links[k][4], own_links[k][5]
                    k += 1
                    while k < len(own_links) and own_links[k][5] == dest:
                        k += 1
                else:
                    page = foot.get(r)
            if page is not None:
                want.append((t, n, code, page, ref))
    got = I.merge_groups_with_links(spark.createDataFrame(rows, "table_id int, row_no long, code string, has_ref boolean, ref string"),
                                    spark.createDataFrame(links, "table_id int, y0 double, ord long, link_ref string, link_page int, dest string"),
                                    spark.createDataFrame(list(foot.items()), "page_ref string, page int"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def words(rng, pages=12, n=40):
    return [(p, k, (x := float(rng.randint(0, 200))), (y := rng.uniform(0, 80)), x + rng.randint(3, 30), y + rng.choice([6.0, 8.0, 10.0]), f"w{k}") for p in range(pages) for k in range(rng.randint(1, n))]


WORDS = "g int, ord long, x0 double, y0 double, x1 double, y1 double, text string"


def test_visual_rows_anchor(spark):
    data = words(random.Random(1))
    want = []
    for g in {w[0] for w in data}:
        anchor, row = None, -1
        for w in sorted((w for w in data if w[0] == g), key=lambda w: (w[3], w[1])):
            if anchor is None or abs(w[3] - anchor) > 4:
                anchor, row = w[3], row + 1
            want.append((g, w[1], row))
    assert sorted(map(tuple, I.visual_rows(spark.createDataFrame(data, WORDS), "g").collect())) == sorted(want)


def plain_rows(own):
    heights = sorted(w[5] - w[3] for w in own)
    tol = max(2.0, 0.4 * heights[len(heights) // 2])
    rows = []
    for w in sorted(own, key=lambda w: (w[3], w[1])):
        c = (w[3] + w[5]) / 2
        if rows and abs(c - sum((x[3] + x[5]) / 2 for x in rows[-1]) / len(rows[-1])) <= tol:
            rows[-1].append(w)
        else:
            rows.append([w])
    return rows


def plain_rebuild(own):
    rows = plain_rows(own)
    if len(rows) < 2:
        return []
    lines = []
    for row in rows:
        tokens = []
        for w in sorted(row, key=lambda w: (w[2], w[1])):
            if tokens and w[2] - tokens[-1][1] <= 8:
                tokens[-1] = (tokens[-1][0], w[4], tokens[-1][2] + " " + w[6])
            else:
                tokens.append((w[2], w[4], w[6]))
        lines.append(tokens)
    starts = []
    for x in sorted({round(t[0]) for line in lines for t in line}):
        if not starts or x - starts[-1] >= 5:
            starts.append(float(x))
    table = []
    for line in lines:
        cells = [""] * len(starts)
        for x, _, text in line:
            k = min(range(len(starts)), key=lambda i: abs(x - starts[i]))
            cells[k] = (cells[k] + " " + text).strip()
        table.append(cells)
    keep = [k for k in range(len(starts)) if sum(bool(r[k]) for r in table) >= max(2, round(len(table) * 0.25))]
    return [[r[k] for k in keep] for r in table] if len(keep) >= 2 else []


def test_rebuild_from_words(spark):
    data = words(random.Random(2), pages=25, n=60)
    df = spark.createDataFrame(data, WORDS)
    by = {g: [w for w in data if w[0] == g] for g in {w[0] for w in data}}
    want_rows = sorted((g, w[1], n) for g, own in by.items() for n, row in enumerate(plain_rows(own)) for w in row)
    assert sorted(map(tuple, X.word_rows(df, "g").collect())) == want_rows
    got = {}
    for r in X.rebuild(df, "g").orderBy("g", "row_no").collect():
        got.setdefault(r.g, []).append(r.cells)
    assert got == {g: t for g, own in by.items() if (t := plain_rebuild(own))}


def test_continued_tables(spark):
    rng = random.Random(3)
    headers = [["A", "B", ""], ["A", "B", "C"], ["X"], []]
    data, want = [], []
    for r in range(80):
        own = [(r, k, f"t{k}", rng.choice(["s1", "s1", "s2"]), rng.randint(1, 3), [] if rng.random() < 0.1 else [rng.choice(headers), [f"v{k}"]]) for k in range(rng.randint(1, 6))]
        data += own
        skip = set()
        strip = lambda h: h[: max((i + 1 for i, c in enumerate(h) if c != ""), default=0)]
        for i, t in enumerate(own):
            if i in skip:
                continue
            ids, pages, rows = [t[2]], [t[4]], list(t[5])
            for j in range(i + 1, len(own)):
                n = own[j]
                ok = n[3] == t[3] and n[5] and t[5] and n[4] != pages[-1]
                if ok:
                    a, b = strip(n[5][0]), strip(t[5][0])
                    short = min(a, b, key=len)
                    ok = a == b or (len(short) > 0 and a[: len(short)] == b[: len(short)])
                if not ok:
                    break
                ids.append(n[2])
                pages.append(n[4])
                rows += n[5][1:]
                skip.add(j)
            if len(ids) > 1:
                want.append((r, t[2], ids, pages, rows))
    df = spark.createDataFrame(data, "record int, ord int, table_id string, section_id string, page int, rows array<array<string>>")
    got = [(x.record, x["head"], x.table_ids, x.pages, x.rows) for x in X.continued_tables(df).collect()]
    assert sorted(got) == sorted(want) and want


def test_codes_with_titles(spark):
    line = [(1, k, float(30 * k), 10.0 + k % 2, 30.0 * k + 20, 18.0, t) for k, t in enumerate(["P0A0D", "•", "HV", "SYSTEM", "[P0A0D]", "×", "SKIP", "EVB-73", "LATER"])]
    other = [(1, 20, 0.0, 50.0, 20.0, 58.0, "U1000"), (1, 21, 30.0, 52.0, 60.0, 60.0, "LOST"), (1, 22, 70.0, 50.0, 90.0, 58.0, "12"), (1, 23, 0.0, 90.0, 20.0, 98.0, "B2900")]
    got = {r.code: (r.title, r.ref) for r in I.codes_with_y(spark.createDataFrame(line + other, WORDS.replace("g int", "page_id int"))).collect()}
    assert got == {"P0A0D": ("HV SYSTEM", "EVB-73"), "U1000": ("LOST", None), "B2900": ("", None)}


def test_titles(spark):
    rows = [(["CELL OVER DISCHARGE 25", "CELL OVER DISCHARGE 26"], 2, "CELL OVER DISCHARGE"), (["E CELL CONT"], 1, "CELL CONT"), ([], 2, None), (["A x", "B y"], 2, None), ([None, ""], 1, None), (["ONE", "ONE TWO"], 2, "ONE")]
    df = spark.createDataFrame([(t, n) for t, n, _ in rows], "t array<string>, n int")
    assert [r.v for r in df.select(I.record_title(F.col("t"), F.col("n")).alias("v")).collect()] == [w for *_, w in rows]


def test_footer_and_foreword(spark):
    df = spark.createDataFrame([(["x", "EVB-1", "2013 Leaf NAM", "Revision: October 2013"],), (["LEAF"],), ([],), (["Revision: a", "Edition: b", "123 !"],)], "lines array<string>")
    got = [tuple(r.f) for r in df.select(V.footer_info(F.col("lines")).alias("f")).collect()]
    assert got == [("October 2013", "2013", "Leaf", "NAM"), (None, None, "LEAF", None), (None, None, None, None), ("b", None, None, None)]
    text = spark.createDataFrame([("procedure for the 2011 NISSAN LEAF and",), ("none",), (None,)], "t string")
    got = [r.f and tuple(r.f) for r in text.select(V.foreword_info(F.col("t")).alias("f")).collect()]
    assert got == [("2011", "Nissan", "LEAF"), None, None]


def test_vehicle_priority(spark):
    s = "struct<revision_date:string,year:string,model:string,variant:string>"
    t = "struct<year:string,make:string,model:string>"
    docs = spark.createDataFrame([(1, (None, "2013", "Leaf", "NAM"), "rev", None, None), (2, (None, "2013", "Leaf", None), None, ("2011", "Nissan", "LEAF"), ("1999", "X", "Y")), (3, (None, None, None, None), None, None, ("2015", "Kia", "SOUL")), (4, (None, None, None, None), None, None, None)],
                                 f"doc int, footer {s}, revision string, foreword {t}, title {t}")
    lookup = spark.createDataFrame([("LEAF", "Nissan")], "model string, make string")
    got = {r.doc: (r.year, r.make, r.model, r.revision_date, r.method) for r in V.merge_vehicle(docs, lookup).collect()}
    assert got == {1: ("2013", "Nissan", "Leaf", "rev", "footer"), 2: ("2011", "Nissan", "LEAF", None, "foreword"), 3: ("2015", "Kia", "SOUL", None, "metadata"), 4: (None, None, None, None, None)}


def test_empty_tables(spark):
    w = spark.createDataFrame([], WORDS)
    assert X.rebuild(w, "g").count() == 0 and I.visual_rows(w, "g").count() == 0
    assert P.fill_types(spark.createDataFrame([], "doc int, page int, type_heading string")).count() == 0


def test_header_rules(spark):
    rows = [([["Module", ""], ["", "Pin"], ["1", "2"]], 2), ([["A", "B"], ["P0A0D", "x"], ["1", "2"]], 1), ([["A"], ["B"]], 1), ([["Mod", "Con"], ["Name", ""], ["1", ""]], 2), ([["Mod 1", "Con"], ["Name", "x"], ["1", ""]], 1), ([["A", "B"], ["TABLE", "x"], ["1", "2"]], 1)]
    df = spark.createDataFrame([(r,) for r, _ in rows], "rows array<array<string>>")
    assert [r.n for r in df.select(X.header_rows(F.col("rows")).alias("n")).collect()] == [n for _, n in rows]


def test_repair(spark):
    schema = "id int, rows array<array<string>>, left_words array<string>, right_words array<string>, x1 double, page_width double, border_x1 double, rebuilt array<array<string>>"
    plain = [["A", "B"], ["de-\ntects", None]]
    rows = [(1, plain, None, None, 500.0, 612.0, None, None), (2, plain, ["l", ""], ["EVB", ""], 500.0, 612.0, None, None), (3, plain, None, ["x y", ""], 610.0, 612.0, 590.0, [["q", "r"], ["s", ""]]),
            (4, plain, None, None, 610.0, 612.0, None, [["a", "b", "c"], ["d", "e", ""]]), (5, [["x"]], None, None, 1.0, 9.0, None, None), (6, [["JSCIA0812GB", "."]], None, None, 1.0, 9.0, None, None),
            (7, [["two\nlines", ""], ["a", "b"]], None, None, 1.0, 9.0, None, [["1", "2", "3", "4"], ["5", "6", "7", "8"]]), (8, [], None, None, 1.0, 9.0, None, None), (9, None, None, None, None, None, None, None)]
    got = {r.id: r for r in X.repair(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 7}
    assert got[1].cleaned_rows == [["A", "B"], ["detects", ""]] and got[1].confidence == "high" and got[1].flags == []
    assert got[2].rows[0] == ["l", "A", "B"] and got[2].flags == ["outer_column_recovered"] and got[2].confidence == "medium"
    assert got[3].rows == [["q", "r"], ["s", ""]] and got[3].flags == ["outer_column_recovered", "bbox_clipped_by_drawings", "bbox_reconstruction_used"]
    assert got[4].rows[0] == ["a", "b", "c"] and got[4].flags == ["wide_bbox_uncorrected", "bbox_reconstruction_used"]
    assert got[5].flags == ["single_row_table", "single_column_table"] and got[5].confidence == "low"
    assert got[7].cleaned_rows[0][0] == "two\nlines" and got[7].confidence == "low" and len(got[7].rows[0]) == 2
