"""Schema drift and nested records: brute force, odd payloads, nulls, repeats and empty tables."""

import datetime as dt
import json
import random

from faultlake.operators import nested as N
from faultlake.operators import schema_drift as S
from faultlake.session import global_ordinal

FILES = "feed_id long, file_id long, file_name string, written_at timestamp_ntz, received_at timestamp_ntz, payload string"


def files(spark, rows):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(f, i, f"{i}.json", at + dt.timedelta(hours=h), at, p) for f, i, h, p in rows], FILES)


def found(spark, rows):
    return sorted(tuple(r) for r in S.schema_changes(files(spark, rows)).collect())


def test_changes_by_hand(spark):
    p = lambda **k: json.dumps(k)
    rows = [(1, 10, 0, p(a="1.0", m={"make": "Lyra", "x": None}, o=1)), (1, 11, 1, p(a="1.1", m={"make": "Tern", "x": 4})), (1, 11, 1, p(a="1.1", m={"make": "Tern", "x": 4})),
            (1, 12, 2, "no json"), (1, 13, 3, None), (1, 14, 4, p(a=1.1, m={"maker": "Lyra", "x": 5}, o=2, n=True)), (1, 15, 5, p(a=1.2, m={"maker": "Lyra", "x": 6}, n=False)), (1, 16, 6, "[1]"), (1, 17, 7, "{\"a\": NaN}")]
    assert found(spark, rows) == sorted([(1, 14, "retyped", "a", ""), (1, 14, "renamed", "m.make", "m.maker"), (1, 14, "added", "n", "")])


def test_removed_and_added_are_not_renamed(spark):
    p = lambda **k: json.dumps(k)
    rows = [(2, 1, 0, p(k=1, s="Celtro")), (2, 2, 1, p(k=2, s="Solvik")), (2, 3, 2, p(k=3, n=4)), (2, 4, 3, p(k=3, n=9)), (3, 5, 0, p(z=1))]
    assert found(spark, rows) == [(2, 3, "added", "n", ""), (2, 3, "removed", "s", "")]


def test_changes_against_brute_force(spark):
    rng = random.Random(9)
    rows, want = [], []
    for feed in range(30):
        n, seen = rng.randint(2, 9), []
        spans = {f"f{k}": sorted((rng.randint(0, n), rng.randint(0, n))) for k in range(4)}
        gaps = {k: rng.random() < 0.3 for k in spans}
        for i in range(n):
            o = {"id": 1, **{k: f"{k} text" * (1 + int(k[1])) + k for k, (a, b) in spans.items() if a <= i < b and not (gaps[k] and i == (a + b) // 2)}}
            seen.append(o)
            rows.append((feed, feed * 100 + i, i, json.dumps(o)))
        for k in spans:
            at = [i for i, o in enumerate(seen) if k in o]
            if at and at[-1] - at[0] + 1 == len(at):
                if at[0] > 0:
                    want.append((feed, feed * 100 + at[0], "added", k))
                if at[-1] < n - 1:
                    want.append((feed, feed * 100 + at[-1] + 1, "removed", k))
    got = []
    for feed, file, kind, old, new in found(spark, rows):  # a rename is an end and a beginning
        got += [(feed, file, "removed", old), (feed, file, "added", new)] if kind == "renamed" else [(feed, file, kind, old)]
    assert sorted(got) == sorted(want)


def test_retyped_back_and_forth(spark):
    rows = [(1, i, i, json.dumps({"v": v})) for i, v in enumerate([1, None, "a", "b", 2, [1], None, [2]])]
    assert found(spark, rows) == [(1, 2, "retyped", "v", ""), (1, 4, "retyped", "v", ""), (1, 5, "retyped", "v", "")]


def test_steady_table(spark):
    rows = [(1, 1, 0, json.dumps({"n": 1, "v": "x"})), (1, 2, 1, json.dumps({"n": 2.5, "v": "y"})), (1, 3, 2, json.dumps({"n": "many", "w": {"d": [1]}})), (1, 4, 3, json.dumps({"n": 3}))]
    t = {r.file_id: r for r in S.steady_table(files(spark, rows)).collect()}
    assert t[1].n == 1.0 and t[3].n is None and t[2].v == "y" and t[3].w__d == "[1]"
    assert [(r.file_id, r.column, r.value) for r in S.failed_casts(files(spark, rows)).collect()] == [(3, "n", "many")]


def test_drift_of_nothing(spark):
    empty = files(spark, [(1, 1, 0, None)])
    assert S.schema_changes(empty).count() == 0 and S.failed_casts(empty).count() == 0 and S.steady_table(empty).count() == 0
    missing = spark.createDataFrame([(None, 1, "x", None, None, '{"a":1}')], FILES)
    assert S.schema_changes(missing).count() == 0


def test_global_ordinal(spark):
    df = spark.createDataFrame([(g, v) for g in (1, 1, 1, 1, 1, 2) for v in range(50)], "g int, v int").distinct()
    got = global_ordinal(df, "g", ["v"], "k").collect()
    assert all(r.k == r.v for r in got) and len(got) == 100


SECTION = "struct<section_id:string,heading:string,role:string,oem_content_id:string,cleaned_text:string,page_start:int,page_end:int,has_type_variants:boolean,type_markers_detected:array<string>>"
TABLE = "struct<table_id:string,section_id:string,heading_nearby:string,role:string,start_pdf_page:int,end_pdf_page:int,page_refs:array<string>,raw_rows:array<array<string>>,extraction:struct<confidence:string,quality_flags:array<string>,header_rows_hint:int,partial:boolean>>"
DTC = (f"record_id string, document_id string, codes array<string>, notes array<string>, pos int, location struct<start_pdf_page:int,end_pdf_page:int,page_refs:array<string>,section_code:string>, sections array<{SECTION}>, tables array<{TABLE}>, "
       "table_groups array<struct<group_id:string,source_table_ids:array<string>,section_id:string>>, images array<struct<image_id:string,section_id:string,pdf_page:int,page_ref:string,image_path:string,caption:string,role:string>>, "
       "extraction struct<status:string,ocr_used:boolean,page_ref_confidence:string,warnings:array<string>>")
CODE = ("record_id string, document_id string, record_type string, title string, identifiers array<struct<type:string,value:string,confidence:double>>, location struct<start_pdf_page:int,end_pdf_page:int,page_refs:array<string>,section_ref:string>, "
        "content_blocks array<struct<block_id:string,block_type:string,heading:string,role:string,text:string,raw_rows:array<array<string>>,location:struct<start_pdf_page:int,end_pdf_page:int,page_refs:array<string>>,image_ref:struct<image_id:string,path:string,caption:string,pdf_page:int>,"
        "table_quality:struct<status:string,confidence:string,warnings:array<string>,flags:array<string>>,extraction:struct<status:string,warnings:array<string>>>>, extraction struct<status:string,confidence:string,warnings:array<string>,ocr_used:boolean>")


def section(i):
    return (i, None, None, None, None, None, None, None, None)


def table(i, s):
    return (i, s, None, None, 1, 1, None, [["a"], None], None)


def test_broken_links(spark):
    full = ("r1", "d", None, None, 7, (1, 2, ["A-1"], None), [section("s1"), section("s2"), section("s2"), section(None), None], [table("t1", "s1"), table("t2", "s2"), table("t2", None), table(None, "S1"), None],
            [("g1", ["t1"], None), ("g2", ["t1", "t2"], None), ("g3", ["t9", None], None), ("g4", None, None), None], [("i", "s1", 1, None, None, None, None), ("i", "s9", 1, None, None, None, None)], None)
    nothing = ("r2", "d", None, None, None, None, None, None, None, None, None)
    stub = ("r3", "d", None, None, None, None, [], [table("t", "s")], [], [], None)
    dtc = spark.createDataFrame([full, full, nothing, stub, (None, *stub[1:])], DTC)
    block = lambda refs, text=None, rows=None, image=None: ("b", "text", None, None, text, rows, (1, 1, refs) if refs is not None else None, image, None, None)
    code = spark.createDataFrame([("c1", "d", None, None, None, (1, 2, ["A-1", None], None), [block(["A-1"]), block(["A-1", "A-2"], "t"), block([None]), block([]), None, block(None)], None),
                                  ("c2", "d", None, None, None, None, [block(["A-1"])], None), ("c3", "d", None, None, None, None, None, None)], CODE)
    got = sorted(tuple(r) for r in N.broken_links(dtc, code).collect())
    assert got == [("c1", "block", 2), ("c2", "block", 1), ("r1", "group", 2), ("r1", "group", 3), ("r1", "image", 2), ("r1", "table", 2), ("r1", "table", 4), ("r3", "table", 1)]
    flat = {n: t.count() for n, t in N.dtc_tables(dtc).items()}
    wanted = {"record": 3, "section": 5, "table": 6, "table_row": 10, "table_group": 5, "group_table": 5, "image": 2, "page_ref": 1}
    assert {n: flat[n] for n in wanted} == wanted
    for kind, whole in (("section", "section"), ("table", "table"), ("image", "image"), ("group", "table_group")):  # each object is in one variant table
        assert sum(flat[f"{kind}_{v}"] for v, _ in N.dtc_kinds()[kind].variants) == flat[whole]
    assert {n: t.count() for n, t in N.code_tables(code).items()}["block"] == 7
    variants = {r.variant for r in N.code_tables(spark.createDataFrame([("c", "d", None, None, None, None, [block([], "t"), block([], None, [["x"]]), block([], None, [[""], None], ("i", None, None, 1)), block([], "t", [["x"]]), block([], "")], None)], CODE))["block"].collect()}
    assert variants == {"text", "table", "image", "mixed", "empty"}
    assert N.broken_links(dtc.limit(0), code.limit(0)).count() == 0
    assert N.shape_counts(dtc, code).count() > 0


def test_unrelated_values_of_a_long_feed_are_no_rename(spark):
    """Two fields of many different values each: hundreds of files must not make them look alike."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    rows = [(1, i, i, json.dumps({"k": 1, "title": f"{word(5)} {word(7)}, {word(3)}"} if i < 200 else {"k": 1, "stamp": f"{word(2).upper()}/{rng.randint(1, 9)}"})) for i in range(400)]
    assert found(spark, rows) == [(1, 200, "added", "stamp", ""), (1, 200, "removed", "title", "")]
    same = [(1, i, i, json.dumps({"k": 1, ("model" if i < 200 else "car"): rng.choice(["Lyra 2", "Tern", "C-One"])})) for i in range(400)]
    assert found(spark, same) == [(1, 200, "renamed", "model", "car")]


def test_chains_of_renames_have_one_column(spark):
    names = ["make", "maker", "vehicle_make", "make_name", "car_make"]
    rows = [(1, i, i, json.dumps({"k": i, names[i // 4]: ["Lyra", "Tern"][i % 2]})) for i in range(20)]
    t = S.steady_table(files(spark, rows)).collect()
    assert len(t) == 20 and sorted(set(t[0].asDict())) == ["feed_id", "file_id", "idx", "k", "make", "n_fields"] and {r.make for r in t} == {"Lyra", "Tern"}
