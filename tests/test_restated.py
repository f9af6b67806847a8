"""Registered queries without SQL, on the whole small tables, against plain restatements of their rules."""

import re
from collections import defaultdict
from urllib.parse import urljoin

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from faultlake.operators import schema_drift as D
from faultlake.operators.pages import HEADINGS, NO_HEADING
from faultlake.plans.derived import derived
from oracle import DATA
from test_folds import plain_rebuild, plain_rows
from test_pipelines import plain_clear, plain_fill
from test_whole import english

QUERIES = entry.queries()
CODE = re.compile(r"[PBCU][0-9A-F]{4}")


def rows(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def once(name, key):
    return list({r[key]: r for r in rows(name) if r[key] is not None}.values())


def result(spark, name):
    return [tuple(r) for r in QUERIES[name](spark, DATA).collect()]


@pytest.fixture(scope="module")
def pages(spark):
    """Words of every page as the folds of test_folds take them."""
    out = defaultdict(list)
    for r in derived(spark, DATA, "words").collect():
        out[r.page_id].append((r.page_id, r.ord, r.x0, r.y0, r.x1, r.y1, r.text))
    return out


def test_visual_rows(spark, pages):
    want = []
    for g, own in pages.items():
        anchor, row = None, -1
        for w in sorted(own, key=lambda w: (w[3], w[1])):
            if anchor is None or abs(w[3] - anchor) > 4:
                anchor, row = w[3], row + 1
            want.append((g, w[1], row))
    assert sorted(result(spark, "win6_visual_rows")) == sorted(want) and len(want) > 5000


def test_word_rows_and_tables(spark, pages):
    assert sorted(result(spark, "win8_word_rows")) == sorted((g, w[1], n) for g, own in pages.items() for n, row in enumerate(plain_rows(own)) for w in row)
    got = defaultdict(list)
    for g, n, cells in sorted(result(spark, "fn29_rebuilt_tables")):
        got[g].append(cells)
    assert got == {g: t for g, own in pages.items() if (t := plain_rebuild(own))} and got


def test_column_starts(spark, pages):
    want = {}
    for g, own in pages.items():
        starts = []
        for x in sorted({float(round(w[2])) for w in own}):
            if not starts or x - starts[-1] >= 5:
                starts.append(x)
        want[g] = starts
    assert dict(result(spark, "win10_column_starts")) == want


def test_codes_with_titles(spark, pages):
    want = []
    for g, own in pages.items():
        line = []
        for w in sorted(own, key=lambda w: w[1]):
            k = w[1]
            text = f"P0A{k % 9}D" if k % 20 == 10 else f"EVB-{k % 99}" if k % 3 == 0 else "12" if k % 7 == 0 else "•" if k % 11 == 0 else w[6]
            line.append((*w[:6], text))
        for w in line:
            clean = re.sub("[^A-Z0-9]", "", w[6].strip().upper())
            if CODE.fullmatch(clean) and not re.match(r"(?i)^\[[PBCU][0-9A-F]{4}\]$", w[6]):
                title, ref, done = [], None, False
                for v in line:
                    if abs(v[3] - w[3]) >= 3 or v[2] <= w[4]:
                        continue
                    cell = v[6].strip()
                    if m := re.match(r"(?i)[A-Z]{2,10}-\d+", cell):
                        ref = m[0]
                        break
                    if not done and not re.match("^[•·‣◦]$", cell):
                        done = bool(re.match("(?i)^[×—x]$", cell) or re.match(r"^\d+$", cell) or CODE.fullmatch(re.sub("[^A-Z0-9]", "", cell.upper())))
                        if not done:
                            title.append(cell)
                want.append((g, w[1], clean, w[3], re.sub(r"(?i)\[[PBCU][0-9A-F]{4}\]", "", " ".join(title)).strip(), ref))
    assert sorted(result(spark, "fn22_codes_with_y"), key=repr) == sorted(want, key=repr) and len(want) > 100


def test_group_link_merge(spark):
    index, links, foot = defaultdict(list), defaultdict(list), {}
    for r in derived(spark, DATA, "dtc_index").collect():
        if r.page % 3 and r.page_ref is not None:
            foot[r.doc, r.page_ref] = max(r.page, foot.get((r.doc, r.page_ref), 0))
        index[r.seq // 5_000_000_000_000, r.seq // 400_000_000_000].append(r)
    for r in derived(spark, DATA, "links").collect():
        links[r.ord // 5_000_000_000_000, r.ord // 400_000_000_000].append((r.mid, r.ord, f"evb-{r.ord % 500}", r.target % 90 + 1, str(r.target)))
    want = []
    for (doc, t), own in index.items():
        k, page, ref, mine = 0, None, None, sorted(links[doc, t])
        for r in sorted(own, key=lambda r: r.seq):
            if r.seq % 3 == 0:
                ref = f"EVB-{r.seq % 500}"
                if k < len(mine) and ref.upper() == mine[k][2].upper():
                    page, dest = mine[k][3], mine[k][4]
                    k += 1
                    while k < len(mine) and mine[k][4] == dest:
                        k += 1
                else:  # the link belongs to another group, or there is none left
                    page = foot.get((doc, ref))
            if page is not None:
                want.append((doc, t, r.seq, r.code, page, ref))
    assert sorted(result(spark, "jn3_group_link_merge"), key=repr) == sorted(want, key=repr) and want


def test_continued_and_reconstructed_tables(spark):
    got = {(r.record_id, r.pos): r for r in QUERIES["fn28_reconstructed_tables"](spark, DATA).collect()}
    n = {(r.record_id, r.pos): r.n for r in QUERIES["win18_header_rows"](spark, DATA).collect()}
    tables = {(r["record_id"], k): t for r in once("dtc_records", "record_id") for k, t in enumerate(r["tables"] or []) if t and t["raw_rows"]}
    assert set(got) == set(tables)
    for key, t in tables.items():
        plain = [["" if c is None else c for c in (r or [])] for r in t["raw_rows"]]
        if "blob_row_stripped" in got[key].steps:
            continue
        filled = plain_fill(plain, n[key])
        clear = plain_clear(filled)
        steps = ["carry_forward_fill"] * (filled != plain) + ["merged_cell_dedup"] * (clear != filled)
        assert got[key].steps == steps and got[key].headers == n[key]
        assert got[key].rows == ([" | ".join(r) for r in clear] if steps else None)


def test_zone_texts(spark):
    noise = [r"(?i)Revision:\s+", r"(?i)<\s*DTC/CIRCUIT DIAGNOSIS\s*>$", r"[A-Z]{1,4}-\d+[A-Z]?$", r"[PBCU][0-9A-F]{4}\s+[A-Z][A-Z\s]*$", r"\d{4}\s+[A-Z][A-Z\s]*$"]

    def clean(text):
        text = re.sub(r"INFOID:\d+", "", text)
        text = re.sub(r"(?m)^[^\S\n]*[A-Z][^\S\n]*$", "", text)
        text = re.sub(r"(\w+)-\n([A-Za-z])", r"\1\2", text)
        lines = [x for x in text.split("\n") if not any(re.match(p, x.strip()) for p in noise) and x.strip() != "EVB"]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()

    assert sorted(result(spark, "fn2_zone_text"), key=repr) == sorted(((r["doc_id"], None if r["text"] is None else clean(r["text"])) for r in rows("documents")), key=repr)


def test_english_paragraphs_and_urls(spark):
    want = [(r["doc_id"], "\n\n".join([p for p in (r["text"] or "").split("\n\n") if english(p)] or (r["text"] or "").split("\n\n"))) for r in rows("documents")]
    assert sorted(result(spark, "flt25_english_paragraphs")) == sorted(want)
    want = [(r["article_id"], urljoin(r["source"] or "", re.sub("^https?://[^/]+", "", u)) if u and re.sub("^https?://[^/]+", "", u) else None) for r in once("articles", "article_id") for u in r["images"] or []]
    assert sorted(result(spark, "jn18_absolute_urls"), key=repr) == sorted(want, key=repr)


def test_unknown_headings(spark):
    known = {h.lower() for h, _ in HEADINGS}
    noise = [r"(?i)Revision:\s+", r"(?i)<\s*DTC/CIRCUIT DIAGNOSIS\s*>$", r"[A-Z]{1,4}-\d+[A-Z]?$", r"[PBCU][0-9A-F]{4}\s+[A-Z][A-Z\s]*$", r"\d{4}\s+[A-Z][A-Z\s]*$"]
    want = []
    for r in rows("documents"):
        for k, line in enumerate((r["text"] or "").split("\n") if r["text"] is not None else []):
            s = line.strip()
            if len(line) % 2 == 0 and len(s) <= 55 and len(s.split()) >= 2 and not any(re.match(p, s) for p in noise) and not any(re.search(p, s) for p in NO_HEADING) and " ".join(s.split()).lower() not in known:
                want.append((r["doc_id"], k, line))
    assert sorted(result(spark, "flt15_unknown_headings")) == sorted(want)


def test_changes_of_schemas(spark):
    """A rename is an end and a beginning in one file; everything else is stated outright."""
    feeds = defaultdict(dict)
    for r in rows("adapter_files"):
        found = D.parse_object(r["payload"])
        if found and None not in (r["feed_id"], r["file_id"], r["written_at"]) and (flat := D.flatten(found)):
            feeds[r["feed_id"]][r["written_at"], r["file_id"]] = {p: t for p, (t, _) in flat.items()}
    want = []
    for feed, files in feeds.items():
        order = sorted(files)
        for path in {p for f in files.values() for p in f}:
            at = [i for i, k in enumerate(order) if path in files[k]]
            if at[-1] - at[0] + 1 == len(at):
                if at[0] > 0:
                    want.append((feed, order[at[0]][1], "added", path))
                if at[-1] < len(order) - 1:
                    want.append((feed, order[at[-1] + 1][1], "removed", path))
            kinds = [(i, files[order[i]][path]) for i in at if files[order[i]][path]]
            want += [(feed, order[i][1], "retyped", path) for (_, a), (i, b) in zip(kinds, kinds[1:], strict=False) if a != b]
    got = []
    for feed, file, kind, old, new in result(spark, "p2_found"):
        got += [(feed, file, "removed", old), (feed, file, "added", new)] if kind == "renamed" else [(feed, file, kind, old)]
    assert sorted(got) == sorted(want) and want
    table = QUERIES["p2_table"](spark, DATA).collect()
    assert len(table) == sum(map(len, feeds.values())) and sum(r.n_fields for r in table) == sum(len(f) for files in feeds.values() for f in files.values())
    lost = QUERIES["p2_failed_casts"](spark, DATA).collect()
    assert all(r.jtype != r.target for r in lost) and {r.target for r in lost} <= {"array", "boolean", "number"}


def test_shapes_count_every_object(spark):
    got = defaultdict(int)
    for kind, _, n in result(spark, "p5_shapes"):
        got[kind] += n
    want = {a: sum(len(r[a] or []) for r in once(t, "record_id")) for t, arrays in (("dtc_records", ("sections", "tables", "table_groups", "images")), ("code_records", ("identifiers", "content_blocks"))) for a in arrays}
    assert dict(got) == {k: n for k, n in want.items() if n}


def test_vehicles(spark):
    got = {r.doc: r for r in QUERIES["fn16_vehicle_merge"](spark, DATA).collect()}
    makes = defaultdict(list)
    for r in rows("vehicle_models"):
        makes[r["model"].upper()].append(r["make"])
    for r in once("manuals", "document_id"):
        v = r["vehicle"] or {}
        model = v.get("model") if re.match("^[A-Za-z][A-Za-z0-9-]*$", v.get("model") or "") else "LEAF"
        name = " ".join(x for x in (v.get("year"), v.get("make"), v.get("model")) if x is not None)
        fore = re.search(r"(?i)for the (\d{4})\s+([A-Z][A-Z\-]+)\s+([A-Z][A-Z0-9\-]+)", f"procedure for the {name} and its kin") if v.get("make") is not None and len(v["make"]) % 2 == 0 else None
        title = re.search(r"(\d{4})\s+([A-Za-z]+)\s+([A-Za-z0-9\-]+)", f"Service {name} Manual") if r["document_id"][0] < "8" and not fore else None
        own = got[r["document_id"]]
        if title:
            assert (own.year, own.make, own.model, own.method) == (title[1], title[2], title[3].upper(), "metadata")
        elif fore:
            assert (own.year, own.make, own.model, own.method) == (fore[1], "-".join(w.capitalize() for w in fore[2].split("-")), fore[3].upper(), "foreword")
        elif v.get("year"):
            assert own.year == v["year"] and own.model == model and own.method == "footer" and own.make == min(makes.get(model.upper(), [None]))


def test_parsed_articles(spark):
    got = {r.page_id: r for r in QUERIES["fn27_parsed_articles"](spark, DATA).collect()}
    arts = once("articles", "article_id")
    assert set(got) == {r["article_id"] for r in arts}
    for r in arts:
        assert got[r["article_id"]].title == " ".join((r["title"] or "").split())
        assert got[r["article_id"]].tags == list(dict.fromkeys(t for t in (" ".join(x.split()) for x in (r["tags"] or []) if x is not None) if t))


def test_every_query_without_sql_has_expected_rows():
    """Queries whose rows neither SQL nor a test here or in tests/llm states."""
    stated = {"win6_visual_rows", "win8_word_rows", "fn29_rebuilt_tables", "win10_column_starts", "fn22_codes_with_y", "jn3_group_link_merge", "fn28_reconstructed_tables", "fn2_zone_text", "flt25_english_paragraphs", "jn18_absolute_urls",
              "flt15_unknown_headings", "p2_found", "p2_table", "p2_failed_casts", "p5_shapes", "fn16_vehicle_merge", "fn27_parsed_articles", "win5_continued_tables"}
    core = {n for n in QUERIES if not re.match("p[1346789]_", n)}
    assert core - set(entry.oracle_sql()) == stated


def test_continued_tables(spark):
    strip = lambda h: h[: max((i + 1 for i, c in enumerate(h) if c != ""), default=0)]
    want = []
    for r in once("dtc_records", "record_id"):
        own = [(k, t["table_id"], t["section_id"], (t["start_pdf_page"] + k) if t["start_pdf_page"] is not None else None, [["" if c is None else c for c in x] if x is not None else None for x in t["raw_rows"]] if t["raw_rows"] is not None else None)
               for k, t in enumerate(r["tables"] or []) if t]
        group = None
        for k, i, s, p, x in own:
            fits = group and s == group[1] and x and group[4] and x[0] is not None and group[2] is not None and p is not None and group[3] is not None and p != group[3]
            if fits:
                a, b = strip(x[0]), strip(group[2])
                short = min(a, b, key=len)
                fits = a == b or (len(short) > 0 and a[: len(short)] == b[: len(short)])
            if fits:
                group[0].append(i)
                group[3] = p
                group[4] += x[1:]
            else:
                group = [[i], s, x[0] if x else None, p, list(x or [])]
                want.append((r["record_id"], group))
    want = sorted((r, g[0]) for r, g in want if len(g[0]) > 1)
    assert sorted((r[0], r[2]) for r in result(spark, "win5_continued_tables")) == want
