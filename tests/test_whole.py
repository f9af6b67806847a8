"""Queries look at all of their input: small fixtures against plain restatements."""

import re

from faultlake.plans import text as X

ARTICLES = "article_id long, title string, source string, content string, fault_codes array<string>, part_numbers array<string>, tags array<string>, fetched_at string"
COMMON = re.compile(r"(?<!\w)(the|and|is|are|in|on|for|with|that|this|it)(?!\w)", re.I)


def english(text):
    letters = [c for c in text if c.isalpha()]
    return bool(text) and bool(COMMON.search(text) or letters and sum(c.isascii() for c in letters) / len(letters) > 0.8)


def write_articles(spark, folder):
    lines = [f"Line {k} of the pump & its <seal> at {k} bar." for k in range(12)]
    rows = [(1, " T  1", "s", "\n".join(lines), ["P0A0D"], ["AEV6804A"], ["ev"], "a"), (2, "T2", "s", "\n".join(["Насос", *lines[:5], "", "Насос в порядке", "The  end: it is dry."]), [], None, None, "a"),
            (3, "T3", "s", None, None, None, None, "a"), (4, None, "s", "", [], [], ["x", "x"], "a"), (5, "T5", "s", "Насос\nпорядок\nда\nнет", [], [], [], "a"), (None, "T6", "s", "x", [], [], [], "a")]
    spark.createDataFrame(rows, ARTICLES).write.parquet(f"{folder}/articles.parquet")
    return rows


def test_parsed_articles_hold_every_line(spark, tmp_path):
    rows = write_articles(spark, tmp_path)
    want = {}
    for i, _, _, content, codes, parts, _, _ in rows:
        if i is not None:
            lists = "Faults:" + "".join(codes or []) + "Part numbers:" + "".join(parts or [])
            found = [x for x in (" ".join(p.split()) for p in [*(content or "").split("\n"), lists, "Part numbers:"]) if x]
            want[i] = "\n\n".join([x for x in found if english(x)] or found)
    assert {r.page_id: r.content for r in X.fn27(spark, str(tmp_path)).collect()} == want


def test_html_nodes_hold_the_whole_content(spark, tmp_path):
    rows = write_articles(spark, tmp_path)
    from faultlake.sources import html

    got = {}
    for r in html.html_nodes(X._pages(spark, str(tmp_path))).where("tag = 'p'").orderBy("ord").collect():
        got.setdefault(r.page_id, r.text)
    assert got == {i: content or "" for i, _, _, content, *_ in rows if i is not None}
