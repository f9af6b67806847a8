"""Training-text operators do the whole job on inputs the test data does not have."""

import random

from faultlake.llm import leaks as L
from faultlake.llm import mainbody as M
from test_text import ARTICLE, ITEMS, page

NOTICE = "Readers of this small site may write to the editors at any time."


def test_small_sites_have_recurring_templates_in_a_large_corpus(spark):
    rng = random.Random(5)
    own = lambda i: f"The {''.join(rng.choice('abcdefgh') for _ in range(8))} was replaced after {i} days of work."
    site = [(i, "\n".join([NOTICE, "Home", own(i), "Repair", own(i), own(i), "Home", NOTICE])) for i in range(6)]
    rest = spark.range(1000, 15000).selectExpr("id as article_id", "concat('A page ', substr(md5(cast(id as string)), 1, 6), '.') as content", "concat('https://site', id % 40, '.example/', id) as source")
    got = {}
    for r in M.main_lines(spark.createDataFrame(site, ARTICLE).selectExpr("*", "'https://small.example/a' as source").union(rest)).where("article_id < 1000").collect():
        got.setdefault(r.article_id, set()).add(r.line_no)
    assert got == {i: {3, 4, 5, 6} for i in range(6)}


def test_joined_verdicts_are_the_sent_ones(spark, monkeypatch):
    rng = random.Random(3)
    made = {i: page(i, rng) for i in range(60)}
    df = spark.createDataFrame([(i, t) for i, (t, _) in made.items()] + [(0, made[0][0]), (900, None), (901, "")], ARTICLE)
    sent = {tuple(r) for r in M.main_text(df).collect()}
    monkeypatch.setattr(M, "MAX_SHARED", 0)
    got = {}
    for r in M.main_lines(df).collect():
        got.setdefault(r.article_id, set()).add(r.line_no)
    assert got == {i: own for i, (_, own) in made.items()}
    assert {tuple(r) for r in M.main_text(df).collect()} == sent


def test_text_between_two_passages_stays(spark):
    words = ITEMS[1][15:].split()
    own = " ".join(f"own{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}" for k in range(100))
    text = f"{own} {' '.join(words[:18])} {own} {' '.join(words[-18:])} {own}"
    df = spark.createDataFrame([(1, text), (2, own)], "doc_id long, text string")
    items = spark.createDataFrame(list(ITEMS.items()), "item_id long, text string")
    clean = {r.doc_id: r for r in L.without_leaks(df, items).collect()}
    assert clean[1].text.count(own) == 3 and "D39" not in clean[1].text and "K12" not in clean[1].text and clean[2].text == own
    assert clean[1].removed_words == len(L.words(text)) - len(L.words(clean[1].text)) and 30 <= clean[1].removed_words <= 44


def leaked(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r.doc_id, r.item_id): r.held_words for r in L.leaks(df, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}


NOISE = "the car was parked behind the mill and nobody looked at it for a week "


def test_items_that_are_part_of_others_are_found(spark):
    whole = "Suppose 66 cells at 3.2 volts feed lead D39-32 through the secondary encoder, losing 740 A every 57 seconds while 12 fans of type K12-44 stand still near the depot"
    part = " ".join(whole.split()[:14])
    got = leaked(spark, [(1, NOISE + part + " " + NOISE), (2, NOISE + whole), (3, NOISE)], {1: whole, 2: part, 3: part})
    assert set(got) == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)} and got[1, 2] == len(L.words(part))


def test_short_items_are_found(spark):
    items = {1: "Bleed cylinder 7 before valve 12 opens.", 2: "Torque 44 first."}
    got = leaked(spark, [(1, NOISE + "bleed CYLINDER 7, before valve 12 " + NOISE), (2, NOISE + "torque 44 first " + NOISE), (3, "torque first 44 bleed valve 12")], items)
    assert set(got) == {(1, 1), (2, 2)}


def test_look_alikes_do_not_hide_a_passage(spark):
    """Six passages of the same wording with other numbers stand before the real one."""
    real = ITEMS[1][15:]
    other = lambda k: "".join(str((int(c) + k) % 10) if c.isdigit() else c for c in real)
    text = NOISE.join([*(other(k) for k in range(1, 7)), " ".join(w if i % 10 else "changed" for i, w in enumerate(real.split()))])
    assert (1, 1) in leaked(spark, [(1, text)], ITEMS)


def test_very_long_texts_are_aligned_in_stretches(spark):
    words = ITEMS[1][15:].split()
    text = NOISE * 8000 + " ".join(words[:20]) + " " + NOISE * 8000 + " ".join(words[20:]) + NOISE * 8000
    got = leaked(spark, [(1, text)], ITEMS)
    assert got[1, 1] >= len(L.words(" ".join(words))) - 4


def test_stretches_give_the_alignment_of_the_whole(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    number = np.zeros(41, dtype=bool)
    number[30:] = True
    for _ in range(20):
        own = rng.integers(1, 41, 12)
        text = rng.integers(0, 41, 400)
        at = rng.integers(0, 380)
        text[at:at + 9] = own[2:11]
        whole = L._align(own, text, number)
        monkeypatch.setattr(L, "STRETCH", 16)
        assert L.align(own, text, number) == whole[0]


def test_blocks_of_items_give_the_same_leaks(spark, monkeypatch):
    docs = [(k, NOISE + ITEMS[1 + k % 2][15:] + NOISE) for k in range(4)]
    once = leaked(spark, docs, ITEMS)
    monkeypatch.setattr(L, "BLOCK_WORDS", 10)
    assert leaked(spark, docs, ITEMS) == once and set(once) == {(0, 1), (1, 2), (2, 1), (3, 2)}
