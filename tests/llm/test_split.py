import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faultlake.llm import split as S


def check(text, limit, overlap):
    found = S.spans(text, limit, overlap)
    assert found[0][0] == 0 and found[-1][1] == len(text)
    assert all(0 < b - a <= limit or not text for a, b in found)
    for (a, b), (c, d) in zip(found, found[1:], strict=False):
        assert a < c <= b < d and b - c <= overlap  # in order, no gap, repeating at most the overlap
    return found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .\n!é漢", max_size=400), st.integers(2, 60), st.integers(0, 59))
def test_pieces_cover_the_text(text, limit, overlap):
    check(text, limit, min(overlap, limit - 1))


def test_cuts_at_natural_boundaries():
    rng = random.Random(1)
    sentences = [" ".join("word%d" % rng.randint(0, 99) for _ in range(rng.randint(3, 25))) + "." for _ in range(300)]
    text = ""
    for s in sentences:
        text += s + rng.choice([" ", " ", "\n", "\n\n"])
    found = check(text, 1500, 150)
    assert len(found) > 10
    assert all(re.search(r"[.]\s+$", text[a:b]) for a, b in found[:-1])
    paragraphs = ("x" * 700 + ".\n\n") * 5
    assert all(paragraphs[a:b].endswith("\n\n") for a, b in check(paragraphs, 1500, 100)[:-1])


def test_hard_cuts_and_limits():
    assert check("x" * 100, 30, 10)[0] == (0, 30)
    assert S.spans("", 10, 2) == [(0, 0)] and S.spans("x" * 10, 10, 2) == [(0, 10)]
    long = check("é" * 200_000, 1500, 150)
    assert len(long) >= 200_000 // 1500
    with pytest.raises(ValueError):
        S.spans("abc", 10, 10)
    words = S.spans("one two three four five. six seven", 3, 1, unit="words")
    assert len(words) > 1 and words[-1][1] == len("one two three four five. six seven")


def test_table(spark):
    text = "Hello there. " * 200
    rows = [("a", 1, text), ("a", 1, text), ("b", 1, None), ("c", 2, ""), ("d", 3, "x" * 1500), ("e", 4, "𝄞" * 1501)]
    df = spark.createDataFrame(rows, "record_id string, item_pos int, text string").selectExpr("*", "'z' as piece", "1 as piece_no")
    got = S.pieces_of(df, ["record_id", "item_pos"]).dropDuplicates(["record_id", "item_pos", "piece_no"]).orderBy("record_id", "piece_no").collect()
    assert {r.record_id for r in got} == {"a", "e"}
    assert [r.piece for r in got if r.record_id == "a"] == [text[r.start_char:r.end_char] for r in got if r.record_id == "a"]
    assert S.pieces_of(df.limit(0), ["record_id"]).count() == 0
