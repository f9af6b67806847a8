"""Splitting oversized items at natural boundaries (problem 1).

A text longer than ``limit`` comes out as ordered pieces of at most ``limit`` units. Token offsets are
prefix sums, boundaries are sorted arrays of token places by strength (paragraph, line, sentence); a binary
search gives the last boundary under the limit, the next piece steps back by up to ``overlap`` units, and a
stretch without any boundary is cut hard, between words where it has words.

Units are characters (Unicode code points, as stored) or, with ``unit='words'``, words. Null texts and
texts within the limit give no pieces here (``whole`` in ``pieces_of`` returns them as one piece). Text is never
trimmed or changed: each piece is ``text[start:end]``, and the pieces without their overlap give the text again.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1500, 150

_TOKEN = re.compile(r"\s+|\w+|[^\w\s]")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
_LINE = re.compile(r"\n\s*")
_SENTENCE = re.compile(r"[.!?…。！？]+[\"'”’»)\]]*\s+")


def spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP, unit: str = "chars") -> list[tuple[int, int]]:
    """Character spans (start, end) of the pieces of ``text``; one span if it is within the limit."""
    if limit <= 0 or overlap < 0 or overlap >= limit:
        raise ValueError("0 <= overlap < limit is needed")
    if unit == "chars" and len(text) <= limit:
        return [(0, len(text))]
    ends = [m.end() for m in _TOKEN.finditer(text)]
    starts = [0, *ends]  # starts[i]: the character at which token i begins; the last is the end of the text
    # size[i]: units before token i
    size = starts if unit == "chars" else [0, *accumulate(1 if re.match(r"\w", text[a:b]) else 0 for a, b in zip(starts, ends, strict=False))]
    if size[-1] <= limit:
        return [(0, len(text))]
    levels = [sorted({bisect_left(starts, m.end()) for m in p.finditer(text)}) for p in (_PARAGRAPH, _LINE, _SENTENCE)]
    every = sorted(set().union(*levels))
    out: list[tuple[int, int]] = []
    begin = end = 0  # characters at which the piece begins and the piece before ended
    while True:
        base = begin if unit == "chars" else size[bisect_left(starts, begin)]
        top = bisect_right(size, base + limit) - 1  # the last token boundary within the limit
        if top >= len(ends):
            out.append((begin, len(text)))
            return out
        first = bisect_right(starts, max(begin, end))  # the first token boundary that makes progress
        if top < first:  # one token does not fit: cut inside it
            cut, here = begin + limit, None
        else:
            here = _boundary(levels, every, text, starts, size, base, limit, overlap, first, top)
            cut = starts[here]
        out.append((begin, cut))
        back = cut - overlap if unit == "chars" else starts[bisect_left(size, size[here] - overlap)]
        back = max(back, begin + 1)
        if here is not None:
            k = bisect_left(starts, back)
            n = bisect_left(every, k)
            if n < len(every) and every[n] < here:  # repeat from the start of a sentence where one lies in the overlap
                k = every[n]
            while k < here and text[starts[k]].isspace():
                k += 1
            back = starts[k]
        begin, end = back, cut


def _boundary(levels: list[list[int]], every: list[int], text: str, starts: list[int], size: list[int], base: int, limit: int, overlap: int, first: int, top: int) -> int:
    """The token at which to cut, from ``first`` to ``top``: the last strong boundary of the second half, any later than the overlap, a word, a token."""
    half = max(first, bisect_left(size, base + limit // 2))
    for level in levels:
        k = bisect_right(level, top)
        if k and level[k - 1] >= half:
            return level[k - 1]
    beyond = max(first, bisect_right(size, base + overlap))
    k = bisect_right(every, top)
    if k and every[k - 1] >= beyond:
        return every[k - 1]
    for cut in range(top, beyond - 1, -1):
        if text[starts[cut] - 1].isspace() and not text[starts[cut]].isspace():
            return cut
    return top


def pieces_of(items: DataFrame, keys: list[str], text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, unit: str = "chars") -> DataFrame:
    """(keys, piece_no, start_char, end_char, piece) of every text over the limit.

    Only texts that are too long leave the JVM. ``keys`` identify an item; columns named like the output's
    beside them are dropped, and an item given twice comes out once.
    """
    long = items.select(*keys, F.col(text).alias("_text")).where(F.length("_text") > limit)  # a text of n words has more than n characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, start, end, piece = [], [], [], [], []
            for i, s in enumerate(batch.column(len(keys)).to_pylist()):
                found = spans(s, limit, overlap, unit)
                for n, (a, b) in enumerate(found if len(found) > 1 else (), 1):
                    at.append(i)
                    no.append(n)
                    start.append(a)
                    end.append(b)
                    piece.append(s[a:b])
            index = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(index) for k in range(len(keys))), pa.array(no, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(piece, pa.string())],
                names=[*keys, "piece_no", "start_char", "end_char", "piece"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in long.select(*keys).schema) + ", piece_no int, start_char int, end_char int, piece string"
    return long.mapInArrow(run, schema)


def texts(dtc_records: DataFrame, code_records: DataFrame) -> DataFrame:
    """(item_table, record_id, item_pos, text) of every section and block; reads ids and texts only."""
    def of(records: DataFrame, name: str, field: str) -> DataFrame:
        return (records.where("record_id is not null").select("record_id", F.posexplode(field).alias("p", "text"))
                .select(F.lit(name).alias("item_table"), "record_id", (F.col("p") + 1).alias("item_pos"), "text"))
    return of(dtc_records, "dtc_records", "sections.cleaned_text").union(of(code_records, "code_records", "content_blocks.text"))


KEYS = ["item_table", "record_id", "item_pos"]


def split_records(dtc_records: DataFrame, code_records: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The pieces of every section and block text over the limit; a record delivered again counts once."""
    return pieces_of(texts(dtc_records, code_records), KEYS, "text", limit, overlap).dropDuplicates([*KEYS, "piece_no"])


def oversized(dtc_records: DataFrame, code_records: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(item_table, record_id, item_pos) of every text that was split."""
    cut = pieces_of(texts(dtc_records, code_records), KEYS, "text", limit, overlap).where("piece_no = 2")
    return cut.select("item_table", "record_id", "item_pos").distinct()
