"""Evaluation texts leaking into training text (problem 7).

The items' normalised n-grams (five words; all words of shorter items) form a hash set that is broadcast; every document's token windows are
scanned against it. In each segment of an item the n-grams that belong to the fewest items are looked for: those of its own, or, where a stretch stands in other items
too, those it shares with them. Documents with hits are verified by local alignment of words: a passage is an alignment in order that bears a few
changed words, and it counts for an item only if it repeats the item's own numbers. Up to two passages
together must hold ``HELD`` of the item's words. The opening instruction (leading sentences that other items
share) is not counted.

Words are runs of letters and digits in lower case, so case, punctuation, markup and line breaks do not
matter. Null or empty texts hold nothing; an item without words of its own matches nothing; two items with
the same words both come out, and so does an item that is part of another if a document holds that part. Items go to the tasks in blocks of up to
``BLOCK_WORDS`` words, each of which is one pass over the documents, so their number has no limit.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N, HELD = 5, 0.4
BLOCK_WORDS = 5_000_000
#: A passage must be at least so many words (fewer for items of which that is more than HELD), and repeat this share of the numbers it spans.
LEAST_WORDS, OWN_NUMBERS = 8, 0.6
#: Every so many n-grams of an item, or a quarter of what must be held, those of the fewest items are looked for.
SEGMENT = 5
#: Text is aligned in stretches of so many words, or eight times the item's.
STRETCH = 8192
GAP = 0.8

PASSAGES = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32())]))

_WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def case_texts(items: DataFrame) -> DataFrame:
    """(item_id, text): each item without its opening instruction, the leading sentences that other items have too; its last sentence stays."""
    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.trim("text").alias("text")).dropDuplicates(["item_id"])
    parts = rows.select("item_id", F.posexplode(F.split("text", r"(?<=[.?!])\s+")).alias("k", "sentence"), F.size(F.split("text", r"(?<=[.?!])\s+")).alias("n"))
    shared = parts.groupBy("sentence").agg(F.countDistinct("item_id").alias("owners"))
    own = parts.join(shared, "sentence").withColumn("opens", (F.col("owners") > 1) & (F.col("k") < F.col("n") - 1))
    first = own.groupBy("item_id").agg(F.min(F.when(~F.col("opens"), F.col("k"))).alias("first"))
    kept = own.join(first, "item_id").where("k >= first")
    # one item's sentences
    return kept.groupBy("item_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "sentence"))), lambda x: x["sentence"]), " ").alias("text"))


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` words."""
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(len(ids) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        h = (h ^ ids[k:len(ids) - n + 1 + k].astype(np.uint64)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


class Vocabulary(dict):
    """word -> number from 1 on, 0 for words of no item."""

    def __missing__(self, word: str) -> int:
        return 0


class Index:
    """Vocabulary, n-gram hashes with their owners, and words of a block of items."""

    def __init__(self, texts: dict[int, str]) -> None:
        self.vocabulary = Vocabulary()
        self.items: dict[int, np.ndarray] = {}
        for i, text in texts.items():
            own = words(text)
            if own:
                self.items[i] = np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in own], dtype=np.int64)
        self.number = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        for x, k in self.vocabulary.items():
            self.number[k] = any(c.isdigit() for c in x)
        runs = {i: grams(ids, min(N, len(ids))).tolist() for i, ids in self.items.items()}
        owners: dict[int, set[int]] = defaultdict(set)
        for i, own in runs.items():
            for h in own:
                owners[h].add(i)
        # items with the very same words count as one owner
        same = {i: ids.tobytes() for i, ids in self.items.items()}
        count = {h: len({same[i] for i in o}) for h, o in owners.items()}
        found: dict[int, set[int]] = defaultdict(set)
        for i, own in runs.items():
            size = max(SEGMENT, int(np.ceil(HELD * len(own) / 4)))
            for k in range(0, len(own), size):
                segment = own[k:k + size]
                fewest = min(count[h] for h in segment)
                for h in segment:
                    if count[h] == fewest:
                        found[h].add(i)
        kept = {h: sorted(o) for h, o in sorted(found.items())}
        self.hashes = np.array(list(kept), dtype=np.uint64)
        self.owners = list(kept.values())
        self.lengths = sorted({min(N, len(ids)) for ids in self.items.values()})

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of windows that are n-grams of the index, and the places of these in ``owners``."""
        at, of = [], []
        for n in self.lengths:
            h = grams(ids, n)
            if len(h):
                # only windows of known words are looked up
                known = np.cumsum(np.concatenate([[0], ids > 0]))
                some = np.flatnonzero(known[n:] - known[:-n] == n)
                place = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
                good = self.hashes[place] == h[some]
                at.append(some[good])
                of.append(place[good])
        return (np.concatenate(at), np.concatenate(of)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def possible(self, known: np.ndarray, item: int, held: float) -> bool:
        """Whether two stretches of ``item`` whose numbers are mostly among the ``known`` words of a document could be enough; never too strict."""
        own = self.items[item]
        here, number = np.isin(own, known), self.number[own]
        if here.sum() < held * len(own):
            return False
        if len(own) > 1000:  # the table of all stretches would be large
            return True
        words, numbers, found = (np.concatenate([[0], np.cumsum(x)]) for x in (here, number, number & here))
        good = found[None, :] - found[:, None] >= OWN_NUMBERS * (numbers[None, :] - numbers[:, None])
        return bool(2 * np.max((words[None, :] - words[:, None]) * good) >= held * len(own))

    def held(self, ids: np.ndarray, item: int) -> tuple[int, list[tuple[int, int]]]:
        """Words of ``item`` that a document holds in one or two passages, and the passages' token spans."""
        own, text = self.items[item].copy(), ids.copy()
        least = min(LEAST_WORDS, max(1, int(np.ceil(HELD * len(own)))))
        total, spans, item_spans = 0, [], []
        while len(spans) < 2:  # an alignment that repeats no numbers is masked and does not count as one of the two
            found = align(own, text, self.number)
            if found is None or len(found[0]) < least:
                break
            pairs, (a, b), (c, d) = found
            numbers = [k for k in range(a, b) if self.number[own[k]]]
            matched = {k for k, _ in pairs}
            good = not numbers or sum(k in matched for k in numbers) >= OWN_NUMBERS * len(numbers)
            if good and all((a >= y) == (c >= w) for (x, y), (v, w) in zip(item_spans, spans, strict=True)):
                total += len(pairs)
                spans.append((c, d))
                item_spans.append((a, b))
                own[a:b] = -1  # matches nothing any more
            text[c:d] = -2
        return total, spans


Alignment = tuple[list[tuple[int, int]], tuple[int, int], tuple[int, int]]


def align(own: np.ndarray, text: np.ndarray, number: np.ndarray) -> Alignment | None:
    """Best local alignment: matched (own, text) places, the span in ``own``, the span in ``text``.

    The text is taken in stretches that overlap by more than an alignment can span (each word of the item adds at most 2 and each gap
    costs GAP), so memory is bounded by the item, not by the document, and the best one is always inside a stretch. Stretches that hold no word of the item are passed over.
    """
    reach = int(len(own) * (1 + 2 / GAP)) + 2
    size = max(STRETCH, 2 * reach)
    known = np.isin(text, own[own > 0])
    best, top = None, 0.0
    for begin in range(0, max(1, len(text) - reach), size - reach):
        if not known[begin:begin + size].any():
            continue
        found, score = _align(own, text[begin:begin + size], number)
        if found is not None and score > top:
            pairs, span, (c, d) = found
            best, top = ([(i, j + begin) for i, j in pairs], span, (c + begin, d + begin)), score
    return best


def _align(own: np.ndarray, text: np.ndarray, number: np.ndarray) -> tuple[Alignment | None, float]:
    """The best local alignment of one stretch and its score.

    Rows are vectorised over the text; a gap in the text is opened from the best cell to the left by a
    running maximum, so the cost is one pass of array operations for each word of the item.
    """
    n, m = len(own), len(text)
    is_number = np.zeros(n, dtype=bool)
    valid = own > 0
    is_number[valid] = number[own[valid]]
    score = np.zeros((n + 1, m + 1))
    slope = GAP * np.arange(m + 1)
    for i in range(1, n + 1):
        same = text == own[i - 1]
        plus, minus = (2.0, 1.5) if is_number[i - 1] else (1.0, 0.9)
        row = np.zeros(m + 1)
        row[1:] = np.maximum(score[i - 1, :-1] + np.where(same, plus, -minus), score[i - 1, 1:] - GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum(row, np.maximum.accumulate(row + slope) - slope)
        score[i] = row
    end = int(np.argmax(score))
    i, j = divmod(end, m + 1)
    top = float(score[i, j])
    if top <= 0:
        return None, 0.0
    last = (i, j)
    pairs = []
    while i and j and score[i, j] > 1e-9:
        same = text[j - 1] == own[i - 1]
        plus, minus = (2.0, 1.5) if is_number[i - 1] else (1.0, 0.9)
        if abs(score[i, j] - (score[i - 1, j - 1] + (plus if same else -minus))) < 1e-6:
            if same:
                pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif abs(score[i, j] - (score[i - 1, j] - GAP)) < 1e-6:
            i -= 1
        else:
            j -= 1
    if not pairs:
        return None, 0.0
    pairs.reverse()
    return (pairs, (pairs[0][0], last[0]), (pairs[0][1], last[1])), top


def _blocks(items: DataFrame) -> Iterator[dict[int, str]]:
    """The items' case texts in blocks of up to BLOCK_WORDS words (one item at least)."""
    block: dict[int, str] = {}
    size = 0
    for r in case_texts(items).orderBy("item_id").toLocalIterator():
        n = len(words(r["text"]))
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = {}, 0
        block[r["item_id"]] = r["text"]
        size += n
    if block:
        yield block


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", held: float = HELD) -> DataFrame:
    """(key, item_id, held_words, item_words, passages) of every document that holds an item.

    ``passages`` has (first_word, last_word) of each passage in the document's words, for removing it.
    """
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id long, held_words int, item_words int, passages array<struct<first_word: int, last_word: int>>"
    plain = documents.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text)
    out = documents.sparkSession.createDataFrame([], schema)
    for block in _blocks(items):
        out = out.union(_leaks_of(plain, Index(block), key, schema, held))
    return out


def _leaks_of(documents: DataFrame, index: Index, key: str, schema: str, held: float) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            at, out = [], [[] for _ in range(4)]
            for r, t in enumerate(batch.column(1).to_pylist()):
                found = words(t)
                ids = np.fromiter(map(index.vocabulary.__getitem__, found), np.int64, len(found))
                hits = set(index.hits(ids)[1].tolist())
                known = np.unique(ids) if hits else ids
                for item in sorted({i for k in hits for i in index.owners[k]}):
                    if not index.possible(known, item, held):
                        continue
                    own = len(index.items[item])
                    n, spans = index.held(ids, item)
                    if n >= held * own:
                        at.append(r)
                        for column, x in zip(out, (item, n, own, [{"first_word": a, "last_word": b} for a, b in sorted(spans)]), strict=True):
                            column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), pa.array(out[0], pa.int64()), *(pa.array(x, pa.int32()) for x in out[1:3]), pa.array(out[3], PASSAGES)],
                names=[key, "item_id", "held_words", "item_words", "passages"])

    return documents.mapInArrow(run, schema)


def without_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text, removed_words): every document with the leaked passages cut out of its text.

    Text from the first to the last word of each passage goes, what stands between passages stays; documents without
    leaks stay as they are.
    """
    found = leaks(documents, items)
    each = found.select("doc_id", F.explode("passages").alias("passage"))
    spans = each.groupBy("doc_id").agg(F.sort_array(F.collect_set("passage")).alias("spans"))  # at most two for each item

    @F.pandas_udf("struct<text: string, removed_words: int>")
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, own in zip(text, spans, strict=True):
            if t is None or own is None or not len(own):
                out.append((t, 0))
                continue
            # Lower case may change the length of a text, so places are taken from the text as it stands.
            at = [m.span() for m in _WORD.finditer(t)]
            keep, begin, removed, last = [], 0, 0, 0
            for span in own:
                a, b = span["first_word"], min(span["last_word"], len(at))
                if a < b and at[b - 1][1] > begin:
                    keep.append(t[begin:max(begin, at[a][0])])
                    begin, removed, last = at[b - 1][1], removed + b - max(a, last), b  # passages of two items may overlap
            out.append(("".join(keep) + t[begin:], removed))
        return pd.DataFrame(out, columns=["text", "removed_words"])

    joined = documents.select("doc_id", "text").join(spans, "doc_id", "left")
    leaked = joined.where("spans is not null").withColumn("c", cut("text", "spans")).select("doc_id", "c.text", "c.removed_words")
    return leaked.union(joined.where("spans is null").select("doc_id", "text", F.lit(0)))
