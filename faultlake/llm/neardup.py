"""Near-duplicate records with small edits (problem 3).

A record is the set of its distinct three-word runs, hashed to 64 bits; two records are a case if their sets'
Jaccard similarity is at least ``SIMILAR``. The runs are hashed into ``GROUPS`` groups and the group counts are
the record's point: the overlap of two records is at most the sum of the smaller coordinates, and a similarity of
t needs an overlap of t / (1 + t) of both sizes together. An R-tree over such points, with the largest coordinates
of everything below each node, therefore prunes pairs exactly, and what is left is verified on the sets themselves.

At this similarity the bound cannot tell apart large mixed nodes, so one tree over a whole collection would compare
everything with everything. Records are first routed to small blocks: ``BANDS`` keys of ``ROWS`` minimum hashes each, where
two records of similarity J share a block with probability 1 - (1 - J**ROWS)**BANDS. Blocks of two or three records are
settled by an aggregate, larger ones by an R-tree in the block; a block of more than ``BLOCK`` records is cut into parts
and joined part by part, so no task holds more than two parts. Blocks are never cut short.

Records with the same set are merged before any block is made, so a text with millions of copies is one member of its blocks; pairs of copies are written only in
``similar_records``. Null or empty texts and texts of fewer than three words have no runs and are no case. Rows
without an id are left out, and a record delivered again counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultlake.session import checked_broadcast, stage

WIDTH, SIMILAR = 3, 0.5
GROUPS, BANDS, ROWS = 256, 64, 4
FULL = 255
BLOCK, LEAF, CELL = 2048, 16, 8192
#: Up to so many ids of surviving records are sent to the tasks; more are joined by shuffle.
MAX_BROADCAST = 300_000

_WORD = re.compile(r"[^\W_]+")
_SEEDS = np.random.default_rng(20_240_601).integers(1, 2**32, size=(2, BANDS * ROWS), dtype=np.uint32)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    """word -> 64-bit hash, kept for the words of a task."""

    def __missing__(self, word: str) -> int:
        if len(self) > 2_000_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str | None], hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed runs of all texts one after another, and the number of each text's."""
    found = [_WORD.findall(t.lower()) if t else [] for t in texts]
    lengths = np.array([len(w) for w in found], dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    w = np.fromiter(map(hashes.__getitem__, chain.from_iterable(found)), np.uint64, total)
    if total < WIDTH:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    h = w[: total - WIDTH + 1].copy()
    for k in range(1, WIDTH):
        h = _mix(h) ^ w[k: total - WIDTH + 1 + k]
    h = _mix(h)
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = owner[: total - WIDTH + 1] == owner[WIDTH - 1:]
    h, owner = h[inside], owner[: total - WIDTH + 1][inside]
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    parts = [np.unique(h[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array([len(p) for p in parts], np.int64)


def _signatures(sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, block keys (n x BANDS) and group counts (n x GROUPS) of non-empty sets."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = _mix(_mix(np.bitwise_xor.reduceat(_mix(sets ^ _B), starts)) ^ np.add.reduceat(sets, starts) * _A ^ sizes.astype(np.uint64))
    keys = np.empty((len(sizes), BANDS), np.uint64)
    low = (sets >> np.uint64(16)).astype(np.uint32)
    for band in range(BANDS):
        key = np.full(len(sizes), band + 1, np.uint64)
        for row in range(ROWS):
            k = band * ROWS + row
            v = (low ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint32(1))
            key = _mix(key) ^ np.minimum.reduceat(v, starts).astype(np.uint64)
        keys[:, band] = _mix(key)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    cell = owner * GROUPS + (sets >> np.uint64(56)).astype(np.int64) % GROUPS
    counts = np.bincount(cell, minlength=len(sizes) * GROUPS).reshape(len(sizes), GROUPS)
    return mark, keys, np.minimum(counts, FULL).astype(np.uint8)


def _chunks(batch: pa.RecordBatch, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about so many characters each."""
    sizes = np.cumsum([len(t) if t else 0 for t in batch.column(1).to_pylist()])
    begin = 0
    while begin < batch.num_rows:
        base = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, base + most, side="right")))
        yield begin, end
        begin = end


def _packed(counts: np.ndarray) -> list[bytes]:
    """Points as one byte for each group; FULL stands for any higher count."""
    return [row.tobytes() for row in counts]


def signatures(records: DataFrame) -> DataFrame:
    """(record_id, mark, size, keys, point) of every record with runs. ``records``: record_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for begin, end in _chunks(batch):
                part = batch.slice(begin, end - begin)
                sets, sizes = shingle_sets(part.column(1).to_pylist(), hashes)
                rows = np.flatnonzero(sizes)
                if not len(rows):
                    continue
                mark, keys, counts = _signatures(sets, sizes[rows])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), pa.array(mark.view(np.int64)), pa.array(sizes[rows].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64))),
                     pa.array(_packed(counts), pa.binary())], names=["record_id", "mark", "size", "keys", "point"])

    return records.select("record_id", "text").mapInArrow(run, "record_id string, mark long, size int, keys array<long>, point binary")


def _needed(a, b):
    """Least overlap of two sets of sizes a and b with the similarity wanted."""
    return SIMILAR / (1 + SIMILAR) * (a + b) - 1e-9


class RTree:
    """Points with sizes, packed bottom-up; a node has the largest coordinates and least size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.points, self.sizes = points, sizes
        order = self._order(np.arange(len(sizes)))
        self.leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
        self.levels = [(np.array([points[x].max(axis=0) for x in self.leaves]), np.array([sizes[x].min() for x in self.leaves]), np.array([sizes[x].max() for x in self.leaves]))]
        while len(self.levels[-1][1]) > 1:
            top, small, large = self.levels[-1]
            cuts = range(0, len(small), LEAF)
            self.levels.append((np.array([top[i:i + LEAF].max(axis=0) for i in cuts]), np.array([small[i:i + LEAF].min() for i in cuts]), np.array([large[i:i + LEAF].max() for i in cuts])))

    def _order(self, rows: np.ndarray) -> np.ndarray:
        """Rows so that neighbours are alike: halves by the coordinate of largest spread, again and again."""
        out, stack = [], [rows]
        while stack:
            rows = stack.pop()
            if len(rows) <= LEAF:
                out.append(rows)
                continue
            p = self.points[rows].astype(np.float32)
            by = rows[np.argsort(p[:, int(p.var(axis=0).argmax())], kind="stable")]
            half = (len(by) // 2 + LEAF - 1) // LEAF * LEAF
            stack.extend((by[half:], by[:half]))
        return np.concatenate(out) if out else rows

    def pairs_with(self, other: RTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers (self, other) of all pairs that the bound does not rule out, leaf by leaf."""
        a, b = len(self.levels) - 1, len(other.levels) - 1
        pairs = [(0, 0)]
        while a or b:  # the higher of the two is opened
            if a >= b:
                pairs = [(c, j) for i, j in pairs for c in range(i * LEAF, min((i + 1) * LEAF, len(self.levels[a - 1][1])))]
                a -= 1
            else:
                pairs = [(i, c) for i, j in pairs for c in range(j * LEAF, min((j + 1) * LEAF, len(other.levels[b - 1][1])))]
                b -= 1
            pairs = self._open(other, a, b, pairs)
        if not self.levels[0][1].size or not other.levels[0][1].size:
            return
        for i, j in pairs:
            x, y = self.leaves[i], other.leaves[j]
            p, q = np.repeat(x, len(y)), np.tile(y, len(x))
            keep = np.minimum(self.points[p], other.points[q]).sum(axis=1, dtype=np.int64) >= _needed(self.sizes[p], other.sizes[q])
            yield p[keep], q[keep]

    def _open(self, other: RTree, a: int, b: int, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        (p, small, _), (q, least, _) = self.levels[a], other.levels[b]
        out = []
        for begin in range(0, len(pairs), 4096):
            i, j = np.array(pairs[begin:begin + 4096]).T
            keep = np.minimum(p[i], q[j]).sum(axis=1, dtype=np.int64) >= _needed(small[i], least[j])
            out.extend(zip(i[keep].tolist(), j[keep].tolist(), strict=True))
        return out


def _points(column: pd.Series) -> np.ndarray:
    """Points as numbers; a count that is FULL is taken as unlimited, so that no bound is too small."""
    found = np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), GROUPS).astype(np.uint16)
    found[found == FULL] = 65535
    return found


def _cell_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of marks of the blocks in one cell that the bound does not rule out."""
    rows = rows.sort_values(["block", "mark"], kind="stable").reset_index(drop=True)
    marks, sizes, points, part = rows["mark"].to_numpy(), rows["size"].to_numpy(np.int64), _points(rows["point"]), rows["part"].to_numpy()
    cuts = np.flatnonzero(np.diff(rows["block"].to_numpy())) + 1
    out = []
    for begin, end in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        own = np.arange(begin, end)
        left, right = own[part[own] <= 0], own[part[own] != 0]
        if part[begin] == -1 or not len(left) or not len(right):  # a whole block, or one part with itself
            tree = other = RTree(points[own], sizes[own])
            left = right = own
        else:
            tree, other = RTree(points[left], sizes[left]), RTree(points[right], sizes[right])
        for p, q in tree.pairs_with(other):
            x, y = marks[left[p]], marks[right[q]]
            out.append(np.stack([np.minimum(x, y), np.maximum(x, y)])[:, x != y])
    found = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((2, 0), np.int64)
    return pd.DataFrame({"a": found[0], "b": found[1]})


def candidates(found: DataFrame) -> DataFrame:
    """(a, b): pairs of marks that share a block and that the bound does not rule out; ``found`` as of ``signatures`` with each mark once, staged."""
    blocks = found.select("mark", F.explode("keys").alias("block"))
    counted = stage(blocks.groupBy("block").agg(F.count("*").alias("n"), F.min("mark").alias("a"), F.max("mark").alias("b"), F.bit_xor("mark").alias("x")).where("a <> b"))
    third = F.col("x").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b"))
    three = counted.where("n = 3").select("a", third.alias("c"), "b")
    few = (counted.where("n = 2").select("a", "b").union(three.select("a", "b")).union(three.select("a", "c")).union(three.select("c", "b"))
           .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    points = found.select("mark", "size", "point")
    few = _bounded(few, points)
    # Larger blocks: their members' points in cells of about CELL rows; a block beyond BLOCK rows in pairs of parts.
    large = counted.where("n > 3").select("block", "n")
    members = stage(blocks.join(checked_broadcast(large, MAX_BROADCAST), "block"))
    if members.limit(1).count() == 0:
        return few
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("mark", "block"), parts).cast("int")
    placed = members.select("mark", "block", parts.alias("parts"), own.alias("own"))
    # part: -1 in a whole block; in a cut one 0 for rows of the first part of a pair of parts, 1 for the second
    pairs = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(-1).alias("part")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
            F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), F.when(F.col("own") <= k, 0).otherwise(1).alias("part"))))
    total = max(1, members.count() // CELL + 1)
    cell = F.when(F.col("p.part") == -1, F.struct(F.pmod(F.xxhash64("block"), F.lit(total)).alias("cell"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))).otherwise(
        F.struct(F.col("block").alias("cell"), F.col("p.i").alias("i"), F.col("p.j").alias("j")))
    spread = placed.select("mark", "block", F.explode(pairs).alias("p")).select("mark", "block", F.col("p.part").alias("part"), cell.alias("cell"))
    many = spread.join(points, "mark").groupBy("cell").applyInPandas(_cell_pairs, "a long, b long")
    return few.union(many).distinct()


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs whose summed smaller coordinates allow the similarity wanted."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                best = np.minimum(_points(rows["p"]), _points(rows["q"])).sum(axis=1, dtype=np.int64)
                rows = rows[best >= _needed(rows["m"].to_numpy(), rows["n"].to_numpy())]
            yield rows[["a", "b"]]

    left = points.select(F.col("mark").alias("a"), F.col("size").alias("m"), F.col("point").alias("p"))
    right = points.select(F.col("mark").alias("b"), F.col("size").alias("n"), F.col("point").alias("q"))
    sized = pairs.join(left.drop("p"), "a").join(right.drop("q"), "b").where("least(m, n) >= {0} * greatest(m, n) - 1e-9".format(SIMILAR)).select("a", "b")
    return sized.join(left, "a").join(right, "b").mapInPandas(keep, "a long, b long")


def verified(records: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, similarity): the pairs whose sets are as similar as wanted."""
    pairs = stage(pairs)
    wanted = pairs.select(F.col("a").alias("mark")).union(pairs.select("b")).distinct()
    chosen = stage(found.join(checked_broadcast(wanted, MAX_BROADCAST), "mark", "left_semi").groupBy("mark").agg(F.min("record_id").alias("record_id")))
    text = records.select("record_id", "text").join(checked_broadcast(chosen, MAX_BROADCAST), "record_id").dropDuplicates(["mark"]).select("mark", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for begin, end in _chunks(batch):
                part = batch.slice(begin, end - begin)
                own, sizes = shingle_sets(part.column(1).to_pylist(), hashes)
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([own[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], names=["mark", "runs"])

    runs = stage(text.mapInArrow(sets, "mark long, runs binary"))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for p, q in zip(rows["p"], rows["q"], strict=True):
                x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                n = len(np.intersect1d(x, y, assume_unique=True))
                out.append(n / (len(x) + len(y) - n))
            rows = rows[["a", "b"]].assign(similarity=np.array(out, dtype=float))
            yield rows[rows["similarity"] >= SIMILAR]

    return (pairs.join(runs.select(F.col("mark").alias("a"), F.col("runs").alias("p")), "a")
            .join(runs.select(F.col("mark").alias("b"), F.col("runs").alias("q")), "b")
            .mapInPandas(exact, "a long, b long, similarity double"))


def code_texts(records: DataFrame) -> DataFrame:
    """(record_id, text): the title and the texts of the text blocks in array order."""
    blocks = F.arrays_zip(F.col("content_blocks.block_type").alias("kind"), F.col("content_blocks.text").alias("text"))
    body = F.transform(F.filter(blocks, lambda b: b["kind"] == "text"), lambda b: b["text"])
    return records.where("record_id is not null").select("record_id", F.concat_ws(" ", "title", body).alias("text"))


def similar_marks(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged: (mark, record_id) of all records with runs, and the similar pairs of marks (a, b, similarity)."""
    found = stage(signatures(records))
    once = stage(found.select("mark", "size", "keys", "point").dropDuplicates(["mark"]))
    pairs = stage(verified(records, found, candidates(once)))
    return found.select("mark", "record_id").distinct(), pairs


def similar_records(records: DataFrame) -> DataFrame:
    """(record_a, record_b) of all similar pairs of different records, smaller id first; copies are written out."""
    members, pairs = similar_marks(records)
    left, right = members.select(F.col("mark").alias("a"), F.col("record_id").alias("x")), members.select(F.col("mark").alias("b"), F.col("record_id").alias("y"))
    across = pairs.select("a", "b").join(left, "a").join(right, "b").select("x", "y")
    same = left.join(right, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    return across.union(same).select(F.least("x", "y").alias("record_a"), F.greatest("x", "y").alias("record_b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(mark, class): connected components of (a, b), by alternating large and small stars; only pairs are shuffled."""
    edges = stage(pairs.select("a", "b").where("a <> b").distinct())
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        joined = low.join(least, "u")
        small = stage(joined.select(F.col("v").alias("x"), "m").union(joined.select("u", "m")).where("x <> m").distinct().toDF("a", "b"))
        same = small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        before = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        if same.exceptAll(before).limit(1).count() == 0 and before.exceptAll(same).limit(1).count() == 0:
            return same.select(F.col("b").alias("mark"), F.col("a").alias("class")).union(same.select("a", "a")).distinct()
        edges = small


def record_classes(records: DataFrame) -> DataFrame:
    """(record_id, class_id, n_links): one row per record; class_id is the smallest record id of its class.

    n_links counts the different texts that the record's text is similar to; copies are not written out as pairs.
    """
    members, pairs = similar_marks(records)
    links = pairs.select(F.col("a").alias("mark")).union(pairs.select("b")).groupBy("mark").agg(F.count("*").alias("n_links"))
    named = members.join(components(pairs), "mark", "left").withColumn("class", F.coalesce("class", "mark"))
    names = named.groupBy("class").agg(F.min("record_id").alias("class_id"))
    classed = named.join(names, "class").join(links, "mark", "left").select("record_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rest = records.select("record_id").where("record_id is not null").distinct().join(members, "record_id", "left_anti")
    return classed.union(rest.select("record_id", F.col("record_id").alias("class_id"), F.lit(0).cast("long")))
