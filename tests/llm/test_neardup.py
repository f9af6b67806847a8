import random
import re

import numpy as np

from faultlake.llm import neardup as N


def runs(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[k:k + 3]) for k in range(len(w) - 2)}


def brute(rows):
    sets = {i: runs(t) for i, t in rows if t and runs(t)}
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}


def corpus(rng, n=150, copies=120):
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randint(30, 200))) for _ in range(n)]
    for _ in range(copies):
        w = rng.choice(texts).split()
        for _ in range(rng.randint(0, max(1, len(w) // 15))):
            k = rng.randrange(len(w))
            w[k:k + 1] = rng.choice([[], ["new", w[k]], [f"x{rng.randint(0, 999)}"]])
        texts.append(" ".join(w))
    return [(f"r{i:04d}", t) for i, t in enumerate(texts)]


def test_against_brute_force(spark):
    rows = corpus(random.Random(4))
    rows += [("e1", None), ("e2", ""), ("e3", "two words"), ("s1", "one two three"), ("s2", "One, two: three!"), ("long", "word " * 20000)]
    df = spark.createDataFrame(rows + rows[:20], "record_id string, text string").selectExpr("*", "1 as mark", "2 as a")
    got = {tuple(r) for r in N.similar_records(df).collect()}
    want = brute(rows)
    assert not got - want
    assert len(want - got) <= 0.01 * len(want) and len(want) > 80  # the chance of a miss at the threshold itself
    classes = {r.record_id: r for r in N.record_classes(df).collect()}
    assert len(classes) == len(rows) and classes["e1"].class_id == "e1" and classes["s1"].class_id == classes["s2"].class_id == "s1"
    for a, b in got:
        assert classes[a].class_id == classes[b].class_id


def test_hot_group_of_copies_and_edits(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(6)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for i in range(90):  # a third of all rows are edits or copies of one text, so blocks are cut into parts
        w = list(base)
        if i % 3:
            w[rng.randrange(80)] = f"e{i}"
        rows.append((f"h{i:03d}", " ".join(w)))
    rows += corpus(rng, n=120, copies=60)
    got = {tuple(r) for r in N.similar_records(spark.createDataFrame(rows, "record_id string, text string")).collect()}
    want = brute(rows)
    assert not got - want and len(want - got) <= 0.002 * len(want)


def test_tree_keeps_every_pair_the_bound_allows():
    rng = np.random.default_rng(1)
    points = rng.poisson(0.5, size=(300, N.GROUPS)).astype(np.uint16)
    points[150:] = points[:150]
    points[150:, :5] += 1
    sizes = points.sum(axis=1).astype(np.int64)
    got = {(int(a), int(b)) for x, y in N.RTree(points, sizes).pairs_with(N.RTree(points, sizes)) for a, b in zip(x, y, strict=True)}
    want = {(i, j) for i in range(300) for j in range(300) if np.minimum(points[i], points[j]).sum() >= N._needed(sizes[i], sizes[j])}
    assert got == want


def test_bound_never_rules_out_a_case():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(3, 3000)
        a = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * 0.7)], np.array([rng.getrandbits(64) for _ in range(n // 6)], dtype=np.uint64)]))
        _, _, counts = N._signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
        import pandas as pd

        p, q = N._points(pd.Series(N._packed(counts)))
        overlap = len(np.intersect1d(a, b))
        assert np.minimum(p, q).sum(dtype=np.int64) >= overlap


def test_nothing(spark):
    none = spark.createDataFrame([("a", None)], "record_id string, text string")
    assert N.similar_records(none).count() == 0 and N.record_classes(none).count() == 1


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    want = {x: find(x) for x in parent}
    got = {r["mark"]: r["class"] for r in N.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == want


def test_a_text_of_many_copies_is_one_member_of_its_blocks(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    edits = [" ".join([*base[:k], f"e{k}", *base[k + 1:]]) for k in range(5, 15)]
    texts = [" ".join(base), *edits, *(t for _, t in corpus(rng, n=30, copies=0))]
    few = spark.createDataFrame([(f"r{i:03d}", t) for i, t in enumerate(texts)], "record_id string, text string")
    many = few.union(spark.range(30_000).selectExpr("concat('z', id) as record_id", f"'{texts[0]}' as text"))
    members, original = [], N.candidates
    monkeypatch.setattr(N, "candidates", lambda found: members.append(found.count()) or original(found))
    small = {r.record_id: r for r in N.record_classes(few).collect()}
    large = {r.record_id: r for r in N.record_classes(many).collect()}
    assert members == [len(texts)] * 2 and len(large) == len(texts) + 30_000
    assert {i: (large[i].class_id, large[i].n_links) for i in small} == {i: (r.class_id, r.n_links) for i, r in small.items()}
    assert large["z7"].class_id == "r000" and large["z7"].n_links == small["r000"].n_links
