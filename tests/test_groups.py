"""Operators over the words of a page take them as plain rows in batches: no page list, no join of a page with itself."""

import random
from collections import Counter

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from faultlake.operators import dtc_index as I
from faultlake.operators import tables as X
from faultlake.session import map_groups
from oracle import DATA
from test_folds import WORDS, plain_rebuild, words

QUERIES = entry.queries()


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_groups_in_any_batches(spark, small_batches):
    sizes = [1, 6, 7, 8, 14, 40, 1, 3]
    data = [(None if g == 3 else f"g{g}", k) for g, n in enumerate(sizes) for k in range(n)]
    random.Random(4).shuffle(data)

    def run(rows, n):
        keys, at = rows["g"].to_pylist(), 0
        for size in n:
            assert len(set(keys[at:at + size])) == 1
            at += size
        return pa.table({"g": [k for k, _ in Counter(keys).items()], "n": pa.array(n, pa.int64()), "total": [sum(v for g, v in zip(keys, rows["v"].to_pylist(), strict=True) if g == k) for k in Counter(keys)]})

    for parts in (1, 3):
        df = spark.createDataFrame(data, "g string, v long").repartition(parts)
        got = [tuple(r) for r in map_groups(df, "g", run, "g string, n long, total long").collect()]
        assert sorted(got, key=repr) == sorted([(None if g == 3 else f"g{g}", n, sum(range(n))) for g, n in enumerate(sizes)], key=repr)
    assert map_groups(df.where("false"), "g", run, "g string, n long, total long").count() == 0


def test_words_right(spark, small_batches):
    rng = random.Random(6)
    some = lambda v: None if rng.random() < 0.05 else v
    # ords repeat, boxes may be turned round, heights lie exactly on the band
    data = [(some(p), some(rng.randint(0, 20)), some(x := float(rng.randint(0, 60))), some(rng.choice([0.0, 1.0, 3.0, 2.5, 5.5, 40.0])), some(x + rng.randint(-2, 20))) for p in range(12) for _ in range(rng.randint(1, 40))]
    want = Counter((a[0], a[1]) for a in data for b in data if None not in (a[0], a[3], a[4], b[3], b[2]) and a[0] == b[0] and abs(b[3] - a[3]) < 3 and b[2] > a[4])
    got = I.words_right(spark.createDataFrame(data, "page_id int, ord long, x0 double, y0 double, x1 double")).collect()
    assert {(r.page_id, r.ord): r.n for r in got} == want and len(got) == len(want) > 100


def test_row_words_join_nothing(spark):
    text = plan(QUERIES["jn20_row_words"](spark, DATA))
    assert "Join" not in text and "Broadcast" not in text


def test_rebuild_takes_words_not_pages(spark, small_batches):
    data = words(random.Random(8), pages=10, n=50)
    got = {}
    for r in X.rebuild(spark.createDataFrame(data, WORDS).repartition(3), "g").orderBy("g", "row_no").collect():
        got.setdefault(r.g, []).append(r.cells)
    assert got == {g: t for g in range(10) if (t := plain_rebuild([w for w in data if w[0] == g]))} and got
    assert "collect_list" not in plan(QUERIES["fn29_rebuilt_tables"](spark, DATA))
