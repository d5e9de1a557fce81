"""Exact top-k search against all inner products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import queries, topk
from tests.oracle import assert_same, connect

SCHEMA = "vec_id long, embedding array<double>, label int, length int, number int, score int, id int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in rows], SCHEMA)


def whole(x):
    return min(max(int(np.floor(x * 1024)), topk.LEAST), topk.MOST) if abs(x * 1024) < 1e300 else (topk.MOST if x > 0 else topk.LEAST)


def slow(rows, asks, k):
    took = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in took:
        if asks(q):
            scores = [(-min(max(sum(x * y for x, y in zip(a, b)), topk.LEAST), topk.MOST), i) for i, b in took if i != q]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def run(spark, rows, every=5, k=4):
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % every == 0, k)
    assert sorted(map(tuple, found.collect())) == slow(rows, lambda q: q % every == 0, k)


@pytest.fixture
def small_slabs(monkeypatch):
    monkeypatch.setattr(topk, "FIRST", 16)
    monkeypatch.setattr(topk, "GROWTH", 2)


def test_slabs_passes_and_ties(spark, small_slabs, monkeypatch):
    monkeypatch.setattr(topk, "PASS_CELLS", 100)
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(size=8) * r.exponential()).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # copies of one vector
    rows += [(2000, [0.0] * 8), (2005, [0.0] * 8)]
    random.Random(2).shuffle(rows)
    run(spark, rows)


def test_odd_rows(spark, small_slabs):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).tolist()) for i in range(40)]
    rows += [(45, None), (50, [1.0, None, 2.0]), (55, [float("nan")]), (60, [float("inf"), 1.0]), (None, [1.0] * 6)]
    rows += [(65, []), (70, [2.0]), (71, [1.0] * 9), (10, rows[10][1]), (10, rows[10][1]), (80, [5.0] * 6), (80, [5.0] * 6)]
    run(spark, rows)


def test_a_query_with_many_rows_of_its_own_id(spark):
    run(spark, [(0, [1.0, 1.0])] * 30 + [(i, [0.1 * i, 0.0]) for i in range(1, 9)])


def test_sums_beyond_doubles_and_longs(spark, small_slabs):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=5) * 10.0 ** r.integers(0, 7)).tolist()) for i in range(60)]
    run(spark, rows)
    run(spark, rows + [(100, [1e15, -1e15, 3.0]), (101, [1e15]), (105, [1e200]), (106, [-1e200, 1.0])])


def test_few_and_no_rows(spark):
    run(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5])])
    run(spark, [(0, [1.0, 2.0])])
    run(spark, [])


def test_bounds_drop_most_pairs(spark):
    """Vectors near a few directions: of the pairs beyond the first slab, most never get an exact score."""
    r = np.random.default_rng(5)
    rows = (r.normal(size=(5000, 4)) @ r.normal(size=(4, 32)) * 100 + r.normal(size=(5000, 32))).astype(np.int64)
    rows = rows[np.argsort(-topk._lengths(rows))]
    _, basis = np.linalg.eigh(rows.T.astype(float) @ rows)
    own = topk.Queries(np.arange(50), np.arange(50) * 100, rows[::100], np.ascontiguousarray(basis[:, ::-1]), 10)
    best, scored = topk.Best(own), 0
    for at in range(0, 5000, 500):
        part, ids = rows[at : at + 500], np.arange(at, at + 500)
        turned = part @ own.basis
        a = own.reach(float(topk._lengths(part).max()))
        if len(a):
            q, x, scores = topk.survivors(own, a, part, ids, turned, topk.rests(turned, own.edges), topk._lengths(part))
            scored += len(q)
            best.add(q, scores, ids[x])
    assert scored < 0.1 * 50 * 5000
    full = rows[::100] @ rows.T
    full[np.arange(50), own.ids] = -(1 << 62)
    for q in range(50):
        want = sorted(zip(-full[q], range(5000)))[:10]
        assert [(-s, i) for s, i in zip(best.scores[best.q == q], best.ids[best.q == q])] == want


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert_same(queries.op11_exact_top_k(spark, sf), connect(sf), queries.ORACLE_SQL["op11_exact_top_k"])
