"""Exact search for the vectors with the largest inner products.

Vectors are numbered by descending length and searched in slabs of growing size, the longest first. What a query has found in earlier slabs is
its threshold in the next: the score and id of its k-th best. A slab whose longest vector times the query cannot reach it is not
searched, nor is any after it.

In a slab, all vectors are rotated onto the singular directions of the whole table, the strongest first, so that the first few
components hold most of a product. A pair's partial sum over them, and by Cauchy-Schwarz the product of the lengths of what is left, bound its score
from above. Pairs whose bound falls short are dropped, stage by stage; the scores of the others are exact integers.

The singular directions come from the second moments of all vectors, a matrix of width x width. Queries go through in passes of bounded
size; a pass is broadcast, and a task returns of its part of a slab at most k vectors a query, only those beyond the threshold. As each slab is
GROWTH times what was searched before, few pass it: some k * GROWTH a query, however many tasks there are. Copies of one vector tie; by the id in
the threshold all but the k smallest ids fall out. No vector is shuffled but in the one sort by length.

Cases: vectors that are null or hold a null, a NaN or an infinite component take no part, nor do rows without an id, which no result could
name. An empty vector has the score 0 with all others; of vectors of different lengths, missing components count as 0. Rows that
repeat are candidates of their own, and queries of their own (with equal results); no row is a candidate for a query of the same id. Ties go
to the smaller id. Components and scores beyond 64 bits count as the nearest number of 64 bits. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.llm.work import discard, materialize, numbered, slices

#: Results of a query.
K = 10
#: A component x counts as floor(SCALE * x).
SCALE = 1024
#: Vectors in the first slab, and how many times what was searched before a slab has.
FIRST, GROWTH = 4096, 16
#: Components of the queries of a pass in all.
PASS_CELLS = 4_000_000
#: Queries and vectors that are compared at a time; pairs whose components are gathered at a time.
SIDE, PAIRS = 1024, 32_768
#: Parts of the width after which a bound is taken.
STAGES = (0.25, 0.5)
#: Above this share of pairs that remain, all exact scores are computed at once.
DENSE = 0.1
#: Relative error that rotated sums may have; bounds are raised by it.
SLACK = 1e-9
#: Beyond this product of lengths, sums of doubles or of 64-bit integers may be wrong.
DOUBLE, LONG = 2.0**52, 2.0**62
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def valid(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows, dtype=np.float64))


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in slices(batches):
            rows = _matrix(batch.column("v"), width).astype(np.float64)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    return run


def directions(vectors: DataFrame, width: int) -> np.ndarray:
    """The singular directions of the table of ``v`` as columns, the strongest first."""
    parts = vectors.select("v").mapInArrow(_moments(width), "i int, sums array<double>")
    sums = parts.select("i", F.posexplode("sums").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    square = np.zeros((width, width))
    square[sums["i"], sums["j"]] = sums["x"]
    peak = np.abs(square).max(initial=0.0)
    if not width or not np.isfinite(peak) or peak == 0:
        return np.eye(width)
    _, own = np.linalg.eigh((square + square.T) / (2 * peak))
    return np.ascontiguousarray(own[:, ::-1])


class Queries:
    """The queries of a pass, with what each has found: exact rows, rotated rows, what is left of their lengths after each stage."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, rows: np.ndarray, basis: np.ndarray, k: int):
        self.keys, self.ids, self.rows, self.basis, self.k = keys, ids, rows, basis, k
        self.lengths = _lengths(rows)
        self.rotated = rows.astype(np.float64) @ basis
        width = rows.shape[1]
        self.edges = [*sorted({max(1, round(width * s)) for s in STAGES} - {width}), width] if width else []
        self.left = rests(self.rotated, self.edges)
        self.least = np.full(len(keys), LEAST, np.int64)
        self.last = np.full(len(keys), LEAST, np.int64)

    def reach(self, length: float) -> np.ndarray:
        """The queries that a vector of some length may serve."""
        return np.flatnonzero(self.lengths * length * (1 + SLACK) + 1 >= self.least)


def rests(rotated: np.ndarray, edges: list[int]) -> list[np.ndarray]:
    return [_lengths(rotated[:, e:]) for e in edges]


def exact(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Row by row the inner products, which are at most ``most``."""
    if most < LONG:
        return np.einsum("ij,ij->i", a, b)
    sums = (a.astype(object) * b.astype(object)).sum(axis=1)
    return np.array([min(max(x, LEAST), MOST) for x in sums], np.int64)


def survivors(own: Queries, a: np.ndarray, rows: np.ndarray, ids: np.ndarray, turned: np.ndarray, left: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the queries numbered ``a`` and some vectors, the pairs that may pass the threshold, and their exact scores."""
    other = own.ids[a][:, None] != ids
    most = float(own.lengths[a].max() * lengths.max())
    slack = SLACK * own.lengths[a][:, None] * lengths + 1
    if not own.edges:
        q, x = np.nonzero(other)
        return a[q], x, np.zeros(len(q), np.int64)
    first = own.edges[0]
    sums = own.rotated[a, :first] @ turned[:, :first].T
    may = (sums + own.left[0][a][:, None] * left[0] + slack >= own.least[a][:, None]) & other
    if may.mean() > DENSE and most < DOUBLE:
        full = np.rint(own.rows[a].astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
        full[~other] = LEAST
        if (rest := full.shape[1] - own.k) > 0:  # what is below the k best of these vectors is not among the k best of all
            may &= full >= np.partition(full, rest, axis=1)[:, rest, None]
        q, x = np.nonzero(may & (full >= own.least[a][:, None]))
        return a[q], x, full[q, x]
    q, x = np.nonzero(may)
    found = []
    for at in range(0, len(q), PAIRS):
        qs, xs = q[at : at + PAIRS], x[at : at + PAIRS]
        part = sums[qs, xs]
        for s in range(1, len(own.edges) - 1):
            low, high = own.edges[s - 1], own.edges[s]
            part = part + np.einsum("ij,ij->i", own.rotated[a[qs], low:high], turned[xs, low:high])
            stay = part + own.left[s][a[qs]] * left[s][xs] + slack[qs, xs] >= own.least[a[qs]]
            qs, xs, part = qs[stay], xs[stay], part[stay]
        found.append((a[qs], xs, exact(own.rows[a[qs]], rows[xs], most)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


class Best:
    """The k best of each query beyond its threshold, in one task."""

    def __init__(self, own: Queries):
        self.own = own
        self.q, self.scores, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        own = self.own
        take = (scores > own.least[q]) | ((scores == own.least[q]) & ((ids < own.last[q]) | (own.last[q] == LEAST)))
        if not take.any():
            return
        q, scores, ids = (np.concatenate(x) for x in ((self.q, q[take]), (self.scores, scores[take]), (self.ids, ids[take])))
        order = np.lexsort((ids, ~scores, q))
        q, scores, ids = q[order], scores[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        stay = place < own.k
        self.q, self.scores, self.ids, place = q[stay], scores[stay], ids[stay], place[stay]
        last = place == own.k - 1
        at = self.q[last]
        tighter = (self.scores[last] > own.least[at]) | ((self.scores[last] == own.least[at]) & (self.ids[last] < own.last[at])) | (own.last[at] == LEAST)
        own.least[at[tighter]] = self.scores[last][tighter]
        own.last[at[tighter]] = self.ids[last][tighter]


def search(own: Queries, best: Best, rows: np.ndarray, ids: np.ndarray) -> None:
    """Compare some vectors with all queries that they may serve."""
    lengths = _lengths(rows)
    active = own.reach(float(lengths.max()))
    turned = rows.astype(np.float64) @ own.basis
    left = rests(turned, own.edges)
    for at in range(0, len(active), SIDE):
        q, x, scores = survivors(own, active[at : at + SIDE], rows, ids, turned, left, lengths)
        best.add(q, scores, ids[x])


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, query_ids, query_rows, basis, k, least, last = shared.value
        own = Queries(keys, query_ids, query_rows, basis, k)
        own.least, own.last = least.copy(), last.copy()
        best = Best(own)
        for batch in slices(batches, SIDE):
            if batch.num_rows:
                search(own, best, _matrix(batch.column("v"), basis.shape[0]), batch.column("id").to_numpy())
        columns = [pa.array(x) for x in (keys[best.q], own.ids[best.q], best.scores, best.ids)]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "query_id", "score", "vec_id"])

    return run


FOUND = "q long, query_id long, score long, vec_id long"


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _one_pass(spark: SparkSession, vectors: DataFrame, asked: DataFrame, basis: np.ndarray, slabs: list[tuple], k: int) -> DataFrame | None:
    """The results of the queries of a pass."""
    table = asked.select("number", "id", "v").toArrow().combine_chunks()
    if not table.num_rows:
        return None
    keys, ids = (table.column(c).to_numpy() for c in ("number", "id"))
    own = Queries(keys, ids, _matrix(table.column("v").chunk(0), basis.shape[0]), basis, k)
    place = {key: i for i, key in enumerate(keys.tolist())}
    best = None
    for low, high, longest, shortest in slabs:
        if not len(own.reach(longest)):
            break
        shared = spark.sparkContext.broadcast((keys, ids, own.rows, basis, k, own.least, own.last))
        slab = vectors.where((F.col("length") <= longest) & (F.col("length") >= shortest) & (F.col("number") >= low) & (F.col("number") < high))
        found = slab.select("id", "v").mapInArrow(_searcher(shared), FOUND)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        before, best = best, materialize(_first(found, k), "best")
        shared.destroy()
        if before is not None:
            discard(before)
        for q, score, last in best.where(F.col("rank") == k).select("q", "score", "vec_id").collect():  # a row a query of the pass at most
            own.least[place[q]], own.last[place[q]] = score, last
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` selects, the ``k`` other rows with the largest inner products
    of integer components."""
    spark = vectors.sparkSession
    took = vectors.where(valid(F.col(vector_column)) & F.col(id_column).isNotNull())
    rows = took.select(F.col(id_column).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), integers(F.col(vector_column), scale).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    ordered, n = numbered(rows.withColumn("length", length).withColumn("shorter", -length), ["shorter", "id"], "vectors")
    ordered = ordered.drop("shorter")
    edges = [0]
    while edges[-1] < n:
        edges.append(min(n, FIRST if len(edges) == 1 else edges[-1] * (1 + GROWTH)))
    at = {x for e in edges for x in (e - 1, e)}
    lengths = {r.number: r.length for r in ordered.where(F.col("number").isin(sorted(at))).select("number", "length").collect()}
    slabs = [(a, b, lengths[a], lengths[b - 1]) for a, b in zip(edges, edges[1:])]
    width, n_asked = ordered.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if("asks")).first()
    basis = directions(ordered, width)
    passes = -(-n_asked * max(width, 1) // PASS_CELLS)
    results = []
    for p in range(passes):
        asked = ordered.where(F.col("asks") & (F.pmod(F.xxhash64("number"), F.lit(passes)) == p))
        if (best := _one_pass(spark, ordered, asked, basis, slabs, k)) is not None:
            results.append(best)
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for best in results[1:]:
        out = out.unionByName(best)
    return out.select("query_id", "rank", "vec_id", "score")
