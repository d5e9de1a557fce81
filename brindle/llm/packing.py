"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Documents longer than a sequence are cut into whole sequences with the shorter piece first. Whole pieces
fill a sequence each; the others are dealt by hash into partitions of bounded size and packed there by
best-fit decreasing. Dual feasible functions bound from below the number of bins that a partition's lengths
need. A partition whose bin count equals its bound is certified: no packing of its pieces has fewer bins. Partitions
with a gap keep their full bins and exchange the pieces of all others with each other: these are dealt anew
into fewer partitions and packed again, as long as that saves bins. Partly filled bins of certified
partitions join the exchange too, since bounds of single partitions say nothing about their union.

Cases: a null text counts as empty and yields one piece, its end id. Rows that repeat a doc_id, and null
doc_ids, are packed as documents of their own. Strings of added tokens in a text get those tokens' ids. A very long text is
encoded by one task and cut into many pieces. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import bpe_ids
from brindle.llm.token_files import END_ID
from brindle.llm.work import materialize, slices

#: Tokens of a sequence.
CAPACITY = 1024
#: Pieces packed together in one task, 28 bytes each.
PIECES = 100_000
#: Exchanges at most; each at least halves the number of partitions or ends.
MAX_ROUNDS = 16


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first may be shorter, the others are whole."""
    head = n % capacity
    return [(0, head)] * (head > 0) + [(at, capacity) for at in range(head, n, capacity)]


def _cutter(tokenizer: str, end_id: int, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe_ids.encoder(tokenizer)
        end = encoder.id_bytes(end_id)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            rid, doc_id = batch.column("rid").to_pylist(), batch.column("doc_id").to_pylist()
            for at in range(0, len(texts), 1024):
                rows: list[tuple] = []
                for k, e in enumerate(encoder.encode(texts[at : at + 1024]), at):
                    ids = np.frombuffer(e + end, dtype=encoder.dtype).astype("<u4")
                    for piece, (start, n) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + n].tobytes()
                        rows.append((rid[k], doc_id[k], piece, start, n, zlib.crc32(own), own if keep_ids else None))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["rid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = len(names) - (not keep_ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:n], kinds)], names=names[:n])
        encoder.trim()

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(rid, doc_id, piece, start, length, ids_crc32[, ids]): the pieces of each document, which ``rid`` tells apart."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    schema = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return rows.mapInArrow(_cutter(tokenizer, end_id, capacity, keep_ids), schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that ``counts[s]`` items of each size s need at least, by dual feasible functions.

    Two families: u(k), which rounds (k + 1) * s / capacity down unless it is whole, and the thresholds e that
    count items over capacity - e as whole bins and drop those under e. Of either, and of u(k) after
    a threshold, the largest total counts."""
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * size).sum()) // capacity)
    if not best:
        return 0
    heavy = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # items of at least this size
    mass = np.concatenate([[0], np.cumsum(counts * size)])  # size of items below
    for e in range(1, capacity // 2 + 1):
        total = int(heavy[capacity - e + 1]) * capacity + int(mass[capacity - e + 1] - mass[e])
        best = max(best, -(-total // capacity))
    for k in range(1, 101):
        scaled = (k + 1) * size
        u = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * u).sum()) // (k * capacity)))
        for e in range(capacity // (k + 2), capacity // 2 + 1, 7):
            v = np.where(size > capacity - e, k * capacity, np.where(size < e, 0, u))
            best = max(best, -(-int((counts * v).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each length, which must be sorted downwards, and the number of bins.

    Open bins lie on stacks by their free space; an integer's bits say which stacks hold any, so that the
    tightest fit is its lowest set bit at or above the length."""
    n = len(lengths)
    where, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = bins = 0
    for i, s in enumerate(lengths.tolist()):
        fits = mask >> s
        if fits:
            free = s + (fits & -fits).bit_length() - 1
            stack = open_bins[free]
            b = stack.pop()
            if not stack:
                mask ^= 1 << free
        else:
            free, b = capacity, bins
            bins += 1
        where[i], offset[i] = b, capacity - free
        left = free - s
        if left:
            open_bins[left].append(b)
            mask |= 1 << left
    return where, offset, bins


PACKED = "rid long, piece int, length long, part long, bin long, offset long, fill long, bins long, bound long"


def _packer(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        rid, piece, length = (table.column(c).to_numpy() for c in ("rid", "piece", "length"))
        order = np.lexsort((piece, rid, -length))
        rid, piece, length = rid[order], piece[order], length[order]
        where, offset, bins = best_fit_decreasing(length, capacity)
        bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        fill = np.bincount(where, weights=length, minlength=bins).astype(np.int64)[where]
        part = TaskContext.get().partitionId()
        for at in range(0, len(rid), 50_000):
            to = min(len(rid), at + 50_000)
            columns = [rid[at:to], piece[at:to], length[at:to], np.full(to - at, part), where[at:to], offset[at:to], fill[at:to], np.full(to - at, bins), np.full(to - at, bound)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in PACKED.split(", ")])

    return run


def _pack_once(rows: DataFrame, partitions: int, salt: int, capacity: int) -> DataFrame:
    """``rows`` (rid, piece, length) dealt into partitions and packed in each, as :data:`PACKED`."""
    dealt = rows.select("rid", "piece", "length").repartition(partitions, F.xxhash64("rid", "piece", F.lit(salt)))
    return materialize(dealt.mapInArrow(_packer(capacity), PACKED), f"packed{salt}")


def _bins(packed: DataFrame) -> tuple[int, int]:
    """Of a packing: its bins, and how many partitions' bin counts are not certified by their bounds."""
    parts = packed.groupBy("part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound"))
    bins, gaps = parts.agg(F.sum("bins"), F.count_if(F.col("bins") > F.col("bound"))).first()
    return int(bins or 0), int(gaps)


def pack(table: DataFrame, capacity: int = CAPACITY, pieces_a_task: int = PIECES, max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, dict]:
    """``table``, a written table of pieces, with ``sequence_id`` and ``offset``; and the certificate: the
    sequences used, the lower bound of any packing, the rounds of exchange, the partitions with gaps at the end.

    Sequence ids are even for whole pieces; odd, from round, partition and bin, for the others."""
    rest = table.where(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in rest.groupBy("length").count().collect():  # capacity - 1 rows at most
        counts[size] = n
    least, n = lower_bound(counts, capacity), int(counts.sum())
    partitions = max(1, -(-n // pieces_a_task))
    current = _pack_once(rest, partitions, 0, capacity)
    bins, gaps = _bins(current)
    total = bins
    done, salt = [], 0
    full = F.col("fill") == capacity
    while partitions > 1 and total > least and salt < max_rounds:
        loose = current.where(~full)
        salt += 1
        again = max(1, min(partitions, -(-loose.count() // pieces_a_task)))
        packed = _pack_once(loose, again, salt, capacity)
        before = bins - current.where(full & (F.col("offset") == 0)).count()
        now, now_gaps = _bins(packed)
        if now >= before:
            break
        done.append((salt - 1, current.where(full)))
        current, partitions, bins, gaps, total = packed, again, now, now_gaps, total - before + now
    done.append((salt, current))
    key = lambda r: ((F.lit(r).cast("long") * (1 << 20) + F.col("part")) * (1 << 32) + F.col("bin")) * 2 + 1
    placed = functools.reduce(
        DataFrame.unionByName,
        [x.select(F.col("rid").alias("p_rid"), F.col("piece").alias("p_piece"), key(r).alias("sequence_id"), "offset") for r, x in done],
    )
    met = (F.col("rid") == F.col("p_rid")) & (F.col("piece") == F.col("p_piece"))
    shorter = rest.join(placed, met).select(*table.columns, "sequence_id", "offset")
    whole = table.where(F.col("length") == capacity)
    whole = whole.select(*table.columns, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    n_whole = whole.count()
    return whole.unionByName(shorter), {"sequences": total + n_whole, "bound": least + n_whole, "rounds": salt, "gaps": gaps}
