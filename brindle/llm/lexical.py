"""Ranked search of texts by their words: three-phase uniform thresholds over postings that are partitioned by term.

Terms are dealt into PARTS parts. The postings of a part lie in blocks, one for each slice of some thousand documents, so that a term that all documents
have is spread over all slices. For a part, an item's list holds for each document what the part's terms add to its score. A document's score is
the sum of its places in the PARTS lists.

1. The heads: of each item's every list the k largest places. The documents found there are looked up in all lists; the k-th largest of their
   scores is a lower bound for the item.
2. The uniform threshold: a document that reaches the bound has at least one PARTS-th of it in some list. Every list sends all that reaches
   this. The sums of what was sent are lower bounds again, and with less than the threshold for each list that sent nothing they are upper bounds:
   documents whose upper bound falls short of the k-th largest lower bound are dropped.
3. The others are looked up in all lists for their exact scores.

Nothing is approximate; ties at a bound stay. Each phase reads the blocks where they lie; what moves are places that reach the threshold, not postings. Items
go through in passes of bounded text, whose terms and weights are broadcast; postings are kept of a pass's terms only.

Cases: a null text has no term, of an item as of a document. A document without an id counts and comes last among equal scores. Rows that repeat are documents,
or items, of their own. Very long texts are whole in one task. Items without terms and items that no document matches have no rows; so has an empty
table on either side. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.llm.work import BROADCAST_ROWS, materialize, slices

#: Results of an item.
K = 20
#: Parts of the terms: lists of an item.
PARTS = 4
#: Documents and postings of a slice, about.
SLICE_DOCS, SLICE_POSTINGS = 8192, 2_000_000
#: Items and their characters in a pass, about.
PASS_ITEMS, PASS_CHARS = 2000, 2_000_000

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

BLOCKS = "slice long, part int, ids array<long>, sizes array<long>, terms array<int>, starts array<int>, rows binary, counts binary"
_BLOCK_KINDS = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
_BLOCK_NAMES = ["slice", "part", "ids", "sizes", "terms", "starts", "rows", "counts"]
PLACES = "item int, part int, slice long, row int, sum long"
_PLACE_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall(text.translate(_LOWER)) if text else []


class _Slice:
    """Documents and postings that become the blocks of a slice."""

    def __init__(self, number: int):
        self.number = number
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.terms, self.rows, self.counts = array("i"), array("i"), array("q")

    def add(self, doc_id: int | None, text: str | None, known: dict[str, int]) -> None:
        words = terms_of(text)
        row = len(self.ids)
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        for term, n in Counter(words).items():
            if (number := known.get(term)) is not None:
                self.terms.append(number)
                self.rows.append(row)
                self.counts.append(n)

    def full(self) -> bool:
        return len(self.ids) >= SLICE_DOCS or len(self.terms) >= SLICE_POSTINGS

    def blocks(self) -> pa.RecordBatch:
        terms, rows, counts = np.frombuffer(self.terms, np.int32), np.frombuffer(self.rows, np.int32), np.frombuffer(self.counts, np.int64)
        order = np.argsort(terms, kind="stable")
        terms, rows, counts = terms[order], rows[order], counts[order]
        out = []
        for part in range(PARTS):
            own = np.flatnonzero(terms % PARTS == part)
            if part and not len(own):
                continue
            kept, starts = np.unique(terms[own], return_index=True)
            out.append((self.number, part, self.ids, self.sizes, kept, np.append(starts, len(own)).astype(np.int32), rows[own].tobytes(), counts[own].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _BLOCK_KINDS)], names=_BLOCK_NAMES)


def _indexer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, first = shared.value, TaskContext.get().partitionId() << 32
        own = _Slice(first)
        for batch in slices(batches, 256):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own.add(doc_id, text, known)
                if own.full():
                    yield own.blocks()
                    own = _Slice(own.number + 1)
        if own.ids:
            yield own.blocks()

    return run


def index(docs: DataFrame, terms: dict[str, int]) -> DataFrame:
    """The postings of ``terms`` in all documents, in blocks; a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(_indexer(shared), BLOCKS), "postings")


def _frequencies(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in slices(batches, 64):
            for terms, starts in zip(batch.column("terms"), batch.column("starts")):
                total[terms.values.to_numpy()] += np.diff(starts.values.to_numpy())
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], names=["term", "df"])

    return run


class Item:
    """An item's terms by part, each with its weight times its repeats."""

    def __init__(self, terms: Counter[int], weights: dict[int, int]):
        self.lists: list[list[tuple[int, int]]] = [[] for _ in range(PARTS)]
        for term, n in terms.items():
            if weight := n * weights.get(term, 0):
                self.lists[term % PARTS].append((term, weight))


class Block:
    """A part's postings in a slice, with the value of each."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.slice, self.part, self.ids = row["slice"], row["part"], row["ids"]
        bases = np.array([75 + 25 * n * n_docs // n_terms for n in row["sizes"]], np.int64)
        self.rows, counts = np.frombuffer(row["rows"], np.int32), np.frombuffer(row["counts"], np.int64)
        self.values = 1_000_000_000 * counts // (1000 * counts + 12 * bases[self.rows])
        self.spans = {t: (a, b) for t, a, b in zip(row["terms"], row["starts"], row["starts"][1:])}

    def sums(self, item: Item) -> np.ndarray | None:
        """What the part adds to the score of each document of the slice; None if nothing."""
        spans = [(self.spans[t], w) for t, w in item.lists[self.part] if t in self.spans]
        if not spans:
            return None
        out = np.zeros(len(self.ids), np.int64)
        for (a, b), weight in spans:
            out[self.rows[a:b]] += weight * self.values[a:b]
        return out


def _blocks(batches: Iterator[pa.RecordBatch], totals: tuple[int, int]) -> Iterator[tuple[Block, dict]]:
    for batch in slices(batches, 16):
        for row in batch.to_pylist():
            yield Block(row, *totals), row


def _places(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), k) for c, k in zip(columns, _PLACE_KINDS)]
    return pa.RecordBatch.from_arrays(arrays, names=["item", "part", "slice", "row", "sum"])


def _header(shared, k: int):
    """Of each list the k largest places of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, *totals = shared.value
        heads: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        nothing = np.zeros(0, np.int64)
        for block, _ in _blocks(batches, totals):
            for i, item in enumerate(items):
                if (sums := block.sums(item)) is None:
                    continue
                own, at, rows = heads.get((i, block.part), (nothing, nothing, nothing))
                found = np.flatnonzero(sums > (own.min() if len(own) == k else 0))
                if len(found):
                    own = np.concatenate((own, sums[found]))
                    at, rows = np.concatenate((at, np.full(len(found), block.slice))), np.concatenate((rows, found))
                    top = np.argpartition(own, -k)[-k:] if len(own) > k else slice(None)
                    heads[i, block.part] = own[top], at[top], rows[top]
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        for (i, part), (own, at, rows) in heads.items():
            for c, x in zip(columns, (np.full(len(own), i), np.full(len(own), part), at, rows, own)):
                c.append(x)
        yield _places(columns)

    return run


def _sender(shared, least: list[int]):
    """All places that reach the item's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, *totals = shared.value
        for block, _ in _blocks(batches, totals):
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            for i, item in enumerate(items):
                if (sums := block.sums(item)) is not None and len(found := np.flatnonzero(sums >= least[i])):
                    for c, x in zip(columns, (np.full(len(found), i), np.full(len(found), block.part), np.full(len(found), block.slice), found, sums[found])):
                        c.append(x)
            if columns[0]:
                yield _places(columns)

    return run


def _finder(shared):
    """The places of wanted documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, *totals = shared.value
        for block, row in _blocks(batches, totals):
            wanted: dict[int, list[int]] = {}
            for w in row["wanted"]:
                wanted.setdefault(w["item"], []).append(w["row"])
            columns: list[list] = [[] for _ in range(5)]
            for i, rows in wanted.items():
                if (sums := block.sums(items[i])) is not None:
                    for c, x in zip(columns, ([i] * len(rows), [block.slice] * len(rows), rows, sums[rows].tolist(), [block.ids[r] for r in rows])):
                        c += x
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item", "slice", "row", "sum", "doc_id"])

    return run


DOCUMENT = ("item", "slice", "row")


def look_up(blocks: DataFrame, wanted: DataFrame, shared) -> DataFrame:
    """(item, slice, row, score, doc_id): exact scores, from all lists, of the documents in ``wanted`` (item, slice, row), a written table."""
    by_slice = wanted.groupBy("slice").agg(F.collect_list(F.struct("item", "row")).alias("wanted"))
    side = F.broadcast(by_slice) if wanted.count() <= BROADCAST_ROWS else by_slice
    found = blocks.join(side, "slice").select(*_BLOCK_NAMES, "wanted").mapInArrow(_finder(shared), "item int, slice long, row int, sum long, doc_id long")
    return found.groupBy(*DOCUMENT).agg(F.sum("sum").alias("score"), F.max("doc_id").alias("doc_id"))


def _kth(sums: DataFrame, column: str, k: int, n_items: int) -> list[int]:
    """The k-th largest of a column for each item; 0 where there are fewer."""
    order = Window.partitionBy("item").orderBy(F.desc(column), "slice", "row")
    out = [0] * n_items
    for r in sums.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).where(F.col("at") == k).select("item", column).collect():
        out[r[0]] = r[1]
    return out


def _one_pass(docs: DataFrame, rows: list, k: int) -> tuple[DataFrame, dict[str, int]] | None:
    """Results of some items (item_id, text), and how many places each phase has handled."""
    spark = docs.sparkSession
    texts = [Counter(terms_of(r.text)) for r in rows]
    known: dict[str, int] = {}
    for t in texts:
        for term in t:
            known.setdefault(term, len(known))
    if not known:
        return None
    blocks = index(docs, known)
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    filled = F.size(F.filter("sizes", lambda x: x > 0))
    n_docs, n_terms = blocks.where(F.col("part") == 0).agg(F.coalesce(F.sum(filled), F.lit(0)), F.coalesce(F.sum(size), F.lit(0))).first()
    if not n_terms:
        return None
    counted = blocks.select("terms", "starts").mapInArrow(_frequencies(len(known)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weights = {r.term: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in counted.collect()}  # a row a term of the pass at most
    items = [Item(Counter({known[t]: n for t, n in own.items()}), weights) for own in texts]
    shared = spark.sparkContext.broadcast((items, n_docs, n_terms))

    order = Window.partitionBy("item", "part").orderBy(F.desc("sum"), "slice", "row")
    heads = blocks.mapInArrow(_header(shared, k), PLACES).withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    heads = materialize(heads.select(*DOCUMENT).distinct(), "heads", small=True)
    bounds = _kth(look_up(blocks, heads, shared), "score", k, len(items))

    least = [max(1, -(-b // PARTS)) for b in bounds]
    sent = blocks.mapInArrow(_sender(shared, least), PLACES).groupBy(*DOCUMENT).agg(F.sum("sum").alias("known"), F.count(F.lit(1)).alias("lists"))
    sent = materialize(sent, "sent", small=True)
    bounds = [max(a, b) for a, b in zip(bounds, _kth(sent, "known", k, len(items)))]
    limits = spark.createDataFrame([(i, t - 1, b) for i, (t, b) in enumerate(zip(least, bounds))], "item int, rest long, bound long")
    may = sent.join(F.broadcast(limits), "item").where(F.col("known") + (PARTS - F.col("lists")) * F.col("rest") >= F.col("bound"))
    may = materialize(may.select(*DOCUMENT), "candidates", small=True)

    last = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "slice", "row")
    ranked = look_up(blocks, may, shared).where(F.col("score") > 0).withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), {"heads": heads, "sent": sent, "candidates": may}


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the largest scores above 0 for each of ``items`` (item_id, text)."""
    spark: SparkSession = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n, chars = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    passes = max(-(-n // PASS_ITEMS), -(-chars // PASS_CHARS), 1)
    results = []
    for p in range(passes):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()
        if (done := _one_pass(docs, own, k)) is not None:
            results.append(done[0])
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
