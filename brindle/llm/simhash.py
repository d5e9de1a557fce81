"""Near-duplicates by SimHash fingerprints and meet-in-the-middle ball hashing.

Two fingerprints at a distance of at most ``radius`` have a midpoint within half the radius of both. Every
distinct fingerprint therefore emits all variants within half the radius; equal variants meet in the shuffle;
each meeting is verified on the fingerprints themselves. Half of an odd radius counts a flipped bit as one
and an erased block of bits as one half: of any differing bits at least one lies in some erased block,
and flips share out the others. With radius 3 and four blocks of 16 bits a fingerprint has
4 * (1 + 48) = 196 variants, and two unrelated fingerprints share one with a chance of 2401 in 2**48.

Copies collapse first, so a bucket (one variant) holds distinct fingerprints only: at most
49 * 2**16 of them whatever the corpus, and its links are found without visiting all pairs. Buckets return links
that connect the same fingerprints as all pairs would.

Cases: a null text counts as empty; texts without words have fingerprint zero and link like any other. A text
of fewer words than a shingle is one shingle. A very long text is held by one task with its words and hashes. Rows that repeat a doc_id are rows of their own; null doc_ids
never name a component unless all of its are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.components import components
from brindle.llm.work import keep_rows, materialize, slices

BITS = 64
RADIUS = 3
#: Words of a shingle.
WORDS = 3
SEED = 42
#: Blocks that take turns being erased when the radius is odd.
BLOCKS = 4
#: Hashes whose bits are counted at once.
HASHES = 1 << 15


def text_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of the ASCII-lower-cased text. bytes.split() parts at exactly the six ASCII spaces."""
    import xxhash

    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([digest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[: len(tokens) - words] + 1).tolist()]
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())), dtype=np.uint64, count=len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), HASHES):
        part = hashes[at : at + HASHES].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _printer(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([fingerprint(text_hashes(t, words)) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            keys = [batch.column(c) for c in ("rid", "doc_id", "tag")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(prints.view(np.int64))], names=["rid", "doc_id", "tag", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(rid, doc_id, tag, fp): the 64 bits as a signed long, a row per document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text")
    )
    return rows.mapInArrow(_printer(words), "rid long, doc_id long, tag long, fp long")


def variants(radius: int = RADIUS, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """(keep, flip): a variant of fingerprint x is (x & keep) ^ flip. An erased block holds its number instead."""
    if radius % 2 == 0:
        erased = [(0, 0)]
    else:
        width = BITS // blocks
        erased = [(((1 << width) - 1) << (b * width), (b + 1) << (b * width)) for b in range(blocks)]
    out = []
    for gone, tag in erased:
        bits = [i for i in range(BITS) if not gone >> i & 1]
        for n in range(radius // 2 + 1):
            out += [(~gone & (1 << BITS) - 1, tag | sum(1 << i for i in c)) for c in combinations(bits, n)]
    return out


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def emit(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(key, fp): all variants of each distinct fingerprint of ``prints``."""
    table = F.array(*(F.struct(F.lit(_signed(k)).alias("keep"), F.lit(_signed(f)).alias("flip")) for k, f in variants(radius, blocks)))
    exploded = prints.select("fp", F.explode(table).alias("x"))
    return exploded.select(F.col("fp").bitwiseAND(F.col("x.keep")).bitwiseXOR(F.col("x.flip")).alias("key"), "fp")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


class Forest:
    """Union-find over fingerprints: of the links that a task verifies it keeps those that connect something new. It holds an entry for
    each linked fingerprint that a task meets, some 200 bytes, so tasks must be as many as the corpus asks for."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def bucket_links(members: list[int], radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Links (distance at most ``radius``) that connect the members of one bucket as all their links would.

    A breadth-first search: the members not yet reached are compared with the current one at once and leave
    when reached, so that a member is reached once and each component is spanned."""
    left = np.array(members, dtype=np.uint64)
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = _distances(left, np.uint64(x)) <= radius
            if near.any():
                reached = left[near].tolist()
                yield from ((x, y) for y in reached)
                queue += reached
                left = left[~near]


def _meeter(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a bucket may span batches."""
        forest = Forest()
        carry_key, carry = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        links: list[tuple[int, int]] = []

        def find(keys: np.ndarray, prints: np.ndarray) -> None:
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            two = starts[sizes == 2]
            a, b = prints[two], prints[two + 1]
            good = _distances(a, b) <= radius
            links.extend((x, y) for x, y in zip(a[good].tolist(), b[good].tolist()) if forest.link(x, y))
            for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                links.extend((x, y) for x, y in bucket_links(prints[at : at + n].tolist(), radius) if forest.link(x, y))

        def flush() -> pa.RecordBatch:
            out = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([carry_key, batch.column("key").to_numpy()])
            prints = np.concatenate([carry, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                find(keys[:last], prints[:last])
            carry_key, carry = keys[last:], prints[last:]
            yield flush()
        if len(carry_key):
            find(carry_key, carry)
        yield flush()

    return run


def link_edges(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): verified links between distinct fingerprints; together they connect what all links connect."""
    spread = emit(prints, radius, blocks).repartition("key").sortWithinPartitions("key")
    return spread.mapInArrow(_meeter(radius), "a long, b long")


def near_groups(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, tag, fp, component_id, kept), a row per document: the smallest doc_id reachable over links, and
    whether the row is the one that stands for its component."""
    rows = materialize(fingerprints(docs, words), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    distinct = materialize(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct", small=True)
    edges = materialize(link_edges(distinct.select("fp"), radius, blocks), "links")
    roots = components(edges)
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy(F.col("root").alias("n_root")).agg(F.min("first").alias("head"))
    named = rooted.join(heads, F.col("root") == F.col("n_root")).select(F.col("fp").alias("n_fp"), "head")
    met = rows.join(named, F.col("fp") == F.col("n_fp"))
    return met.select("doc_id", "tag", "fp", F.col("head.doc_id").alias("component_id"), (F.col("rid") == F.col("head.rid")).alias("kept"))


def fingerprint_hex(fp="fp"):
    """The signed long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate groups, those with the smallest doc_id, with all their columns."""
    return keep_rows(docs, near_groups(docs))
