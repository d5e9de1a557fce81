import random
import re

import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from brindle.llm import simhash as op
from brindle.llm.components import components
from tests.llm.common import EDGES, documents, empty, prose


def slow_print(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def roots(prints, radius):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints_and_components(spark):
    near = prose(3000, 7).split(" ")
    rows = [(d, t) for d, t in EDGES if d is not None] + [(200 + i, " ".join(near[: 2990 + i])) for i in range(8)]
    got = {}
    for r in op.near_groups(documents(spark, rows)).select("doc_id", op.fingerprint_hex().alias("f"), "component_id").collect():
        got.setdefault(r.doc_id, []).append((r.f, r.component_id))
    prints = [slow_print(t) for _, t in rows]
    found = roots(prints, 3)
    least = {k: min(rows[i][0] for i, x in enumerate(found) if x == k) for k in found}
    want = {}
    for (d, _), p, k in zip(rows, prints, found):
        want.setdefault(d, []).append((f"{p:016x}", least[k]))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}
    assert len({k for k in found}) < len({p for p in prints})  # some texts are near, not equal


@pytest.mark.parametrize("radius,blocks", [(3, 4), (2, 4), (1, 4), (3, 2)])
def test_links_against_all_pairs(spark, radius, blocks):
    r = random.Random(radius)
    prints = set()
    for _ in range(6):
        center = r.getrandbits(64)
        prints |= {center} | {center ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, 7))) for _ in range(25)}
    prints |= {0, 1, (1 << 64) - 1}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(e.a % (1 << 64), e.b % (1 << 64)) for e in op.link_edges(df, radius, blocks).collect()]
    assert all((a ^ b).bit_count() <= radius for a, b in edges)
    at = {p: i for i, p in enumerate(prints)}
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = sorted((root(at[a]), root(at[b])))
        up[y] = x
    assert [root(i) for i in range(len(prints))] == roots(prints, radius)


@given(st.lists(st.integers(0, 255), unique=True, min_size=2, max_size=60))
def test_bucket_links_connect_what_pairs_connect(members):
    at = {m: i for i, m in enumerate(members)}
    up = list(range(len(members)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in op.bucket_links(members, 1):
        assert (a ^ b).bit_count() <= 1
        x, y = sorted((root(at[a]), root(at[b])))
        up[y] = x
    assert [root(i) for i in range(len(members))] == roots(members, 1)


def test_components_of_paths_stars_and_cycles(spark):
    r = random.Random(0)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    r.shuffle(edges)
    edges = [(b, a) if r.random() < 0.5 else (a, b) for a, b in edges]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100: 100} | {101 + i: 100 for i in range(50)} | {200 + i: 200 for i in range(9)}
    assert got == want


def test_one_of_each_group_stays(spark):
    docs = documents(spark, EDGES)
    got = op.keep_one(docs)
    assert got.columns == docs.columns
    assert got.count() == len(set(roots([slow_print(t) for _, t in EDGES], 3)))
    assert {r.doc_id for r in got.collect()} == {r.component_id for r in op.near_groups(docs).collect()}


def test_empty(spark):
    assert op.near_groups(empty(spark)).collect() == []
    assert op.keep_one(empty(spark)).collect() == []
