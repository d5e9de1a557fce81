import hashlib
import time
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from brindle.llm import exact_dedup as op
from brindle.llm import queries
from tests.llm.common import EDGES, documents, empty
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@given(st.binary(max_size=9000), st.binary(max_size=9000))
def test_hashes_combine(a, b):
    powers = op.block_powers()
    whole = op.hash_bytes(a + b, powers)
    assert whole == op.combine(op.hash_bytes(a, powers), op.hash_bytes(b, powers), len(b))
    slow = tuple(sum(x * pow(base, len(a) + len(b) - 1 - i, p) for i, x in enumerate(a + b)) % p for p, base in op.MODULI)
    assert whole == slow


def test_many_hashes_equal_single_ones():
    powers = op.block_powers()
    texts = [b"", b"x", b"ab" * 2048, b"y" * 5000, bytes(4096), bytes(4097)]
    assert op.hash_many(texts, powers).tolist() == [list(op.hash_bytes(t, powers)) for t in texts]


def brute(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[t or ""].append((d is not None, d or 0, i))
    out = []
    for t, members in groups.items():
        top = max(members)[:2]
        keep = top[1] if top[0] else None
        for has, d, _ in members:
            out.append((d if has else None, keep, len(members), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(map(str, out))


# A tiny modulus makes most fingerprints equal, so that the comparison must tell the texts apart, round after round.
@pytest.mark.parametrize("moduli", [op.MODULI, ((3, 2), (2, 1))])
@pytest.mark.parametrize("huge,chunk", [(op.HUGE, op.CHUNK), (100, 64)])
def test_groups(spark, moduli, huge, chunk):
    rows = [(d, t) for d, t in EDGES] + [(100 + i, "ab"[i % 2] * 8) for i in range(6)]
    got = op.duplicate_groups(documents(spark, rows), moduli, huge, chunk).collect()
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == brute(rows)
    assert sum(r.kept for r in got) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_deduplicate_keeps_columns_and_one_of_whole_repeats(spark):
    df = documents(spark, EDGES)
    got = op.deduplicate(df)
    assert got.columns == df.columns
    assert sorted((t or "") for t, in got.select("text").collect()) == sorted({t or "" for _, t in EDGES})


def test_rows_that_repeat_cost_no_more_than_others(spark):
    """Some thousand equal rows, with one id and with none, and equal texts of different ids: no pairs of them are formed."""
    rows = [(7, "same row")] * 2000 + [(None, "boilerplate")] * 2000 + [(100 + i, "copies") for i in range(2000)]
    began = time.monotonic()
    got = op.duplicate_groups(documents(spark, rows))
    got = sorted((str(k), n, size, kept) for k, size, kept, n in got.groupBy("keep_id", "group_size", "kept").count().collect())
    assert got == sorted((k, n, 2000, kept) for k in ("2099", "7", "None") for n, kept in ((1999, False), (1, True)))
    assert time.monotonic() - began < 60


def test_empty(spark):
    assert op.duplicate_groups(empty(spark)).collect() == []
    assert op.deduplicate(empty(spark)).collect() == []


def test_query_matches_sql(spark):
    assert_same(queries.op1_exact_dedup(spark, SF), connect(SF), queries.ORACLE_SQL["op1_exact_dedup"])
    assert np.unique([r.keep_id for r in queries.op1_exact_dedup(spark, SF).where("kept").collect()]).size
