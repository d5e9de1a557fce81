import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brindle.llm import bpe_ids, queries
from brindle.llm import packing as op
from brindle.llm.work import materialize
from tests.llm.common import EDGES, documents, empty


def best(lengths, capacity):
    """Fewest bins, by trying all."""
    found = len(lengths)

    def place(i, bins):
        nonlocal found
        if len(bins) >= found:
            return
        if i == len(lengths):
            found = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1 :])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=0, max_size=9))
def test_bounds_and_packing(lengths):
    lengths = sorted(lengths, reverse=True)
    bound = op.lower_bound(np.bincount(np.array(lengths, dtype=int), minlength=13), 12)
    where, offset, bins = op.best_fit_decreasing(np.array(lengths, dtype=np.int64), 12)
    assert bound <= best(lengths, 12) <= bins
    for b in range(bins):
        own = sorted((o, n) for w, o, n in zip(where, offset, lengths) if w == b)
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 12


def test_bound_beats_the_sum():
    assert op.lower_bound(np.bincount([7] * 10, minlength=13), 12) == 10
    assert op.lower_bound(np.bincount([5] * 9, minlength=13), 12) == 5


@pytest.mark.parametrize("a_task", [op.PIECES, 40])
def test_packing_of_a_table(spark, a_task):
    r = random.Random(2)
    rows = [(i, i % 3, 0, r.choice([r.randrange(1, 100), 100]), 0) for i in range(400)]
    table = spark.createDataFrame([(i, p, s, n, c) for i, p, s, n, c in rows], "rid long, piece int, start long, length long, ids_crc32 long")
    packed, facts = op.pack(materialize(table, "t"), 100, a_task)
    got = packed.collect()
    assert sorted((x.rid, x.length) for x in got) == sorted((i, n) for i, _, _, n, _ in rows)
    bins = defaultdict(list)
    for x in got:
        bins[x.sequence_id].append((x.offset, x.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 100
    assert len(bins) == facts["sequences"] and facts["bound"] <= facts["sequences"] <= facts["bound"] * 1.05 + 2
    if a_task == 40:
        assert facts["rounds"] > 0


def test_pieces_of_documents(spark):
    t = Tokenizer.from_file(bpe_ids.default_path())
    got = defaultdict(list)
    for x in queries.packed_documents(documents(spark, EDGES)).collect():
        got[x.doc_id].append((x.piece, x.start, x.length, x.ids_crc32))
    want = defaultdict(list)
    for d, text in EDGES:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        head = len(ids) % 1024
        cuts = ([(0, head)] if head else []) + [(a, a + 1024) for a in range(head, len(ids), 1024)]
        want[d] += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(cuts)]
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}


def test_kept_ids(spark):
    rows = op.pieces(documents(spark, [(1, "a b c")]), bpe_ids.default_path(), keep_ids=True).collect()
    assert np.frombuffer(rows[0].ids, "<u4")[-1] == 2 and zlib.crc32(rows[0].ids) == rows[0].ids_crc32


def test_empty(spark):
    assert queries.packed_documents(empty(spark)).collect() == []
