import random
import time

import pytest

from brindle.llm import line_lcs as op


def length(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


# Links; rows of bits; rows of bits with few at once, so that lists are halved.
@pytest.mark.parametrize("pairs,table", [(4, 1 << 25), (0, 1 << 25), (0, 6)])
def test_against_brute_force(monkeypatch, pairs, table):
    monkeypatch.setattr(op, "PAIRS", pairs)
    monkeypatch.setattr(op, "TABLE", table)
    r = random.Random(0)
    for _ in range(2000):
        letters = "abcd"[: r.randrange(1, 5)]
        a, b = ([r.choice(letters) for _ in range(r.randrange(14))] for _ in "xy")
        got, rest = op.shared(a, b), iter(b)
        assert len(got) == length(a, b) and all(a[i] in rest for i in sorted(got))


def test_long_lists_with_few_kinds_of_items():
    r = random.Random(1)
    a, b = ([r.choice("xyz") for _ in range(20000)] for _ in "ab")
    began = time.process_time()
    assert len(op.shared(a, b)) > 14000 and len(op.shared(["x"] * 20000 + ["a"], ["b"] + ["x"] * 20000)) == 20000
    assert time.process_time() - began < 5
