"""Fill-in-the-middle against slicing of Python strings."""

import hashlib
import random
import re

import pytest

from brindle.llm import fim, queries
from tests.llm.common import EDGES, documents, empty
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


def slow_units(text, unit):
    if unit == "char":
        return list(text)
    if unit == "line":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    space, word = r"[ \t\n\v\f\r]", r"[^ \t\n\v\f\r]"
    return re.findall(rf"\A{space}*{word}*{space}*|{word}+{space}*", text) if text else []


def slow(doc_id, text, unit="char", rate=90, spm_rate=20):
    text = text or ""
    hexes = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[k : k + 8], 16) for k in (0, 8, 16, 24)]
    units = [u for u in slow_units(text, unit) if u]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_against_strings(spark, unit):
    r = random.Random(5)
    texts = ["".join(r.choice("aé日𝔘 \n\t<PSM>") for _ in range(r.randrange(60))) for _ in range(400)]
    rows = EDGES + [(100 + k, t) for k, t in enumerate(texts)] + [(900, "x<S"), (901, "<M<"), (902, "<P"), (903, "a <P> b"), (904, "\n\n"), (905, "  lead")]
    found = fim.restore(fim.transform(documents(spark, rows), unit=unit)).collect()
    want = [(d, *slow(d, t, unit), t or "") for d, t in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_select_finds_every_bit():
    r = random.Random(1)
    for width in (1, 2, 3, 64, 1000):
        bits = r.getrandbits(width) | 1 << (width - 1)
        places = [i for i in range(width) if bits >> i & 1]
        assert [fim.select(bits, width, k + 1) for k in range(len(places))] == places


def test_very_long_text(spark):
    text = "é日x " * 2_000_000
    found = fim.restore(fim.transform(documents(spark, [(1, text)]))).first()
    assert found.n == 8_000_000 and found.restored == text
    assert (found.form, found.prefix_units) == slow(1, text)[1:3]


def test_empty_table(spark):
    assert fim.restore(fim.transform(empty(spark))).collect() == []


def test_not_an_output():
    with pytest.raises(ValueError):
        fim.put_back("psm", b"<P>no suffix")


def test_query_matches_sql(spark):
    assert_same(queries.op13_fill_in_middle(spark, SF), connect(SF), queries.ORACLE_SQL["op13_fill_in_middle"])
