"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brindle.llm import lexical, queries
from tests.llm.common import EDGES, documents, empty, prose
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", low)


def slow(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            n = sum(b.values())
            score = 0
            for t in terms(text):
                if b[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * (75 + 25 * n * n_docs // total)))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def asked(spark, items):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, score int, slice int")


def run(spark, docs, items, k=20, parts=1):
    found = lexical.search(documents(spark, docs).repartition(parts), asked(spark, items), k)
    assert sorted(map(tuple, found.collect()), key=repr) == slow(docs, items, k)


ITEMS = [(1, "alpha beta 3 Gamma"), (2, None), (3, ""), (4, "... --"), (5, "alpha alpha alpha eta"), (6, "nothing matches zzz"), (7, "日本語 É ß word"), (8, "no id same row"), (9, prose(80, 4))]


def test_edges(spark):
    run(spark, EDGES, ITEMS)
    run(spark, EDGES, ITEMS, k=2, parts=3)


def test_many_documents_in_slices_with_copies(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_DOCS", 50)
    r = random.Random(3)
    docs = [(i, prose(r.randrange(3, 60), i)) for i in range(700)] + [(1000 + i, prose(30, 5)) for i in range(300)]
    run(spark, docs, ITEMS, k=5, parts=4)


def test_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PASS_ITEMS", 2)
    run(spark, [(i, prose(20, i)) for i in range(60)], ITEMS, k=3)


def test_long_text_and_empty_tables(spark):
    run(spark, [(1, prose(400_000, 1)), (2, "alpha"), (3, "beta beta")], ITEMS)
    assert lexical.search(empty(spark), asked(spark, ITEMS)).collect() == []
    assert lexical.search(documents(spark, EDGES), asked(spark, ITEMS).where("item_id < 0")).collect() == []
    assert lexical.search(documents(spark, [(1, None), (2, "--")]), asked(spark, ITEMS)).collect() == []


def test_thresholds_spare_most_places(spark):
    """Far fewer places are sent, and far fewer documents looked up at the end, than match."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()
    _, phases = lexical._one_pass(docs, items, 20)
    own = [Counter(terms(t)) for (t,) in docs.select("text").collect()]
    matching = sum(any(t in b for t in set(terms(r.text))) for r in items for b in own)
    assert phases["candidates"].count() < matching / 4
    assert phases["sent"].agg(F.sum("lists")).first()[0] < matching


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    assert_same(queries.op12_tput_search(spark, sf), connect(sf), queries.ORACLE_SQL["op12_tput_search"])
