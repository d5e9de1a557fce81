import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from brindle.llm import bloom_lm as op
from brindle.llm import lookup
from tests.llm.common import EDGES, documents, empty, prose


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def brute(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for (d, t), h in zip(rows, held):
        w = tokens(t)
        out.append((d, h, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 4)))
    return sorted(map(str, out))


ROWS = EDGES + [(i, prose(150, i % 13)) for i in range(100, 160)]


@pytest.mark.parametrize("model_bytes,shard_text", [(None, op.SHARD_TEXT), (0, 20000)])
def test_base_score(spark, model_bytes, shard_text):
    got = op.score(documents(spark, ROWS), shard_text, model_bytes).collect()
    assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))) for r in got) == brute(ROWS)
    assert all(r.score < 0 for r in got)


def test_probing_shards_where_they_are_changes_no_score(spark, monkeypatch):
    monkeypatch.setattr(lookup, "RUN_CHARS", 5000)
    docs = documents(spark, ROWS)
    key = lambda r: (r.doc_id or -1, r.n_tokens, round(r.base_score, 6))
    a = sorted((*key(r), round(r.score, 9)) for r in op.score(docs, 20000).collect())
    b = sorted((*key(r), round(r.score, 9)) for r in op.score(docs, 20000, 0).collect())
    assert a == b


def exact_scores(texts, held):
    """The model's formula on exact counts, quantised one by one."""
    low = lambda c: max((j for j in range(100) if math.ceil(op.BASE**j - 1e-9) <= c), default=-1) + 1
    words, pairs = Counter(), Counter()
    for t, h in zip(texts, held):
        if not h:
            w = tokens(t)
            words.update(w)
            pairs.update(zip([0, *w], w))
    level = [{k: low(c) for k, c in of.items()} for of in (words, pairs)]
    mean = []
    for of, own in zip((words, pairs), level):
        bins = {}
        for k, c in of.items():
            bins.setdefault(own[k], []).append(c)
        mean.append({q: sum(c) / len(c) for q, c in bins.items()})
    z = sum(mean[0][q] for q in level[0].values()) + len(words) + 1
    once, twice = (sum(c == k for c in pairs.values()) for k in (1, 2))
    d = min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5
    low_b, high_b = 0.0, 1.0
    while high_b - low_b > 1e-15:
        b = (low_b + high_b) / 2
        types = sum(mean[0][q] ** b for q in level[0].values())
        low_b, high_b = (b, high_b) if types < len(pairs) else (low_b, b)
    n_train = held.count(False)
    start = mean[0].get(low(n_train)) or max((mean[0][q] for q in mean[0] if q < low(n_train)), default=0) if n_train else 0
    out = []
    for t in texts:
        total, before, w = 0.0, 0, tokens(t)
        for x in w:
            c = start if before == 0 else mean[0][level[0][before]] if before in level[0] else 0.0
            p = ((mean[0][level[0][x]] if x in level[0] else 0.0) + 1) / z
            both = min(mean[1][level[1][before, x]], c, mean[0][level[0][x]]) if (before, x) in level[1] and x in level[0] else 0.0
            total += math.log10((max(both - d, 0) + d * c**b * p) / c if c else p)
            before = x
        out.append(total)
    return out


@pytest.mark.parametrize("model_bytes", [None, 0])
def test_scores_of_the_whole_table_against_exact_counts(spark, model_bytes):
    """With so many bits that nothing is a false positive, the filter's scores are those of exact counts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in op.score(docs, model_bytes=model_bytes, false=1e-9, probes=30, load=0.02).collect()}
    texts = docs.orderBy("doc_id").collect()
    want = exact_scores([r.text for r in texts], [rows[r.doc_id].held_out for r in texts])
    assert len(rows) == len(texts)
    assert all(abs(rows[r.doc_id].score - w) <= 1e-9 * abs(w) for r, w in zip(texts, want))


def test_false_positives_move_scores_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in op.score(docs).collect()}
    texts = docs.orderBy("doc_id").collect()
    want = exact_scores([r.text for r in texts], [rows[r.doc_id].held_out for r in texts])
    off = [abs(rows[r.doc_id].score - w) / abs(w) for r, w in zip(texts, want) if rows[r.doc_id].n_tokens >= 100]
    assert len(off) > 100 and max(off) < 0.1 and sum(off) / len(off) < 0.01 and abs(sum(r.score for r in rows.values()) / sum(want) - 1) < 0.01


def test_filter_never_forgets_and_seldom_errs():
    r = np.random.default_rng(0)
    keys = r.integers(0, 1 << 63, 20000).astype(np.uint64)
    counts = np.maximum(1, r.geometric(0.3, len(keys)))
    q = op.quantise(counts)
    row = {"shard": 0, "first": op.PROBES, "more": op.PROBES, "filter": op.build_filter(keys, q)[0].tobytes(), "words": b"", "counts": b""}
    part = op.Slice([row], 2)
    for values in (part.blocks, part.first, part.more):
        values[:] = values[0]
    found = part.levels(keys, keys)
    assert (found >= q).all() and (found > q).mean() < 0.03
    assert (part.levels(r.integers(0, 1 << 63, 20000).astype(np.uint64), keys) > 0).mean() < 0.03


def test_words_have_equal_hashes_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(op, "PIECE", 64)
    op._tables.cache_clear()
    try:
        r = random.Random(3)
        texts = ["".join(r.choice("abAB é日\t\n\x0b\x1c") for _ in range(r.randrange(120))) for _ in range(300)] + ["", " ", "x" * 500 + " x", "Y" * 64, "word"]
        found, sizes = op.tokens_of(texts)
        want = [w for t in texts for w in tokens(t)]
        assert sizes.tolist() == [len(tokens(t)) for t in texts] and len(found) == len(want)
        by_word = {}
        for w, h in zip(want, found.tolist()):
            assert by_word.setdefault(w, h) == h
        assert len(set(by_word.values())) == len(by_word) > 500 and by_word[None] == op.END
    finally:
        op._tables.cache_clear()
    assert op.tokens_of([])[0].tolist() == []


def test_quantisation():
    counts = np.arange(1, 3000)
    q = op.quantise(counts)
    assert all(op.BASE ** (k - 1) <= c + 1e-6 and c < op.BASE**k + 1e-6 for c, k in zip(counts.tolist(), q.tolist()))


def chained(n, seed):
    """Words that mostly follow from the word before."""
    r, at, out = random.Random(seed), 0, []
    for _ in range(n):
        at = (3 * at + 1) % 40 if r.random() < 0.8 else r.randrange(40)
        out.append(f"w{at}")
    return " ".join(out)


def test_probabilities_sum_to_one_and_learn(spark):
    docs = documents(spark, [(i, chained(300, i)) for i in range(60)])
    shards, totals, bits = op.build(docs)
    part = op.Slice(shards.collect(), bits)
    p = [(totals.mean[0][q] + 1) / totals.z for q in part.levels(part.words, part.words)]
    # The filter never takes a count too small, and seldom too large.
    assert 1 - 1e-9 < sum(p) + 1 / totals.z < 1.01
    held = [r for r in op.score(docs).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_conditional_probabilities_sum_to_one_on_a_whole_table(spark):
    """Contexts drawn as often as they occur, and alike: the sums over all words of the table, and one unknown one."""
    shards, totals, bits = op.build(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    part = op.Slice(shards.collect(), bits)
    words, n = part.words, len(part.words)
    level = part.levels(words, words)
    r = np.random.default_rng(1)
    for weights in (part.counts / part.counts.sum(), None):
        sums = []
        for at in r.choice(n, 150, p=weights):
            pairs = np.stack([np.full(n, words[at]), words], axis=1).ravel()  # texts of two words, and the second one's place
            hashes = op.bigrams(pairs, np.full(n, 2))[1::2]
            found = np.stack([np.zeros(2 * n, np.int64), np.stack([np.full(n, level[at]), level], axis=1).ravel(), np.zeros(2 * n, np.int64)])
            found[2, 1::2] = part.levels(op.mix(hashes), hashes)
            first = (totals.mean[0][level[at]], totals.mean[0][totals.start_level])
            both = op._scores(found, np.full(n, 2), totals)[2]
            alone = op._scores(found[:, :1], np.array([1]), totals)[2][0]
            unknown = op._scores(np.array([[0, 0], [level[at], 0], [0, 0]]), np.array([2]), totals)[2][0] - alone
            assert min(first) > 0
            sums.append((10 ** (both - alone)).sum() + 10**unknown)
        assert abs(np.mean(sums) - 1) < 0.05 and max(sums) < 2


def test_held_out_documents_are_likelier_than_by_words_alone(spark):
    rows = [r for r in op.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() if r.held_out]
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.2


def test_empty(spark):
    assert op.score(empty(spark)).collect() == []
