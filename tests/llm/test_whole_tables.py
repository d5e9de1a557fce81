"""Registered queries over the whole small tables, every column against brute force or the libraries. Others have such tests beside
their own: op1 (SQL), op2, op3 and op7."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brindle.llm import bpe_ids, license_scan, license_texts, queries, sentencepiece_stream
from tests.llm import test_license_scan, test_sentencepiece, test_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    library = Tokenizer.from_file(bpe_ids.default_path())
    return {d: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for d, t in texts.items()}


def test_op4(spark, ids):
    want, start = [], 0
    for d in sorted(ids):
        want.append((d, start, len(ids[d]), zlib.crc32(ids[d].tobytes())))
        start += len(ids[d])
    got = queries.op4_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_op5(spark, texts):
    prints = {d: test_simhash.slow_print(t) for d, t in texts.items()}
    order = sorted(prints)
    roots = test_simhash.roots([prints[d] for d in order], 3)
    first = {}
    for d, root in zip(order, roots):
        first.setdefault(root, d)
    want = [(d, f"{prints[d]:016x}", first[root]) for d, root in zip(order, roots)]
    got = queries.op5_simhash_near_dedup(spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_op6(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_stream.default_path())
    got = {r.doc_id: r for r in queries.op6_sentencepiece(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        own = np.array(library.encode(t or ""), dtype="<u4")
        assert (got[d].n_ids, got[d].ids_crc32, got[d].round_trip) == (len(own), zlib.crc32(own.tobytes()), True)


def test_op8(spark):
    """Chains by comparing all places with all places, near runs of three words that some template has; elsewhere there are none."""
    templates = [(label, phrase) for phrase, label in license_texts.BASE_PHRASES] + license_texts.templates()
    plain = [test_license_scan.words(t.replace("{", " ").replace("}", " ")) for _, t in templates]
    threes = {tuple(w[k : k + 3]) for w in plain for k in range(len(w) - 2)}
    far = max(map(len, plain)) + license_scan.GAP
    found, sf = 0, "/root/testdata/sf0.01"  # few texts of the smaller table have a notice
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op8_license_scan(spark, sf).collect()}
    for d, t in texts.items():
        w = test_license_scan.words(t)
        at = [k for k in range(len(w) - 2) if tuple(w[k : k + 3]) in threes]
        parts = []
        for k in at:
            if parts and k <= parts[-1][1] + far:
                parts[-1][1] = k + 3
            else:
                parts.append([k, k + 3])
        labels, score = set(), 0.0
        for a, b in parts:
            more, best = test_license_scan.brute_chains(templates, w[a:b])
            labels, score = labels | more, max(score, min(1.0, best))
        base = test_license_scan.base(t)
        labels |= set(filter(None, base[4].split(",")))
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base
        assert (r.labels, round(r.score, 9)) == (",".join(sorted(labels)), round(score, 9))
        found += bool(labels)
    assert found > 20


def test_op9(spark, texts):
    pieces, known = sentencepiece_stream._pieces(sentencepiece_stream.default_path()), {}
    space = sentencepiece_stream.SPACE
    for r in queries.op9_trie_counts(spark, SF).collect():
        t = texts[r.doc_id]
        cuts = pieces.pattern.findall(space + t.replace(" ", space)) if t else []
        for c in cuts:
            if c not in known:
                known[c] = test_sentencepiece.slow(pieces, c)[1]
        assert r.n_tokens == sum(map(known.__getitem__, cuts))


def test_op10(spark, ids):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op10_best_fit_packing(spark, SF).collect():
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = {}
    for d, own in ids.items():
        head = len(own) % 1024
        cuts = [(0, head)] * (head > 0) + [(a, a + 1024) for a in range(head, len(own), 1024)]
        want[d] = [(k, a, b - a, zlib.crc32(own[a:b].tobytes())) for k, (a, b) in enumerate(cuts)]
    assert {d: sorted(x) for d, x in pieces.items()} == want
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= -(-sum(map(len, ids.values())) // 1024) * 1.05 + 1
