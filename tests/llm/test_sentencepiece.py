import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece

from brindle.llm import sentencepiece_stream as op
from brindle.llm import trie_counts
from tests.llm.common import EDGES, documents, empty, prose

PATH = op.default_path()
PARTS = [" ", " ", "  ", "the", "ing", "a", "B", "é", "'s", "1", "2.", ",", "\n", "\t", "　", "́", "世", "x", "!?", "\r\n", "\x85", "ß", "   ", "ere", "on", "𝔘"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n):
    r = random.Random(n)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(24))) for _ in range(n)] + [" " * k for k in range(1, 50)] + [prose(500)]


def test_ids_and_texts_are_the_library_s(library):
    own, some = op.Codec(PATH), texts(6000)
    ids = own.encode_texts(some)
    assert [x.tolist() for x in ids] == library.encode(some)
    assert [own.decode(x) for x in ids] == some


def test_stream_commits_early_and_exactly(library):
    pieces, long = op._pieces(PATH), prose(3000, 4) + "supercalifragilistic" * 50
    search, early = op.StreamingViterbi(pieces), []
    for c in op.SPACE + long.replace(" ", op.SPACE):
        early += search.feed(c)
        assert len(search.starts) <= 4 * pieces.longest
    assert len(early) > 1000 and early + search.finish() == library.encode(long)


def test_all_ids_come_from_commits(library, monkeypatch):
    """The ids that a codec returns for texts of which no cut repeats are those that the streaming search has committed, in order."""
    committed = []
    commit = op.StreamingViterbi._commit

    def counted(self, boundary, done):
        before = len(done)
        commit(self, boundary, done)
        committed.extend(done[before:])

    monkeypatch.setattr(op.StreamingViterbi, "_commit", counted)
    newline = op._pieces(PATH).byte_ids[10]  # also ends cuts that nothing else ends
    seen = 0
    for text in [*texts(1000), "x" * 3000, " ".join(f"w{k}" for k in range(500))]:
        cuts = op._pieces(PATH).pattern.findall(op.SPACE + text.replace(" ", op.SPACE))
        if len(set(cuts)) < len(cuts):
            continue
        committed.clear()
        ids = op.Codec(PATH).encode_texts([text])[0].tolist()
        assert ids == library.encode(text)
        assert [i for i in committed if i != newline] == [i for i in ids if i != newline]
        seen += len(ids)
    assert seen > 3000


def test_search_is_independent_of_how_it_is_fed(library):
    r = random.Random(3)
    for text in texts(300):
        spaced = op.SPACE + text.replace(" ", op.SPACE) if text else ""
        search, got, at = op.StreamingViterbi(op._pieces(PATH)), [], 0
        while at < len(spaced):
            to = at + r.randrange(1, 5)
            got += search.feed(spaced[at:to])
            at = to
        assert got + search.finish() == library.encode(text)


def test_a_window_bounds_memory(library):
    """Some megabytes without a space: the search's memory does not grow with them."""
    r = random.Random(8)
    word = "".join(r.choice(["the", "ing", "a", "x", "é", "on", "qu"]) for _ in range(5000))
    search, n = op.StreamingViterbi(op._pieces(PATH)), 0
    search.feed(op.SPACE)
    tracemalloc.start()
    for k in range(150):
        n += len(search.feed(word))
        search.commits.clear()
        if k == 20:
            tracemalloc.reset_peak()
            before, _ = tracemalloc.get_traced_memory()
        assert len(search.starts) <= 4 * search.pieces.longest
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - before < 3_000_000
    assert n + len(search.finish()) == len(library.encode(word * 150))


def test_long_texts_are_taken_in_segments(library, monkeypatch):
    from brindle.llm import bpe_ids

    some = [*texts(200), prose(2000), "x" * 900, ""]
    monkeypatch.setattr(bpe_ids, "RUN", 40)
    monkeypatch.setattr(op, "LONG", 5)
    monkeypatch.setattr(op, "FEED", 7)
    assert [x.tolist() for x in op.Codec(PATH).encode_texts(some)] == library.encode(some)


def slow(pieces, text):
    """Best unigram score of a text and the fewest tokens with it, by plain dynamic programming."""
    best = [(0.0, 0)] + [None] * len(text)
    for e in range(1, len(text) + 1):
        for b in range(max(0, e - pieces.longest), e):
            if (i := pieces.ids.get(text[b:e])) is not None:
                x = best[b][0] + pieces.scores[i], best[b][1] - 1
            elif b == e - 1:
                x = best[b][0] + pieces.unknown_score, best[b][1] - len(text[b].encode())
            else:
                continue
            best[e] = max(best[e] or x, x)
    return best[-1][0], -best[-1][1]


def test_unigram_paths_and_counts():
    pieces, some = op._pieces(PATH), texts(800)
    spaced = [op.SPACE + t.replace(" ", op.SPACE) if t else "" for t in some]
    want = [slow(pieces, t) for t in spaced]
    assert trie_counts.TrieCounter(pieces).count(some).tolist() == [n for _, n in want]
    for t, ids, (score, _) in zip(spaced, op.Codec(PATH, "unigram").encode_texts(some), want):
        if all(c in pieces.ids for c in t):
            assert sum(pieces.scores[i] for i in ids.tolist()) == score


def test_each_prefix_has_one_forward_step(monkeypatch):
    """Over batches, a forward score is computed once for each distinct prefix of the pre-tokens."""
    pieces, some = op._pieces(PATH), texts(900)
    own = trie_counts.TrieCounter(pieces)
    got = np.concatenate([own.count(some[k : k + 100]) for k in range(0, len(some), 100)])
    cuts = {c for t in some for c in op._pieces(PATH).pattern.findall(op.SPACE + t.replace(" ", op.SPACE) if t else "")}
    assert own.steps == len({c[:k] for c in cuts for k in range(1, len(c) + 1)})
    monkeypatch.setattr(trie_counts, "NODES", 50)
    monkeypatch.setattr(trie_counts, "LONG", 9)
    assert (trie_counts.TrieCounter(pieces).count(some) == got).all()


def test_one_pre_token_without_end():
    pieces, text = op._pieces(PATH), "theingx" * 30000
    assert slow(pieces, op.SPACE + text[:2100])[1] == trie_counts.TrieCounter(pieces).count([text[:2100]])[0]
    tracemalloc.start()
    assert trie_counts.TrieCounter(pieces).count([text])[0] > 30000
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 20_000_000


def test_tables(spark, library):
    docs = documents(spark, EDGES)
    got = op.digest(docs, PATH).collect()
    assert sorted(str((r.doc_id, r.n_ids)) for r in got) == sorted(str((d, len(library.encode(t or "")))) for d, t in EDGES)
    assert all(r.round_trip for r in got)
    back = op.decode(op.encode(docs, PATH), PATH).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((d, t or "")) for d, t in EDGES)
    counts = trie_counts.token_counts(docs, PATH).collect()
    assert sorted(d or 0 for d, _ in counts) == sorted(d or 0 for d, _ in EDGES)
    assert all(n == 0 for d, n in counts if d == 2)


def test_memo_limits_change_nothing(monkeypatch, library):
    monkeypatch.setattr(op.Codec, "entries", 2)
    monkeypatch.setattr(op.Codec, "kept", 1)
    own = op.Codec(PATH)
    assert [own.encode_texts([t])[0].tolist() for t in ("one two", "two three", "one")] == library.encode(["one two", "two three", "one"])
    assert own.decode(np.array([], dtype=np.uint16)) == ""


def test_empty(spark):
    assert op.digest(empty(spark), PATH).collect() == trie_counts.token_counts(empty(spark), PATH).collect() == []
