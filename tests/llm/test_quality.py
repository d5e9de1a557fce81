import math
import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest

from brindle.llm import quality as op
from tests.llm.common import EDGES, documents, empty, prose


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i for j, x in enumerate(windows) if n[x] > 1 for i in range(j, j + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


ROWS = EDGES + [
    (200, "a b c d e f a b c d e f a b c d e"), (201, "x x x x x x x x x x x x"), (202, "l one\nl one\n\n \nl one\nother"),
    (203, "# * $ % & | < > ## **"), (204, "a\x0bb\x0cc\x1cd e\x85f"),
]


def test_base_counts(spark):
    got = op.judge(documents(spark, [(i, t) for i, (_, t) in enumerate(ROWS)])).collect()
    for r in got:
        want = base(ROWS[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def corpus():
    rows = [(i, prose(200 + i, i), ("en", "de", None, "xx")[i % 4]) for i in range(400)]
    rows += [(1000 + i, re.sub(r"(\w+)", r"\1###$$$", prose(200, 900 + i)), "en") for i in range(8)]
    return rows


def test_bands_reject_symbol_texts_and_keep_clean_ones(spark):
    docs = documents(spark, corpus())
    kept = {r.doc_id for r in op.judge(docs).where("kept").collect()}
    assert not any(d >= 1000 for d in kept)
    assert len(kept) >= 396
    good = op.keep_good(docs)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept


def test_every_language_and_script_has_a_band(spark):
    cyrillic = {ord(a): chr(0x430 + i) for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")}
    rows = [(i, prose(200 + i % 50, i), "xx") for i in range(300)]
    rows += [(1000 + i, prose(200 + i, 500 + i).lower().translate(cyrillic), ("ru", None, "", "xx")[i % 4]) for i in range(120)]
    rows += [(2000 + i, prose(200 + i, 700 + i), "few") for i in range(3)] + [(3000, prose(200, 800), "one")]
    judged = op.judge(documents(spark, rows)).collect()
    assert sum(r.kept for r in judged if 1000 <= r.doc_id < 2000) >= 112
    assert all(r.kept for r in judged if r.doc_id >= 2000) and len(judged) == len(rows)
    assert {r.script for r in judged} == {"LATIN", "CYRILLIC"}


@pytest.mark.parametrize("first", [0x430, 0x4E00, 0x3041])
def test_gibberish_in_any_script_is_told_from_prose(spark, first):
    """Texts in scripts that were one class of characters once: the same characters in random order are rejected."""
    script = {ord(a): chr(first + i) for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")}
    rows = [(i, prose(300, i).lower().translate(script), "yy") for i in range(200)]
    for i in range(10):
        letters = list(rows[i][1])
        random.Random(i).shuffle(letters)
        rows.append((1000 + i, "".join(letters), "yy"))
    judged = op.judge(documents(spark, rows)).collect()
    assert sum(r.kept for r in judged if r.doc_id < 1000) >= 196
    assert not any(r.kept for r in judged if r.doc_id >= 1000)


class Slow:
    """The model by the textbook recursion, on strings."""

    def __init__(self, texts):
        fold = lambda t: re.sub("[0-9]", "0", t)
        self.counts = {4: Counter(x[i : i + 4] for t in texts for x in ["\n\n\n" + fold(t)] for i in range(len(t)))}
        for k in (3, 2, 1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.rows = {}, {}
        for k, c in self.counts.items():
            self.d[k] = op.discounts(*(sum(n == i for n in c.values()) for i in (1, 2, 3, 4)))
            rows = self.rows[k] = defaultdict(lambda: [0, 0.0])
            for g, n in c.items():
                rows[g[:-1]][0] += n
                rows[g[:-1]][1] += self.d[k][min(n, 3) - 1]
        self.known = {}

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(self.counts[1]) + 1)
        if gram not in self.known:
            total, cut = self.rows[k].get(gram[:-1], (0, 0.0))
            low = self.p(gram[1:])
            if total:
                n = self.counts[k].get(gram, 0)
                low = (n - (self.d[k][min(n, 3) - 1] if n else 0) + cut * low) / total
            self.known[gram] = low
        return self.known[gram]

    def total(self, text):
        x = "\n\n\n" + re.sub("[0-9]", "0", text)
        return -sum(math.log10(self.p(x[i : i + 4])) for i in range(len(text)))


def entries(spark, texts):
    shards, root, _ = op.build_model(documents(spark, list(enumerate(texts))))
    return op.Model(shards.collect(), root)


def test_recursion_of_the_model(spark):
    texts = [prose(3000, 5), "Other text. WITH caps\n12 | 34", "日本語のテキスト、日本", ""]
    model, slow = entries(spark, texts), Slow(texts)
    r = random.Random(2)
    some = ["".join(r.choice(x) for _ in range(4)) for x in ["abc e", "eth ", "日本語x", "\U0001F600q0"] for _ in range(300)]
    some += [t[i : i + 4] for t in texts for i in range(0, max(0, len(t) - 4), 7)]
    some = [re.sub("[0-9]", "0", x) for x in some]
    grams = op.Grams([(0, x[:3], x[3:]) for x in some])
    got = op.score_grams(grams.head, grams.rest, model.find, model.root)
    assert np.allclose(10**got, [slow.p(x) for x in some], rtol=1e-4)


def test_probabilities_sum_to_one(spark):
    texts = [prose(2000, 6), "Ünï 日本語"]
    model = entries(spark, texts)
    letters = sorted(set(re.sub("[0-9]", "0", "".join(texts))))
    for context in ("\n\n\n", "the", "eta", "語 x", "zqz"):
        grams = op.Grams([(0, context, c) for c in letters])
        left = 1 - (10 ** op.score_grams(grams.head, grams.rest, model.find, model.root)).sum()
        unseen = op.Grams([(0, context, "\uffff")])
        assert abs(left - 10 ** op.score_grams(unseen.head, unseen.rest, model.find, model.root)[0]) < 1e-4


def slow_judge(rows):
    """(n_words, measures, script, kept) of each row, by the definition."""
    model = Slow([t or "" for _, t, _ in rows])
    out = []
    for _, t, lang in rows:
        t = t or ""
        counts, total = base(t), model.total(t)
        letters = Counter(unicodedata.name(c, "").split(" ")[0] for c in t if c.isalpha())
        most = max(letters.values(), default=0)
        out.append([counts[0] < 10 or 100 * counts[4] > 20 * counts[0], counts[0], lang, {s for s in letters if letters[s] == most} or {None}, total / max(counts[0], 1), total / max(len(t), 1)])

    def middle(values):
        return sorted(values)[(len(values) - 1) // 2]

    good = [r for r in out if not r[0]]
    kept = [not r[0] for r in out]
    for m in (4, 5):
        def mid(lang, script):
            own = [r[m] for r in good if r[2] == lang and (script is None or script in r[3])]
            return middle(own) if own else None

        mids = {(r[2], s): mid(r[2], s) for r in out for s in {*r[3], None}}
        every = middle([abs(r[m] - mids[r[2], None]) * math.sqrt(min(r[1], op.SPAN)) for r in good])
        for i, r in enumerate(out):
            (script,) = r[3]
            if mids[r[2], script] is None:
                continue
            own = [abs(x[m] - mids[r[2], script]) * math.sqrt(min(x[1], op.SPAN)) for x in good if x[2] == r[2] and (script is None or script in x[3])]
            dev = 1.4826 * (max(middle(own), every) if len(own) < op.FEW else middle(own))
            kept[i] &= abs(r[m] - mids[r[2], script]) <= op.BAND * dev / math.sqrt(max(min(r[1], op.SPAN), 1))
    return [(r[4], r[5], k) for r, k in zip(out, kept)]


@pytest.mark.parametrize("model_bytes", [None, 0])
def test_whole_table_against_brute_force(spark, model_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = {r.doc_id: r for r in op.judge(docs, model_bytes).collect()}
    assert len(got) == len(rows)
    for (d, _, _), (per_word, per_char, kept) in zip(rows, slow_judge(rows)):
        assert math.isclose(got[d].per_word, per_word, rel_tol=1e-5, abs_tol=1e-6) and math.isclose(got[d].per_char, per_char, rel_tol=1e-5, abs_tol=1e-6)
        assert got[d].kept == kept


@pytest.mark.parametrize("n_chars", [120, 240, 2000])
def test_texts_of_very_long_words_are_kept(spark, n_chars):
    """Scripts without spaces: a word is a sentence or more, and log perplexities per word have no bound."""
    r = random.Random(n_chars)
    signs = [chr(0x4E00 + k) for k in range(60)]
    word = lambda: "".join(r.choices(signs, range(1, 61), k=n_chars))
    rows = [(i, " ".join(word() for _ in range(30)), "zz") for i in range(100)]
    rows += [(200 + i, " ".join("".join(chr(0x5E00 + r.randrange(3000)) for _ in range(n_chars)) for _ in range(30)), "zz") for i in range(3)]
    judged = op.judge(documents(spark, rows)).collect()
    assert sum(r.kept for r in judged if r.doc_id < 200) >= 99
    assert not any(r.kept for r in judged if r.doc_id >= 200)
    values = sorted(r.per_word for r in judged)
    assert math.isclose(judged[0].per_word_low + judged[0].per_word_high, 2 * values[(len(values) - 1) // 2], rel_tol=1e-3)
    assert n_chars < 200 or values[50] > 100


def test_medians_of_any_values(spark):
    """To one BINS-th of the value, or of the fixed smallest width, from 0.0001 to ten million."""
    r = random.Random(4)
    rows = [(f"l{k}", None, "m", 10.0**k * r.uniform(0.5, 2)) for k in range(-4, 8) for _ in range(25)]
    values = spark.createDataFrame(rows, "lang string, script string, measure string, x double")
    got = {m.lang: m.middle for m in op._middle(op._histogram(values, values.x), "lang").collect()}
    for k in range(-4, 8):
        own = sorted(x for lang, _, _, x in rows if lang == f"l{k}")
        assert abs(got[f"l{k}"] - own[12]) <= (own[12] + op.FINE) / op.BINS


def test_long_texts_are_scored_in_segments(monkeypatch):
    text = prose(500, 3)
    whole = op.Grams(next(op.runs([text])))
    monkeypatch.setattr(op, "CHARS", 70)
    parts = [op.Grams(run) for run in op.runs(["", text, "x", text])]
    for k in (1, 3):
        assert (np.concatenate([g.head[g.text == k] for g in parts]) == whole.head).all()
        assert (np.concatenate([g.rest[g.text == k] for g in parts]) == whole.rest).all()


def test_empty(spark):
    assert op.judge(empty(spark)).collect() == []
    assert op.keep_good(empty(spark)).collect() == []
