"""Licence scans: matching statistics against a generalised suffix automaton of licence words.

The automaton holds every sequence of words of every template. Reading a text's words it gives, at each word, the
length of the longest sequence that ends there and occurs in some template. A match of at least MIN_MATCH words counts for a
template that holds it, or holds an ending of it of that length, where the template cannot be followed further. Matches
are chained: along the text and along one template, over bounded gaps in both, so that names, years, small changes and words
of another template do not break a notice. A chain that covers enough of its template, and in one match each all the phrases
that the template marks, labels the text.

The base phrases are templates as well; their places are counted besides. Templates are in :mod:`brindle.llm.license_texts`.

Where the texts of two licences share most of their words, the one with more of them is meant if both are found close together
(license_texts.RELATIVES). The expression after "SPDX-License-Identifier:", or on a line of its own after "License:", labels the text with all
the licences that it names.

Only runs of words that some template has enter the automaton, since a match has no others. A text is read once and
needs memory for its words and matches. Time is linear in the text, but a text of nothing but repeated words of many notices ("licensed under
the" over and over) takes some 15 seconds a MB, in one task.

Cases: a null text has no words. Rows that repeat are rows of their own. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm import license_texts
from brindle.llm.license_texts import BASE_PHRASES
from brindle.llm.work import slices

#: Words of the shortest match, and most words between two chained matches in the text and in the template.
MIN_MATCH, GAP = 3, 24
#: Share of a template's words that a chain must cover; templates of few words must be covered whole.
COVER, WHOLE = 0.75, 5
#: Most words between a licence and one whose text holds most of it, for the lesser one not to count.
NEXT_TO = 60
#: A line that declares a licence, and the words before an expression.
_DECLARED = re.compile(r"^[#*/\-\"' \t]*+licen[cs]e[\"']?[ \t]*+[:=][ \t]*+[\"'(]?([^\n\"']{2,80})[\"',.; \t\r]*+$", re.I | re.M)
_SPDX_WORDS = (b"spdx", b"license", b"identifier")
#: Words scanned together.
WORDS = 1_000_000

#: Each byte to a space, or to itself in lower case if words hold it: digits, letters and all of UTF-8's other bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of a text, ASCII letters in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Automaton:
    """The generalised suffix automaton of some word sequences (Blumer et al. 1985, restarted for each sequence)."""

    def __init__(self, sequences: list[list[int]]):
        self.length, self.link, self.step = [0], [-1], [{}]
        own: list[list[tuple[int, int]]] = [[]]
        for t, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word, own)
                own[last].append((t, i + 1))
        # A state's places are its own and those of the states whose suffixes it holds.
        places: list[set] = [set(x) for x in own]
        for s in sorted(range(1, len(own)), key=lambda s: -self.length[s]):
            if self.length[self.link[s]] >= MIN_MATCH:
                places[self.link[s]] |= places[s]
        self.places = [tuple(sorted(x)) for x in places]
        self._shorter: dict[int, list[tuple[int, int, int]]] = {}

    def _add(self, length: int, link: int, step: dict, own: list) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        own.append([])
        return len(self.length) - 1

    def _split(self, p: int, word: int, own: list) -> int:
        """The state that the transition from ``p`` leads to, split off if its longest sequence is longer."""
        q = self.step[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._add(self.length[p] + 1, self.link[q], dict(self.step[q]), own)
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int, own: list) -> int:
        if word in self.step[last]:
            return self._split(last, word, own)
        new = self._add(self.length[last] + 1, 0, {}, own)
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, own)
        return new

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int, int]]:
        """(end, length, state, next word or 0) at each word at which a match of at least MIN_MATCH words ends: the matching statistics."""
        state = length = 0
        for i, word in enumerate(words):
            if length >= MIN_MATCH:
                yield i, length, state, word
            if word not in self.step[state]:
                while state and word not in self.step[state]:
                    state = self.link[state]
                    length = self.length[state]
                if word not in self.step[state]:
                    continue
            state, length = self.step[state][word], length + 1
        if length >= MIN_MATCH:
            yield len(words), length, state, 0

    def credits(self, state: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(template, end in it, words) of a match and of its endings of at least MIN_MATCH words: at each place the longest."""
        yield from ((t, t_end, length) for t, t_end in self.places[state])
        if state not in self._shorter:
            found, seen, s = [], set(self.places[state]), self.link[state]
            while s > 0 and self.length[s] >= MIN_MATCH:
                found += [(t, t_end, self.length[s]) for t, t_end in self.places[s] if (t, t_end) not in seen]
                seen.update(self.places[s])
                s = self.link[s]
            self._shorter[state] = found
        yield from self._shorter[state]


class Template:
    """The words of a template as numbers, how many a chain must cover, and the places of the phrases that it must hold."""

    def __init__(self, label: str, text: str, number):
        self.label, self.words, self.phrases = label, [], []
        for k, part in enumerate(re.split(r"([{}])", text)):
            if part == "{":
                begin = len(self.words)
            elif part == "}":
                self.phrases.append((begin, len(self.words)))
            else:
                self.words += [number(w) for w in words_of(part)]
        n = len(self.words)
        self.needed = n if n <= WHOLE else max(WHOLE, -(-int(n * COVER * 100) // 100))
        self.all = (1 << len(self.phrases)) - 1

    def held(self, begin: int, end: int) -> int:
        """The phrases within some of its words, as bits."""
        return sum(1 << k for k, (a, b) in enumerate(self.phrases) if begin <= a and b <= end)


class Chain(NamedTuple):
    """Matches along a text and a template: where the last one ends in both, the words covered, the phrases held, where the first begins."""

    end: int
    t_end: int
    covered: int
    held: int
    start: int


def without_lesser(spans: set[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans without those of licences that stand in one row, of gaps of at most NEXT_TO words, with a licence that contains them."""
    gone: set[tuple[str, int, int]] = set()
    for more, less in license_texts.RELATIVES:
        own = sorted((s for s in spans if s[0] in (more, less)), key=lambda s: s[1:])
        if len({label for label, _, _ in own}) < 2:
            continue
        row: list[tuple[str, int, int]] = []
        reach = 0
        for s in [*own, None]:
            if row and (s is None or s[1] > reach + NEXT_TO):
                if any(label == more for label, _, _ in row):
                    gone.update(x for x in row if x[0] == less)
                row, reach = [], 0
            if s:
                row.append(s)
                reach = max(reach, s[2])
    return [s for s in spans if s not in gone]


class Scanner:
    """The automaton, the numbers of its words and the base phrases in these."""

    def __init__(self, base=BASE_PHRASES, texts: list[tuple[str, str]] | None = None):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        own = [(label, phrase) for phrase, label in base] + (license_texts.templates() if texts is None else texts)
        self.templates = [Template(label, text, number) for label, text in own]
        self.labels = [t.label for t in self.templates]
        self.base = [(np.array(t.words), t.label) for t in self.templates[: len(base)]]
        self.spdx = [number(w) for w in _SPDX_WORDS]
        self.identifiers = {tuple(words_of(x)): label for label, x in license_texts.identifiers()}
        self.widest = max(map(len, self.identifiers))
        self.longest = max(len(t.words) for t in self.templates)
        self.automaton = Automaton([t.words for t in self.templates])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), dtype=np.int32, count=len(words))

    def ends(self, run: list[int]) -> Iterator[tuple[int, int, int, int]]:
        """(end, template, end in it, words) of the matches of a run of words that their template does not follow further."""
        for end, length, state, word in self.automaton.matches(run):
            for t, t_end, n in self.automaton.credits(state, length):
                words = self.templates[t].words
                if not word or t_end == len(words) or words[t_end] != word:
                    yield end, t, t_end, n

    def chains(self, found: list[tuple[int, int, int, int]]) -> tuple[dict[int, int], list[tuple[int, int, int]]]:
        """Per template the words that its best chain covers, and (template, first word, end) in the text of all chains that
        cover enough and hold all phrases. Of chains of one template that overlap, the one that covers more stays. ``found``: (end,
        template, end in it, words) of matches in order of their ends."""
        best: dict[int, int] = {}
        enough: dict[int, list[tuple[int, int, int]]] = {}  # (-covered, text start, text end)
        recent: dict[int, list[Chain]] = {}
        for end, t, t_end, n in found:
            template, begin, t_begin = self.templates[t], end - n, t_end - n
            held = template.held(t_begin, t_end)
            kept = [c for c in recent.get(t, ()) if c.end >= end - self.longest - GAP]
            chain = Chain(end, t_end, n, held, begin)
            for c in kept:
                # Overlaps, in the text or in the template, count once.
                lap = max(c.end - begin, c.t_end - t_begin, 0)
                if lap < n and begin - c.end <= GAP and t_begin - c.t_end <= GAP and c.t_end < t_end and c.end < end:
                    longer = Chain(end, t_end, c.covered + n - lap, c.held | held, c.start)
                    if (longer.held.bit_count(), longer.covered) > (chain.held.bit_count(), chain.covered):
                        chain = longer
            recent[t] = [*kept, chain]
            best[t] = max(chain.covered, best.get(t, 0))
            if chain.covered >= template.needed and chain.held == template.all:
                enough.setdefault(t, []).append((-chain.covered, chain.start, end))
        spans = []
        for t, own in enough.items():
            taken: list[tuple[int, int]] = []
            for _, start, end in sorted(own):
                at = bisect.bisect(taken, (start, end))
                if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                    taken.insert(at, (start, end))
            spans += [(t, start, end) for start, end in taken]
        return best, spans

    def expression(self, words: list[bytes], at: int) -> list[tuple[str, int]]:
        """The label and end of each licence of an expression that begins at a word, as far as its identifiers are known."""
        out = []
        while True:
            n = next((n for n in range(min(self.widest, len(words) - at), 0, -1) if tuple(words[at : at + n]) in self.identifiers), 0)
            if not n:
                return out
            label, at = self.identifiers[tuple(words[at : at + n])], at + n
            at += 2 if words[at : at + 2] == [b"or", b"later"] else words[at : at + 1] == [b"only"]
            out.append((label, at))
            if words[at : at + 1] not in ([b"or"], [b"and"]):
                return out
            at += 1

    def declared(self, text: str, words: list[bytes], after: list[int]) -> list[tuple[str, int, int]]:
        """The spans of expressions: those that begin at the words ``after``, and those that are all of a line behind "License:"."""
        spans = [(label, at - len(_SPDX_WORDS), end) for at in after for label, end in self.expression(words, at)]
        if "icens" in text or "ICENS" in text or "icenc" in text or "ICENC" in text:
            for m in _DECLARED.finditer(text):
                own = words_of(m[1])
                own = own[:-1] if own[-1:] in ([b"license"], [b"licence"]) else own
                found = self.expression(own, 0)
                if found and found[-1][1] == len(own):
                    first = len(words_of(text[: m.start()]))
                    spans += [(label, first, first + 1 + end) for label, end in found]
        return spans

    def scan(self, texts: list[str]) -> list[tuple]:
        """Per text: n_words, n_base, first_word, last_word, base labels, labels, score, spans of (label, first, end)."""
        split = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in split], dtype=np.int64)
        # All texts in one array, a zero after each, which ends every run.
        ids = np.concatenate([np.append(self.numbers(w), 0) for w in split]) if texts else np.zeros(0, np.int32)
        starts = np.cumsum(sizes + 1) - sizes - 1
        places: dict[int, list[tuple[int, str]]] = {}
        for phrase, label in self.base:
            k = len(phrase)
            hit = np.ones(max(0, len(ids) - k + 1), dtype=bool)
            for i, word in enumerate(phrase):
                hit &= ids[i : i + len(hit)] == word
            at = np.flatnonzero(hit)
            doc = np.searchsorted(starts, at, side="right") - 1
            for d, a in zip(doc.tolist(), (at - starts[doc]).tolist()):
                places.setdefault(d, []).append((a, label))
        after: dict[int, list[int]] = {}
        for a in np.flatnonzero(np.all([ids[k : len(ids) - 2 + k] == w for k, w in enumerate(self.spdx)], axis=0) if len(ids) > 2 else []).tolist():
            d = int(np.searchsorted(starts, a, side="right")) - 1
            after.setdefault(d, []).append(a - int(starts[d]) + len(_SPDX_WORDS))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]]).astype(np.int8)))
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= MIN_MATCH:
                d = int(np.searchsorted(starts, a, side="right")) - 1
                own = [(a + end - int(starts[d]), *rest) for end, *rest in self.ends(ids[a:b].tolist())]
                if own:
                    found.setdefault(d, []).extend(own)
        out = []
        for d, n in enumerate(sizes.tolist()):
            own = places.get(d, [])
            best, whole = self.chains(found[d]) if d in found else ({}, [])
            spans: list[tuple[str, int, int]] = []
            every = {(self.labels[t], start, end) for t, start, end in whole} | set(self.declared(texts[d], split[d], after.get(d, [])))
            for label, start, end in sorted(without_lesser(every), key=lambda x: (x[0], x[1], -x[2])):
                if not spans or spans[-1][0] != label or end > spans[-1][2]:  # not within another of its label
                    spans.append((label, start, end))
            base = {label for _, label in own}
            labels = base | {label for label, _, _ in spans}
            score = max((min(1.0, covered / len(self.templates[t].words)) for t, covered in best.items()), default=0.0)
            at = [a for a, _ in own]
            out.append((n, len(own), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans))
        return out


@functools.lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first: long, end: long>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = scanner()
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), span]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        at = 0
        while at < len(texts):
            to, held = at, 0
            while to < len(texts) and (to == at or held < 6 * WORDS):
                held += len(texts[to])
                to += 1
            rows = own.scan(texts[at:to])
            rows = [(*r[:-1], [dict(zip(("label", "first", "end"), s)) for s in r[-1]]) for r in rows]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, to - at), *columns], names=names)
            at = to


def scan(docs: DataFrame) -> DataFrame:
    """The licence findings of every document, with the spans of words that its labels rest on."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_scan, SCANNED)
