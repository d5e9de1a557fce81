"""Byte-level BPE ids by the tokenizers library, whole texts, with a bounded memo of pre-tokens.

Texts are cut only where the byte-level pattern always ends a pre-token, whatever stands around: before a
space that a non-space follows, between a Latin letter and stops, and around a single line feed between
stops and a letter. What lies between such cuts is encoded by the library once and remembered.

Ids are those of the library as its file configures it: strings of added tokens (such as ``<|endoftext|>``) in a text get those
tokens' ids, and what stands before and after one is encoded on its own.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np

from brindle.llm.work import held

#: By default, a memo of more entries or characters than these is cut back, and so is any at the end of a task, to the
#: cuts met first: frequent ones are met early, and idle worker processes hold little.
MEMO_ENTRIES, MEMO_CHARS, MEMO_KEPT = 600_000, 10_000_000, 400_000
#: Characters whose cuts are held at once, unless one cut is longer.
RUN = 1_000_000

_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_CUT = re.compile(
    rf" ?[{_L}]++(?=[.,;:!?]| \S|\Z)"  # a word that stops, a space or the end follow
    rf"| ?[.,;:!?]++(?= \S|\n[{_L}]|\Z)"
    rf"|(?<=[.,;:!?])\n(?=[{_L}])"
    r"|(?: ?[^ ]++| )(?: (?!\S)[^ ]*+)*+"  # anything else up to a space that a non-space follows
)
_WORD = re.compile(rf" [{_L}]+")


def _library(path: str):
    """The tokenizer; the same for texts of spaced words alone, which it need not
    search by the full pattern; which ids begin with a space; and the strings of added tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers import pre_tokenizers as pre

    library = Tokenizer.from_file(path)
    words = Tokenizer(library.model)  # the same model, not a copy
    words.pre_tokenizer = pre.Sequence([pre.Split(" ", "merged_with_next"), pre.ByteLevel(add_prefix_space=False, use_regex=False)])
    opens = np.zeros(library.get_vocab_size(), dtype=bool)
    opens[[i for token, i in library.get_vocab().items() if token[0] == "\u0120"]] = True
    added = library.get_added_tokens_decoder().values()
    if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added):
        raise ValueError("added tokens that take in what stands around them")
    return library, words, opens, tuple(sorted((t.content for t in added), key=len, reverse=True))


class _Numbers(dict):
    """Numbers of cuts; an unknown one gets the next number and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, cut: str) -> int:
        number = self[cut] = len(self)
        self.waiting.append(cut)
        return number


class CutMemo:
    """Values of texts' cuts, each found once and remembered: the number of each cut, and by number the bounds of
    its values in one flat array. ``boundary`` finds places in a text at which a cut always begins."""

    boundary: re.Pattern
    #: Entries and characters of a memo that is not cut back yet, and the entries that it is cut back to.
    entries, chars_held, kept = MEMO_ENTRIES, MEMO_CHARS, MEMO_KEPT

    def __init__(self, pattern: re.Pattern, dtype: np.dtype):
        self.pattern, self.dtype = pattern, dtype
        self.numbers, self.chars = _Numbers(), 0
        self.values, self.bounds = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def trim(self) -> None:
        """Keep the cuts with the smallest numbers; none, if these are long."""
        pop = self.numbers.popitem  # the newest first
        for _ in range(len(self.numbers) - self.kept):
            self.chars -= len(pop()[0])
        if self.chars > self.chars_held * 3 // 4:
            self.numbers, self.chars = _Numbers(), 0
        self.bounds = self.bounds[: len(self.numbers) + 1].copy()
        self.values = self.values[: self.bounds[-1]].copy()

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def find(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``cuts``, one after another, and how many each has."""
        raise NotImplementedError

    def number(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The numbers of all texts' cuts, and how many cuts each text has."""
        if len(self.numbers) > self.entries or self.chars > self.chars_held:
            self.trim()
        cuts = [self.cut(t) for t in texts]
        sizes = [len(c) for c in cuts]
        get = self.numbers.__getitem__
        which = np.fromiter(map(get, itertools.chain.from_iterable(cuts)), dtype=np.int64, count=sum(sizes))
        waiting, self.numbers.waiting = self.numbers.waiting, []
        if waiting:
            self.chars += sum(map(len, waiting))
            values, lens = self.find(waiting)
            self.bounds = np.concatenate([self.bounds, np.cumsum(lens) + len(self.values)])
            self.values = np.concatenate([self.values, values])
        return which, sizes

    def runs(self, texts: list[str]) -> Iterator[list[tuple[int, str]]]:
        """(text, segment) of all texts in lists of some RUN characters; long texts in segments that end where any cut would."""
        run, held = [], 0
        for k, text in enumerate(texts):
            at, size = 0, len(text)
            while at < size or not size:
                end = size
                if size - at > RUN:
                    found = self.boundary.search(text, at + RUN // 2)
                    end = found.start() if found else size
                run.append((k, text[at:end] if end - at < size else text))
                held += end - at
                at = end
                if held >= RUN:
                    yield run
                    run, held = [], 0
                if not size:
                    break
        if run:
            yield run

    def encode(self, texts: list[str]) -> list[bytes]:
        """The values of each text, as bytes."""
        out: list[list[bytes]] = [[] for _ in texts]
        for run in self.runs(texts):
            for (k, _), data in zip(run, self._encode([segment for _, segment in run])):
                out[k].append(data)
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in out]

    def _encode(self, texts: list[str]) -> list[bytes]:
        which, sizes = self.number(texts)
        starts = self.bounds[which]
        lens = self.bounds[which + 1] - starts
        stops = np.cumsum(lens)
        total = int(stops[-1]) if len(stops) else 0
        small = np.int32 if total + len(self.values) < 1 << 31 else np.int64
        data = self.values[np.arange(total, dtype=small) + np.repeat((starts - stops + lens).astype(small), lens)].tobytes()
        at = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)] * self.dtype.itemsize
        at = at.tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]


class Encoder(CutMemo):
    """Texts to little-endian id bytes; ``dtype`` is the narrowest unsigned type that holds every id."""

    boundary = re.compile(r" (?=\S)")

    def __init__(self, path: str):
        self.library, self.words, self.opens, self.added = _library(path)
        self.around = re.compile(f"({'|'.join(map(re.escape, self.added))})") if self.added else None
        super().__init__(_CUT, np.dtype("<u2" if len(self.opens) <= 1 << 16 else "<u4"))

    def cut(self, text: str) -> list[str]:
        if any(t in text for t in self.added):
            parts = self.around.split(text)  # every second one is an added token
            return [x for k, part in enumerate(parts) for x in ([part] if k & 1 else self.pattern.findall(part))]
        return self.pattern.findall(text)

    def id_bytes(self, i: int) -> bytes:
        return self.dtype.type(i).tobytes()

    def find(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [_WORD.fullmatch(c) is not None for c in cuts]
        words = list(itertools.compress(cuts, plain))
        others = [c for c, p in zip(cuts, plain) if not p]
        runs = ["".join(words[at : at + 1000]) for at in range(0, len(words), 1000)]
        word_ids = [np.array(e.ids, self.dtype) for e in self.words.encode_batch_fast(runs, add_special_tokens=False)]
        word_ids = np.concatenate([np.zeros(0, self.dtype), *word_ids])
        firsts = np.flatnonzero(self.opens[word_ids])
        if len(firsts) != len(words):
            raise AssertionError("ids of spaced words don't open with their spaces")
        other_ids = [e.ids for e in self.library.encode_batch_fast(others, add_special_tokens=False)]
        plain = np.array(plain)
        lens = np.empty(len(cuts), dtype=np.int64)
        lens[plain] = np.diff(np.append(firsts, len(word_ids)))
        lens[~plain] = [len(x) for x in other_ids]
        ids = np.empty(int(lens.sum()), dtype=self.dtype)
        from_words = np.repeat(plain, lens)
        ids[from_words] = word_ids
        ids[~from_words] = np.fromiter(itertools.chain.from_iterable(other_ids), dtype=self.dtype)
        return ids, lens


def encoder(path: str) -> Encoder:
    """One encoder a worker process: its later tasks know the words of its earlier ones."""
    return held(("bpe_ids", path), lambda: Encoder(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
