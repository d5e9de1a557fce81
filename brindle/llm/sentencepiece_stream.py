"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search keeps, for each position of a window as long as the longest piece, the best path that ends there. As
soon as all paths that can still be extended run through one boundary, the ids before it are committed and
forgotten, so that the search needs a window of memory only for a text of any length: twice the longest piece, unless paths
differ for longer.

Two kinds of model share the search. For ``unigram`` models a path's score is the sum of its pieces' scores. For
``bpe`` models a step is admissible if merging its two pieces' characters by score gives just these two
pieces; each position then has exactly one admissible path, and it is the merge order's own result.
Characters that no piece has fall back to their UTF-8 bytes.

No piece holds a space after another character, and none a line feed; nor does any join signs to letters, in many vocabularies. All
paths therefore converge at such places. :class:`Codec` feeds the search what lies between them once and remembers the ids
that it commits there; longer runs of characters are fed part by part and not remembered. Texts are taken in segments of bounded length.

Cases: a null or empty text has no ids and decodes to the empty text. A very long text, with spaces or without, needs memory for
itself and its ids. Rows that repeat are rows of their own. An empty
table gives an empty result. Other columns are ignored. A text's own U+2581 decodes to a space, as the
library has it.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.bpe_ids import CutMemo
from brindle.llm.work import held, slices

SPACE = "▁"
#: What the library subtracts from the lowest score for an unknown character.
UNKNOWN_PENALTY = 10.0
#: Numbers from here on stand for unknown characters, by their code points.
UNKNOWN = 1 << 24
#: Characters fed at once, and of the longest cut that is remembered.
FEED, LONG = 1 << 16, 256
#: Characters that no piece may join to letters, if the vocabulary is so.
_SIGNS = frozenset(string.punctuation + string.digits)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A model's normal pieces: ids and scores by string, a trie of them, and the ids of bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.strings = [model.id_to_piece(i) for i in range(n)]
        self.scores = [model.get_score(i) for i in range(n)]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.normal = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) for i in range(n)]
        self.ids = {s: i for i, s in enumerate(self.strings) if self.normal[i]}
        self.longest = max(map(len, self.ids))
        self.unknown_score = min(self.scores[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.raw = [s.replace(SPACE, " ").encode() if ok else b"" for s, ok in zip(self.strings, self.normal)]
        for b, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([b])
        #: By character: the nodes that follow and the id of the piece that ends there, or -1.
        self.trie: dict[str, tuple[dict, int]] = {}
        for s, i in sorted(self.ids.items()):
            node = self.trie
            for k, c in enumerate(s):
                if c not in node:
                    node[c] = ({}, self.ids.get(s[: k + 1], -1))
                node = node[c][0]
        #: Neighbouring characters of pieces: where two others meet, no piece and no merge reaches across.
        self.joined = {s[k : k + 2] for s in self.ids for k in range(len(s) - 1)}
        self.pattern = self._cuts()
        self.by_score = {s: self.scores[i] for s, i in self.ids.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _cuts(self) -> re.Pattern:
        """Cuts of a text whose ends every path runs through: before spaces, around line feeds, and between signs and other characters,
        as far as pieces never hold both."""
        signs, before = set(_SIGNS), None
        while signs != before:
            before = set(signs)
            signs -= {c for a, b in self.joined if a != SPACE and (a in signs) != (b in signs) for c in (a, b)}
        own = re.escape("".join(sorted(signs)))
        both = rf"{SPACE}*[{own}]+|{SPACE}*[^{own}{SPACE}\n]+" if signs else rf"{SPACE}*[^{SPACE}\n]+"
        return re.compile(rf"{both}|{SPACE}+|\n")

    def string(self, number: int) -> str:
        return chr(number - UNKNOWN) if number >= UNKNOWN else self.strings[number]

    def merge(self, text: str) -> list[str]:
        """The symbols that merging by score leaves: highest score first, of equals the leftmost."""
        symbols, score = list(text), self.by_score.get
        found = [score(a + b) for a, b in itertools.pairwise(symbols)]  # of each symbol with the next
        while True:
            best, at = None, -1
            for k, x in enumerate(found):
                if x is not None and (best is None or x > best):
                    best, at = x, k
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = score(symbols[at] + symbols[at + 1])
            if at:
                found[at - 1] = score(symbols[at - 1] + symbols[at])

    def admissible(self, before: int, piece: int) -> bool:
        """Whether merging leaves these two pieces as they are, side by side; -1: nothing is before."""
        if (known := self.pairs.get((before, piece))) is None:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            b = self.string(piece)
            if before < 0:
                known = self.merge(b) == [b]
            else:
                a = self.string(before)
                known = self.admissible(-1, piece) and self.merge(a + b) == [a, b]
            self.pairs[before, piece] = known
        return known

    def out(self, number: int) -> list[int]:
        """The ids of a piece, or of an unknown character's bytes."""
        if number < UNKNOWN:
            return [number]
        return [self.byte_ids[b] for b in chr(number - UNKNOWN).encode("utf-8", "surrogatepass")]


class StreamingViterbi:
    """Ids of a stream of characters, with spaces as U+2581, committed as early as all paths agree.

    Positions count from the committed boundary. The window holds those since then: a path that can still be extended begins
    a piece at one of them, or ends at the last."""

    def __init__(self, pieces: Pieces, kind: str = "bpe"):
        self.pieces, self.bpe = pieces, kind == "bpe"
        #: By position: where the piece that ends there starts, its number, and, for unigram models, its path's score.
        self.starts, self.numbers, self.scores = [0], [-1], [0.0]
        self.open: list[tuple[int, dict]] = []  # start positions, ascending, and the trie nodes reached from them
        self.last = ""
        #: Characters and ids committed; for each commit where it ended, as both.
        self.chars = self.ids = 0
        self.commits: list[tuple[int, int]] = []

    def feed(self, text: str) -> list[int]:
        """Read ``text`` and return the ids that it commits."""
        done: list[int] = []
        bpe, pieces, commit = self.bpe, self.pieces, self._commit
        trie, ids, joined, limit = pieces.trie, pieces.ids, pieces.joined, 2 * pieces.longest
        pairs, admissible = pieces.pairs, pieces.admissible
        starts, numbers, open_, last = self.starts, self.numbers, self.open, self.last
        for c in text:
            end = len(starts)
            at = end - 1
            if not at and last + c not in joined:
                numbers[0] = -1  # no piece, and no merge, reaches over the boundary
            open_.append((at, trie))
            if bpe:
                # Extend the open pieces, and the one admissible path by a piece that ends here.
                reached, number, begin = [], -1, at
                for start, node in open_:
                    if c in node:
                        node, i = node[c]
                        if node:
                            reached.append((start, node))
                        if i >= 0 and number < 0:
                            pair = numbers[start], i
                            if pairs[pair] if pair in pairs else admissible(*pair):
                                number, begin = i, start
                if number < 0:
                    number = UNKNOWN + ord(c)
                    if c in ids or not admissible(numbers[at], number):
                        raise AssertionError("no admissible piece ends here")
                starts.append(begin)
                numbers.append(number)
                open_ = reached
            else:
                open_, begin = self._best(c, open_, at)
            if not open_:  # all paths run through this place
                if begin and begin == at:
                    commit(begin, done)
                    end = 1
                commit(end, done)
            elif begin == at and open_[0][0] == at:  # through the one before
                if at:
                    commit(at, done)
                    if last + c not in joined:
                        numbers[0] = -1
                    open_ = [(0, node) for _, node in open_]
            elif end >= limit and (boundary := self._meeting(open_)):
                commit(boundary, done)
                open_ = [(start - boundary, node) for start, node in open_]
            last = c
        self.open, self.last = open_, last
        return done

    def _best(self, c: str, open_: list[tuple[int, dict]], at: int) -> tuple[list[tuple[int, dict]], int]:
        """Extend the open pieces, and the path of the best score by a piece that ends with ``c``; of equal ones that whose last piece is
        the longest. What is open now, and where that piece starts."""
        pieces, scores, reached, number, begin, best = self.pieces, self.scores, [], -1, at, 0.0
        for start, node in open_:
            if (found := node.get(c)) is not None:
                node, i = found
                if node:
                    reached.append((start, node))
                if i >= 0 and (number < 0 or scores[start] + pieces.scores[i] > best):
                    number, begin, best = i, start, scores[start] + pieces.scores[i]
        if c not in pieces.ids and (number < 0 or scores[at] + pieces.unknown_score > best):
            number, begin, best = UNKNOWN + ord(c), at, scores[at] + pieces.unknown_score
        self.starts.append(begin)
        self.numbers.append(number)
        scores.append(best)
        return reached, begin

    def finish(self) -> list[int]:
        """The ids not yet committed; the stream ends, and with it all paths but one."""
        done: list[int] = []
        self._commit(len(self.starts) - 1, done)
        self.open = []
        return done

    def _meeting(self, open_: list[tuple[int, dict]]) -> int:
        """The last boundary that all paths run through which may still be extended."""
        heap = [1 - len(self.starts), *(-start for start, _ in open_)]
        heapq.heapify(heap)
        top = heapq.heappop(heap)
        while heap:
            while heap and heap[0] == top:
                heapq.heappop(heap)
            if not heap:
                break
            heapq.heappush(heap, -self.starts[-top])
            top = heapq.heappop(heap)
        return -top

    def _commit(self, boundary: int, done: list[int]) -> None:
        """Add the ids of the one path up to ``boundary`` to ``done`` and forget it."""
        k, starts, numbers, n = boundary, self.starts, self.numbers, len(done)
        found = []
        while k:
            if (i := numbers[k]) < UNKNOWN:
                found.append(i)
            else:
                found += reversed(self.pieces.out(i))
            k = starts[k]
        done += found[::-1]
        starts[:] = [0, *[start - boundary for start in starts[boundary + 1 :]]]
        del numbers[:boundary]
        if not self.bpe:
            least = self.scores[boundary]
            self.scores[:] = [x - least for x in self.scores[boundary:]]
        self.chars += boundary
        self.ids += len(done) - n
        self.commits.append((self.chars, self.ids))


class Codec(CutMemo):
    """Whole texts to ids and back. All ids come from the streaming search; those of short cuts are remembered."""

    boundary = re.compile(rf"(?<=[^{SPACE}]){SPACE}|\n")
    entries, chars_held, kept = 1_200_000, 20_000_000, 900_000  # a cut costs more to search than to hold

    def __init__(self, path: str, kind: str = "bpe"):
        self.pieces, self.kind = _pieces(path), kind
        super().__init__(self.pieces.pattern, np.dtype("<u2" if len(self.pieces.strings) <= 1 << 16 else "<u4"))

    def stream(self, text: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of a text that comes in parts, with spaces as U+2581, as they are committed."""
        search = StreamingViterbi(self.pieces, self.kind)
        for part in text:
            for at in range(0, len(part), FEED):
                yield np.array(search.feed(part[at : at + FEED]), self.dtype)
                search.commits.clear()
        yield np.array(search.finish(), self.dtype)

    def find(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The cuts are one stream, in which a line feed ends each that nothing else ends; the commits at their ends share out its ids."""
        values: list[np.ndarray] = []
        lens = np.zeros(len(cuts), dtype=np.int64)
        order, ends, parts, at = [], [], [], 0
        for k, cut in enumerate(cuts):
            if len(cut) > LONG:
                continue
            # "\n" is a cut itself, and no piece has it.
            if parts and parts[-1][-1] + cut[0] in self.pieces.joined:
                parts.append("\n")
                at += 1
            order.append((k, at))
            parts.append(cut)
            at += len(cut)
            ends.append(at)
        where = [0] * len(cuts)
        ids = np.zeros(0, self.dtype)
        if order:
            search = StreamingViterbi(self.pieces, self.kind)
            found = [np.array(search.feed("".join(parts[x : x + 4096])), self.dtype) for x in range(0, len(parts), 4096)]
            found.append(np.array(search.feed("\n"), self.dtype))
            ids = np.concatenate(found)
            reached = dict([(0, 0), *search.commits])
            for (k, begin), end in zip(order, ends):
                where[k] = reached[begin]
                lens[k] = reached[end] - where[k]
        for k, cut in enumerate(cuts):
            if len(cut) > LONG:
                values.append(np.concatenate(list(self.stream([cut]))))
                lens[k] = len(values[-1])
            else:
                values.append(ids[where[k] : where[k] + lens[k]])
        return np.concatenate([np.zeros(0, self.dtype), *values]), lens

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, to which the model puts a space in front."""
        spaced = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        return [np.frombuffer(b, self.dtype) for b in self.encode(spaced)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``, without the space in front; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.pieces.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@functools.lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def codec(path: str, kind: str) -> Codec:
    return held(("sentencepiece_stream", path, kind), lambda: Codec(path, kind))


ENCODED = "doc_id long, ids array<int>"


def _encoder(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, kind)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 1024):
                ids = own.encode_texts(texts[at : at + 1024])
                flat = np.concatenate([np.zeros(0, own.dtype), *ids]).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(ids)), lists], names=["doc_id", "ids"])
        own.trim()

    return run


def encode(docs: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """(doc_id, ids) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encoder(path, kind), ENCODED)


def _decoder(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, kind)
        for batch in slices(batches):
            texts = [own.decode(np.array(x or [], dtype=np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """(doc_id, text) of the ids of :func:`encode`."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(path, kind), "doc_id long, text string")


def _digester(path: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, kind)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 1024):
                part = texts[at : at + 1024]
                ids = own.encode_texts(part)
                columns = [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([own.decode(x) == t.replace(SPACE, " ") for x, t in zip(ids, part)]),
                ]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), *columns], names=["doc_id", "n_ids", "ids_crc32", "round_trip"])
        own.trim()

    return run


def digest(docs: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """(doc_id, n_ids, ids_crc32, round_trip): the ids of every document, and whether they decode to its text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_digester(path, kind), "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
