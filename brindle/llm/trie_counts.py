"""Token counts under a unigram model by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens are inserted in a trie that a worker process keeps between batches and tasks. Each of its nodes, a prefix, has
its forward score (that of its best segmentation, with its number of tokens), which is computed once and shared by all
pre-tokens that begin with it; new pre-tokens come in sorted order, so that the pieces open at a node are shared as well. A
pre-token's terminal count is remembered; a text has the sum of its pre-tokens' counts. A trie of NODES nodes is begun anew.
Pre-tokens of over LONG characters are not inserted: their forward scores are held for as long as open pieces ask for them.

Pre-tokens end before runs of spaces, around line feeds and between signs and letters, which no piece of the model spans, so that the best
segmentation of a text is made of those of its pre-tokens. Of segmentations with equal scores the one with fewer tokens
counts. A character that no piece has counts as many tokens as it has bytes.

Cases: a null or empty text has no tokens. A very long text is taken in segments, one pre-token without end in one pass. Rows that repeat are rows of their own. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.bpe_ids import CutMemo
from brindle.llm.sentencepiece_stream import LONG, SPACE, Codec, Pieces, _pieces
from brindle.llm.work import held, slices

#: Nodes of a worker's trie, some 150 bytes each.
NODES = 1_000_000


class TrieCounter(CutMemo):
    """Counts of whole texts; the memo holds one value per pre-token, its terminal count.

    The trie of pre-tokens outlives the batches: ``children`` by node and character, and the forward score of each node, which
    is computed when the node is made. A trie of more than NODES nodes is dropped, and begun anew."""

    boundary = Codec.boundary

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.steps = 0  # forward scores computed
        self.drop()
        super().__init__(pieces.pattern, np.dtype(np.int64))

    def drop(self) -> None:
        self.children: dict[int, int] = {}
        self.score, self.tokens = array("d", [0.0]), array("q", [0])  # of tokens the negative number

    def find(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.empty(len(cuts), dtype=np.int64)
        root, scores, ids, unknown = self.pieces.trie, self.pieces.scores, self.pieces.ids, self.pieces.unknown_score
        children, score, tokens = self.children, self.score, self.tokens
        #: Along the current path of the trie, by depth: the nodes; the open pieces, as (node of the pieces' trie, depth of their start).
        nodes: list[int] = [0]
        pending: list[list[tuple[dict, int]]] = [[]]
        last = ""
        for k in sorted(range(len(cuts)), key=cuts.__getitem__):
            cut = cuts[k]
            if len(cut) > LONG:
                counts[k] = self.long(cut)
                continue
            if len(score) > NODES:
                self.drop()
                children, score, tokens = self.children, self.score, self.tokens
                nodes, pending, last = [0], [[]], ""
            shared, most = 0, min(len(last), len(cut))
            while shared < most and last[shared] == cut[shared]:
                shared += 1
            del nodes[shared + 1 :], pending[shared + 1 :]
            for depth in range(shared, len(cut)):
                c = cut[depth]
                key = nodes[depth] << 21 | ord(c)
                reached, child = [], children.get(key)
                if child is None:
                    best = None
                    for node, start in (*pending[depth], (root, depth)):
                        if (step := node.get(c)) is None:
                            continue
                        node, i = step
                        if node:
                            reached.append((node, start))
                        if i >= 0:
                            found = (score[nodes[start]] + scores[i], tokens[nodes[start]] - 1)
                            if best is None or found > best:
                                best = found
                    if c not in ids:
                        found = (score[nodes[depth]] + unknown, tokens[nodes[depth]] - len(c.encode("utf-8", "surrogatepass")))
                        if best is None or found > best:
                            best = found
                    child = children[key] = len(score)
                    score.append(best[0])
                    tokens.append(best[1])
                    self.steps += 1
                else:  # known: only the open pieces are followed
                    for node, start in (*pending[depth], (root, depth)):
                        if (step := node.get(c)) is not None and step[0]:
                            reached.append((step[0], start))
                nodes.append(child)
                pending.append(reached)
            counts[k] = -tokens[nodes[-1]]
            last = cut
        return counts, np.ones(len(cuts), dtype=np.int64)

    def long(self, cut: str) -> int:
        """The count of a pre-token too long to share its prefixes: only the forward scores that open pieces ask for are held."""
        root, scores, ids, unknown = self.pieces.trie, self.pieces.scores, self.pieces.ids, self.pieces.unknown_score
        forward: dict[int, tuple[float, int]] = {0: (0.0, 0)}
        pending: list[tuple[dict, int]] = []
        for depth, c in enumerate(cut):
            best, reached = None, []
            for node, start in (*pending, (root, depth)):
                if (step := node.get(c)) is None:
                    continue
                node, i = step
                if node:
                    reached.append((node, start))
                if i >= 0:
                    found = (forward[start][0] + scores[i], forward[start][1] - 1)
                    if best is None or found > best:
                        best = found
            if c not in ids:
                found = (forward[depth][0] + unknown, forward[depth][1] - len(c.encode("utf-8", "surrogatepass")))
                if best is None or found > best:
                    best = found
            forward = {start: forward[start] for _, start in reached} | {depth + 1: best}
            pending = reached
        return -forward[len(cut)][1]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, to which the model puts a space in front."""
        out = np.zeros(len(texts), dtype=np.int64)
        for run in self.runs([SPACE + t.replace(" ", SPACE) if t else "" for t in texts]):
            which, sizes = self.number([segment for _, segment in run])
            np.add.at(out, np.repeat([k for k, _ in run], sizes), self.values[which])
        return out


def counter(path: str) -> TrieCounter:
    return held(("trie_counts", path), lambda: TrieCounter(_pieces(path)))


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found = [own.count(texts[at : at + 512]) for at in range(0, len(texts), 512)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate([np.zeros(0, np.int64), *found]))], names=["doc_id", "n_tokens"])
        own.trim()

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens), a row per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_counts(path), "doc_id long, n_tokens long")
