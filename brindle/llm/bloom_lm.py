"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

After Talbot and Osborne (2007): a count c is quantised to q = 1 + floor(log_b c), and the filter holds the
pairs (n-gram, 1) to (n-gram, q). Probing for 1, 2, ... until a pair is missing gives q back; it may come out too
large with a small probability, never too small. Counts are those of the training documents, all of them.

The filter is built in shards by the leading bits of the n-grams' hashes, each in one task and of the size that
its own n-grams need; so is the exact table of word counts that the base score asks for. Shards that together fit PART of what a worker may
hold are broadcast. Those of a larger model stay where they are and are probed there: runs of texts send them
their distinct n-grams (see :mod:`brindle.llm.lookup`), so that the cost grows with the corpus alone.

Model: absolute discounting, p(w | v) = (max(c(v w) - d, 0) + d * t(v) * p(w)) / c(v), and p(w) = (c(w) + 1) / z, which also stands for
p(w | v) where v is unknown. Counts are the mean counts of their quantisation bins. d = n1 / (n1 + 2 n2), from the numbers of bigrams seen
once and twice. t(v) = c(v) ** b stands for the number of words that follow v: b is such that the t(v) of all contexts add up to the
number of distinct bigrams. z makes p(w) sum to one over the training words and one unknown word. A bigram counts only if both its words
are in the filter, and at most as often as they do.

False positives are false followers of a context. Probes grow with the logarithm of the number of words, so that all words together give a context
less than one of them, however large the corpus; the expected mass of these, f * (words - t(v)) * (1 - d) / c(v) with the filters' share f of false positives, is divided out. It
matters for rare contexts only. The p(w | v) of a context remain estimates whose sum is near one, not exactly one: t(v) is the mean of its bin, and the
means of bigrams' bins need not add up to that of their context's bin. Over the words of a table of 79,171 (sf0.01) the sums of 150
contexts are 1.01 on average if drawn by frequency, 1.03 if drawn alike, and 1.6 at most.

Words are told apart by 64-bit hashes.

Cases: a null text counts as empty, one end token. A null doc_id's remainder is that of the empty string. A very long text is scored
by one task, which holds some 60 bytes for each of its tokens. Without training documents every count is zero. Rows that repeat are rows of their own. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.lookup import Found, look_up, pack, shard_edges, unpack, with_runs
from brindle.llm.work import broadcast_bytes, materialize, slices

#: Base of the quantisation.
BASE = 1.5
#: Words that a context may have as false followers, on average, in a filter without blocks; with them it has some more. The probes of
#: (n-gram, 1) are as many as this takes for the corpus's words.
FALSE = 0.25
#: Probes of (n-gram, 2) and further, which decide only between neighbouring bins.
PROBES = 7
#: Share of the bits that are set.
LOAD = 0.5
#: Bits of a block, and probes that a hash of 64 bits names in it.
BLOCK, DRAWN = 4096, 5
#: Bytes of text per shard, and most tasks that build shards.
SHARD_TEXT, BUILDERS = 1 << 25, 50_000
#: Of what a worker may hold, the part that a model may be: every token is probed some twenty times, at random places of it.
PART = 0.25
#: Characters scored at once, and tokens counted at once.
CHARS, TOKENS = 10_000_000, 2_000_000
#: Bytes hashed at once, the base of words' polynomials, and the hash of the end token.
PIECE, HASH_BASE, END = 1 << 19, 0x9E3779B97F4A7C15 * 5 % (1 << 64), 0x0E4D0E4D0E4D0E4D
#: One document in FOLDS is held out, those of remainder HELD.
FOLDS, HELD = 7, 2

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, the same for capital and small letters; which bytes are white space; powers of a base and of its inverse."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
    values[65:91] = values[97:123]
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return values, space, _powers(HASH_BASE, PIECE), _powers(pow(HASH_BASE, -1, 1 << 64), PIECE)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ASCII-lower-cased words of some bytes, and where each begins. A word's hash is its polynomial: a difference of prefix sums over the
    bytes of a piece of text, shifted to the word's beginning; all words of a piece at once."""
    values, space, up, down = _tables()
    data = np.frombuffer(raw, np.uint8)
    gaps = np.concatenate([[True], space[data], [True]])
    edges = np.flatnonzero(gaps[1:] != gaps[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + PIECE, side="right")))
        n = int(ends[to - 1] - low)
        powers, back = (up[:n], down) if n <= PIECE else (_powers(HASH_BASE, n), down)  # one long word begins at 0
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[low : low + n]] * powers, out=sums[1:])
        first, last = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))
        at = to
    return out, starts


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of some texts one after the other, each text's words and then its end token; and how many each text has."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    after = np.cumsum([len(x) + 1 for x in raw])
    words, starts = word_hashes(b"\n".join(raw))
    of = np.searchsorted(after, starts, side="right")
    sizes = np.bincount(of, minlength=len(raw)) + 1
    tokens = np.full(len(words) + len(raw), END, np.uint64)
    tokens[np.arange(len(words)) + of] = words
    return tokens, sizes


def bigrams(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash for each token with the one before it; the first of each text follows a start token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = np.uint64(0x5354415254)
    return mix(before * _GOLD + mix(tokens))


def quantise(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_BASE count), exactly: by the powers themselves."""
    return np.searchsorted(_POWERS, counts, side="right").astype(np.uint8)


_POWERS = np.array([math.ceil(BASE**j - 1e-9) for j in range(100)], dtype=np.float64)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))


def _runs(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, tokens, sizes) of runs of texts that have some CHARS characters, or one text."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHARS or i == len(texts) - 1:
            yield at, *tokens_of(texts[at : i + 1])
            at, held = i + 1, 0


def _counter(shard_bits: int):
    names = ["shard", "size", "keys", "counts"]

    def emit(kept: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for size, parts in kept.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            edges = shard_edges(keys, shard_bits)
            rows = [(s, size, pack(keys[a:b]), pack(counts[a:b].astype("<u4"))) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[np.ndarray]] = {1: [], 2: []}
        held = 0
        for batch in slices(batches, 2048):
            for _, tokens, sizes in _runs(batch.column("text").to_pylist()):
                kept[1].append(tokens)
                kept[2].append(bigrams(tokens, sizes))
                held += len(tokens)
                if held >= TOKENS:
                    yield from emit(kept)
                    kept, held = {1: [], 2: []}, 0
        if held:
            yield from emit(kept)

    return run


def blocks(keys: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The block of a key, of ``n``: all bits of a key lie in one block, so that its probes stay in one page of memory."""
    x = mix(keys + _GOLD)
    return (((x >> np.uint64(32)) * np.asarray(n, np.uint64)) >> np.uint64(32)).astype(np.int64)


def draws(keys: np.ndarray, level: int, some: int) -> np.ndarray:
    """The places in its block of DRAWN probes of (key, level), 12 bits each."""
    return mix(keys + np.uint64(int(_GOLD) * (level << 8 | some + 2) & 0xFFFFFFFFFFFFFFFF))


def first_probes(n_words: int, false: float = FALSE) -> int:
    """Probes of level 1, such that of all words, all of them unseen after a context, ``false`` pass on average."""
    return max(PROBES, math.ceil(math.log2(max(1, n_words) / false)))


def build_filter(keys: np.ndarray, q: np.ndarray, first: int = PROBES, more: int = PROBES, load: float = LOAD) -> tuple[np.ndarray, float]:
    """The packed bits of the pairs (key, 1) to (key, q), a share ``load`` of them set, in blocks of BLOCK bits; and the share of keys that are not there and pass."""
    held = first * len(keys) + more * (int(q.sum(dtype=np.int64)) - len(keys))
    n = max(1, math.ceil(held / -math.log(1 - load) / BLOCK))
    flags = np.zeros(n * BLOCK, dtype=bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        own = keys[q >= level]
        base = blocks(own, n) * BLOCK
        for probe in range(first if level == 1 else more):
            some, k = divmod(probe, DRAWN)
            if k == 0:
                drawn = draws(own, level, some)
            flags[base + (drawn >> np.uint64(12 * k) & np.uint64(BLOCK - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little"), float((flags.reshape(n, BLOCK).mean(axis=1) ** first).mean())


SHARD = "shard int, first int, more int, false double, filter binary, words binary, counts binary, n_tokens long, n_words long, bin_sizes array<long>, bin_counts array<long>"


def _summed(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    keys = np.concatenate([np.zeros(0, "<u8"), *(unpack(k, "<u8") for k, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(unpack(c, "<u4").astype(np.int64) for _, c in parts)])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _build_shard(shard: int, parts: dict[int, list[tuple[bytes, bytes]]], shard_bits: int, false: float, more: int, load: float) -> pa.RecordBatch:
    """Sum the counts of one shard; its filter, its exact word counts, and per size and bin the n-grams and their counts."""
    merged = {size: _summed(parts.get(size, [])) for size in (1, 2)}
    q = {size: quantise(counts) for size, (_, counts) in merged.items()}
    first = first_probes(len(merged[1][0]) << shard_bits, false)  # words are dealt evenly over the shards
    held, passing = build_filter(np.concatenate([merged[1][0], mix(merged[2][0])]), np.concatenate([q[1], q[2]]), first, more, load)
    sizes = np.concatenate([np.bincount(q[s], minlength=len(_POWERS) + 1) for s in (1, 2)])
    sums = np.concatenate([np.bincount(q[s], weights=merged[s][1], minlength=len(_POWERS) + 1).astype(np.int64) for s in (1, 2)])
    words, counts = merged[1]
    packed = counts.astype("<u4" if counts.max(initial=0) < 1 << 32 else "<u8").tobytes()
    row = [shard, first, more, passing, held.tobytes(), words.tobytes(), packed, int(counts.sum()), len(words), sizes.tolist(), sums.tolist()]
    kinds = [*[pa.int32()] * 3, pa.float64(), *[pa.binary()] * 3, *[pa.int64()] * 2, *[pa.list_(pa.int64())] * 2]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[x.split()[0] for x in SHARD.split(", ")])


def _builder(shard_bits: int, false: float, more: int, load: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by shard to a row for each shard."""
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "size", "keys", "counts"))))
        for shard, own in itertools.groupby(rows, key=lambda row: row[0]):
            parts: dict[int, list[tuple[bytes, bytes]]] = {}
            for _, size, keys, counts in own:
                parts.setdefault(size, []).append((keys, counts))
            yield _build_shard(shard, parts, shard_bits, false, more, load)

    return run


class Slice:
    """Some shards of the model: word counts and quantised n-gram counts of hashes that fall into them."""

    def __init__(self, rows: list, shard_bits: int):
        rows = sorted(rows, key=lambda r: r["shard"])
        n = 1 << shard_bits
        self.shift = np.uint64(64 - shard_bits)
        self.blocks, self.at, self.first, self.more = (np.zeros(n, np.int64) for _ in range(4))
        filters = [np.frombuffer(r["filter"], "<u8") for r in rows]
        ends = np.cumsum([len(f) for f in filters])
        for r, f, end in zip(rows, filters, ends):
            self.blocks[r["shard"]], self.at[r["shard"]] = len(f) * 64 // BLOCK, end - len(f)
            self.first[r["shard"]], self.more[r["shard"]] = r["first"], r["more"]
        self.filter = np.concatenate([np.zeros(0, "<u8"), *filters])
        words = [np.frombuffer(r["words"], "<u8") for r in rows]
        self.words = np.concatenate([np.zeros(0, "<u8"), *words])
        self.counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], f"<u{len(r['counts']) // max(1, len(w))}" if len(w) else "<u4") for r, w in zip(rows, words))])

    def word_counts(self, keys: np.ndarray) -> np.ndarray:
        """Exact training counts of sorted word hashes."""
        if not len(self.words):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.counts[at], 0).astype(np.int64)

    def levels(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Quantised counts of n-grams, by membership probes; ``hashes`` name the shards, ``keys`` are probed."""
        out = np.zeros(len(keys), dtype=np.uint8)
        shard = (hashes >> self.shift).astype(np.int64)
        active = np.flatnonzero(self.blocks[shard])
        keys, shard = keys[active], shard[active]
        base = self.at[shard] + blocks(keys, self.blocks[shard]) * (BLOCK // 64)
        for level in range(1, len(_POWERS)):
            needed = (self.first if level == 1 else self.more)[shard]
            if not len(active):
                break
            least, most = int(needed.min()), int(needed.max())
            alive = np.ones(len(keys), np.uint64)
            for probe in range(most):
                some, k = divmod(probe, DRAWN)
                if k == 0:
                    drawn = draws(keys, level, some)
                place = drawn >> np.uint64(12 * k) & np.uint64(BLOCK - 1)
                bit = self.filter[base + (place >> np.uint64(6)).view(np.int64)] >> (place & np.uint64(63))
                if probe >= least:
                    bit |= (needed <= probe).astype(np.uint64)
                alive &= bit
                if probe in (1, 3) or probe == most - 1:
                    stay = alive != 0
                    if probe == most - 1 or np.count_nonzero(stay) < 0.8 * len(stay):
                        active, keys, shard, base, needed, drawn, alive = (x[stay] for x in (active, keys, shard, base, needed, drawn, alive))
            out[active] = level
        return out


class Totals:
    """What the shards' sums say of the whole model."""

    def __init__(self, n_tokens: int, n_words: int, sizes: np.ndarray, sums: np.ndarray, false_rate: float = 0.0):
        self.n_tokens, self.n_words, self.false_rate = n_tokens, n_words, false_rate
        mean = np.divide(sums, sizes, out=np.zeros(len(sums)), where=sizes > 0)
        self.mean = mean.reshape(2, -1)  # mean count by size and level
        filled = np.maximum.accumulate(np.where(self.mean > 0, self.mean, 0), axis=1)
        self.mean = np.where(self.mean > 0, self.mean, filled)  # levels that only false positives reach
        words, pairs = sizes[: len(sizes) // 2], sizes[len(sizes) // 2 :]
        self.z = float((self.mean[0] * words).sum() + n_words + 1)
        self.start_level = 0
        once, twice = int(pairs[1]), int(pairs[2])  # the bins of counts 1 and 2 hold these alone
        self.discount = min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5
        low, high = 0.0, 1.0
        for _ in range(60):
            self.power = (low + high) / 2
            low, high = (self.power, high) if (words[1:] * self.mean[0][1:] ** self.power).sum() < pairs.sum() else (low, self.power)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _look_up(part: Slice, tokens: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Rows: exact word counts, levels of words, levels of bigrams. Distinct n-grams are probed in order, shard by shard."""
    distinct, back = np.unique(tokens, return_inverse=True)
    out = np.empty((3, len(tokens)), dtype=np.int64)
    out[0] = part.word_counts(distinct)[back]
    out[1] = part.levels(distinct, distinct)[back]
    distinct, back = np.unique(pairs, return_inverse=True)
    out[2] = part.levels(mix(distinct), distinct)[back]
    return out


def _scores(found: np.ndarray, sizes: np.ndarray, totals: Totals) -> list[np.ndarray]:
    """Per text: known tokens, base score, model score."""
    count, own, pair = found
    base = np.log10((count + 1) / (totals.n_tokens + totals.n_words + 1))
    p = (totals.mean[0][own] + 1) / totals.z
    starts = np.cumsum(sizes) - sizes
    context = np.empty(len(own), dtype=np.int64)
    context[1:] = own[:-1]
    context[starts] = totals.start_level
    c = totals.mean[0][context]
    both = np.where((own > 0) & (context > 0), np.minimum(np.minimum(totals.mean[1][pair], c), totals.mean[0][own]), 0.0)
    c, d = np.maximum(c, 1.0), totals.discount
    types = c**totals.power
    follows = np.maximum(both - d, 0.0) / c + d * types / c * p
    follows /= 1 + totals.false_rate * np.maximum(totals.n_words - types, 0.0) * (1 - d) / c
    model = np.log10(np.where(context > 0, follows, p))
    return [np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64), base, model)]


def _scored(ids: pa.Array, held: pa.Array, found: np.ndarray, sizes: np.ndarray, totals: Totals) -> pa.RecordBatch:
    known, base, model = _scores(found, sizes, totals)
    n = np.full(len(sizes), totals.n_tokens, dtype=np.int64)
    columns = [ids, held, pa.array(sizes), pa.array(known), pa.array(n), pa.array(base), pa.array(model)]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCORES.split(", ")])


def _scorer(part, totals: Totals):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = part.value
        for batch in slices(batches):
            for at, tokens, sizes in _runs(batch.column("text").to_pylist()):
                ids, held = (batch.column(c).slice(at, len(sizes)) for c in ("doc_id", "held_out"))
                yield _scored(ids, held, _look_up(own, tokens, bigrams(tokens, sizes)), sizes, totals)

    return run


#: Kinds of keys that runs of texts ask shards for: words and pairs of words; and the answers.
WORD, PAIR = 1, 2
ANSWER = {WORD: np.dtype([("count", "<i8"), ("level", "u1")]), PAIR: np.dtype([("level", "u1")])}


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, bigrams, sizes of all texts."""
    runs = [(tokens, bigrams(tokens, sizes), sizes) for _, tokens, sizes in _runs(texts)]
    return tuple(np.concatenate([np.zeros(0, kind), *own]) for kind, own in zip((np.uint64, np.uint64, np.int64), zip(*runs) if runs else ((), (), ())))


def _keys(texts: list[str]) -> dict[int, np.ndarray]:
    tokens, pairs, _ = _tokens(texts)
    return {WORD: np.unique(tokens), PAIR: np.unique(pairs)}


def _prepare(texts: list[str]) -> tuple[dict[int, np.ndarray], tuple]:
    tokens, pairs, sizes = _tokens(texts)
    (words, of_token), (both, of_pair) = (np.unique(x, return_inverse=True) for x in (tokens, pairs))
    return {WORD: words, PAIR: both}, (of_token, of_pair, sizes)


def _answer(shard_bits: int):
    def held(rows: list[dict]):
        part = Slice(rows, shard_bits)

        def answer(kind: int, keys: np.ndarray) -> np.ndarray:
            out = np.zeros(len(keys), ANSWER[kind])
            if kind == WORD:
                out["count"] = part.word_counts(keys)
            out["level"] = part.levels(keys if kind == WORD else mix(keys), keys)
            return out

        return answer

    return held


def _finish(totals: Totals):
    def finish(docs: pa.Table, found: Found, kept: tuple) -> pa.Table:
        ids, held = (docs.column(c).combine_chunks() for c in ("doc_id", "held_out"))
        of_token, of_pair, sizes = kept
        word, pair = found[WORD][1][of_token], found[PAIR][1][of_pair]
        rows = np.stack([word["count"], word["level"].astype(np.int64), pair["level"].astype(np.int64)])
        return pa.Table.from_batches([_scored(ids, held, rows, sizes, totals)])

    return finish


def build(docs: DataFrame, shard_text: int = SHARD_TEXT, false: float = FALSE, probes: int = PROBES, load: float = LOAD) -> tuple[DataFrame, Totals, int]:
    """The model of the training documents: its shards, a written table; its totals; the bits that name a shard."""
    rows = _documents(docs)
    n_bytes, n_train = rows.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    shard_bits = max(2, math.ceil(math.log2(max(1, (n_bytes or 0) / shard_text))))
    train = rows.where(~F.col("held_out")).select("text")
    counted = train.mapInArrow(_counter(shard_bits), "shard int, size int, keys binary, counts binary")
    tasks = min(1 << shard_bits, BUILDERS)
    dealt = counted.repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions("shard")
    shards = materialize(dealt.mapInArrow(_builder(shard_bits, false, probes, load), SHARD), "shards")
    sums = shards.select("n_tokens", "n_words", F.posexplode(F.arrays_zip("bin_sizes", "bin_counts")).alias("k", "x"))
    bins = sums.groupBy("k").agg(F.sum("x.bin_sizes").alias("sizes"), F.sum("x.bin_counts").alias("sums")).orderBy("k").collect()
    sums = [F.coalesce(x, F.lit(0)) for x in (F.sum("n_tokens"), F.sum("n_words"), F.avg("false"))]
    n_tokens, n_words, false_rate = shards.agg(*sums).first()
    width = 2 * (len(_POWERS) + 1)
    sizes, counts = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for r in bins:
        sizes[r["k"]], counts[r["k"]] = r["sizes"], r["sums"]
    totals = Totals(n_tokens, n_words, sizes, counts, false_rate)
    totals.start_level = int(quantise(np.array([n_train]))[0]) if n_train else 0
    return shards, totals, shard_bits


def score(docs: DataFrame, shard_text: int = SHARD_TEXT, model_bytes: int | None = None, false: float = FALSE, probes: int = PROBES, load: float = LOAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per document.

    A model of more than ``model_bytes`` (by default PART of :func:`brindle.llm.work.broadcast_bytes`) is not broadcast but probed in its shards."""
    spark = docs.sparkSession
    shards, totals, shard_bits = build(docs, shard_text, false, probes, load)
    shards = shards.select("shard", "first", "more", "filter", "words", "counts")
    size = F.octet_length("filter") + F.octet_length("words") + F.octet_length("counts")
    held = shards.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    if held > (PART * broadcast_bytes(spark) if model_bytes is None else model_bytes):
        rows = _documents(docs)
        runs = with_runs(rows, rows.agg(F.sum(F.char_length("text").cast("long"))).first()[0])
        return materialize(look_up(runs, _prepare, shards, shard_bits, _answer(shard_bits), ANSWER, _finish(totals), SCORES, _keys), "scores")
    part = spark.sparkContext.broadcast(Slice(list(shards.toLocalIterator()), shard_bits))
    rows = materialize(_documents(docs).mapInArrow(_scorer(part, totals), SCORES), "scores")
    part.unpersist()
    return rows
