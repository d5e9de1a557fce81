"""Quality rules: simple text counts, and language-specific bands on n-gram perplexity.

One modified Kneser-Ney model of four-grams of characters, whatever their script: code points as they are, but all digits as one. Spark
counts the n-grams of all whole texts and smooths the counts (Chen and Goodman 1998: three discounts an order from the counts of
counts, continuation counts below the highest order). Probabilities and back-off weights are kept in arrays sorted by hash, in
shards by the hashes' leading bits. Shards that fit what a worker may hold are broadcast; those of a larger
model stay where they are, and runs of texts send them their distinct n-grams (see :mod:`brindle.llm.lookup`).

Characters rather than words: texts without spaces have no words to count, and each text of this corpus has words of its own. One model
rather than one a language, since texts mix languages; the bands make it language-specific.

A text has a log perplexity per word and one per character. Each must lie in its band: the median of all texts of its language and
script, give or take BAND robust deviations for the text's number of words, or for SPAN if it has more. The language is the table's, whatever its value; the
script is that of most of the text's letters, by their Unicode names; texts without letters have their whole language's band.
Medians and deviations come from histograms over all texts that pass the base rules, whose size grows only with the logarithm of the largest
value, to one part in BINS.

Cases: a null text has no words and fails the base rules. Every value of the language has bands, and so has null. Rows
that repeat stay rows of their own. A band without any text that passes the base rules rejects nothing; one of fewer than FEW texts has its
own medians, and deviations of at least those of all texts. A very long text is scored in segments, but its words are held
by one task for the base rules, some 100 bytes each. An empty table gives an empty result. Other columns are ignored
by :func:`judge` and returned by :func:`keep_good`.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.lookup import Found, look_up, with_runs
from brindle.llm.work import BROADCAST_ROWS, broadcast_bytes, held, keep_rows, materialize, slices

ORDER = 4
#: Bits of a code point: codes of three characters fit 63.
BITS = 21
LOW = [(1 << BITS * k) - 1 for k in range(ORDER)]
#: Characters counted as symbols by the base rules.
BASE_SYMBOLS = "#*$%&|<>"
#: Base rules: fewest words, largest share (in percent) of words in repeated windows, words of a window.
MIN_WORDS, MAX_REPEAT, WINDOW = 10, 20, 5
#: Robust deviations that a log perplexity may lie below and above its band's median.
BAND = 4.0
#: Texts of more words deviate as texts of so many do: however long a text is, what it is about moves its mean.
SPAN = 2000
#: A band of fewer texts deviates at least as all texts do from their bands' medians.
FEW = 30
#: A bin of the histograms is one BINS-th of its value wide, but for values far below FINE, whose bins are one BINS-th of FINE. No value is
#: too large for a bin of its own.
BINS, FINE = 2000, 1 / 64
#: Characters scored at once, and distinct four-grams counted before they are passed on.
CHARS, HELD = 1_000_000, 1_000_000
#: Entries of the model a shard.
SHARD_ENTRIES = 1_000_000
#: What stands before a text.
START = "\n" * (ORDER - 1)

_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """The four-gram that ends at each character of some texts: its first character and the code of the other three."""

    def __init__(self, segments: list[tuple[int, str, str]]):
        """``segments``: (text, the three characters before, characters)."""
        sizes = np.array([len(s) for _, _, s in segments], dtype=np.int64)
        joined = "".join([before + s for _, before, s in segments])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.points = np.where((points >= 48) & (points <= 57), 48, points).astype(np.uint64)
        own = np.ones(len(points), dtype=bool)
        starts = np.cumsum(sizes + ORDER - 1) - sizes - ORDER + 1
        for k in range(ORDER - 1):
            own[starts + k] = False
        at = np.flatnonzero(own)
        x = self.points
        self.head = x[at - 3]
        self.rest = x[at - 2] << np.uint64(2 * BITS) | x[at - 1] << np.uint64(BITS) | x[at]
        self.last = x[at]
        self.text = np.repeat(np.array([k for k, _, _ in segments], dtype=np.int64), sizes)


def runs(texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
    """Segments of the texts in lists of some CHARS characters: a long text in several, each with the characters before it."""
    run: list[tuple[int, str, str]] = []
    held = 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), CHARS):
            part = text[at : at + CHARS]
            if run and held + len(part) > CHARS:
                yield run
                run, held = [], 0
            run.append((k, text[at - ORDER + 1 : at] if at else START, part))
            held += len(part)
    if run:
        yield run


def mix(order: int, head: np.ndarray | int, rest: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams; below the highest order, which has no ``head``, equal hashes of an order mean equal n-grams."""
    x = rest.astype(np.uint64) * _GOLD + np.uint64(order)
    if order == ORDER:
        x = _scramble(x) + head * np.uint64(0xC2B2AE3D27D4EB4F)
    return _scramble(x)


def _scramble(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def distinct(grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct four-grams as (hash, head, rest), sorted by hash, and the number of each place's."""
    h = mix(ORDER, grams.head, grams.rest)
    order = np.argsort(h)
    sorted_h = h[order]
    new = np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]]) if len(h) else np.zeros(0, bool)
    back = np.empty(len(h), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    first = order[new]
    return sorted_h[new], grams.head[first], grams.rest[first], back


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scripts()  # other operators' models go
    kept: list[tuple[np.ndarray, ...]] = []

    def merged() -> tuple[np.ndarray, ...]:
        h, head, rest, n = (np.concatenate(c) for c in zip(*kept))
        order = np.argsort(h)
        starts = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        return h[order][starts], head[order][starts], rest[order][starts], np.add.reduceat(n[order], starts)

    def out() -> pa.RecordBatch:
        _, head, rest, n = kept[0]
        return pa.RecordBatch.from_arrays([pa.array(head.astype(np.int64)), pa.array(rest.astype(np.int64)), pa.array(n)], names=["head", "rest", "n"])

    for batch in slices(batches):
        for run in runs(batch.column("text").to_pylist()):
            h, head, rest, back = distinct(Grams(run))
            kept.append((h, head, rest, np.bincount(back, minlength=len(h))))
            if sum(len(x[0]) for x in kept) > 2 * HELD:
                kept = [merged()]
                if len(kept[0][0]) > HELD:
                    yield out()
                    kept = []
    if kept:
        kept = [merged()]
        yield out()


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(head, rest, n): how often each four-gram occurs, over all whole texts."""
    counted = _texts(docs).select("text").mapInArrow(_counter, "head long, rest long, n long")
    return counted.groupBy("head", "rest").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The discounts of counts 1, 2 and more, from the counts of counts; one half, where these are too few to tell."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1))


def _orders(counts: DataFrame) -> dict[int, DataFrame]:
    """(head, rest, n) by order: below the highest, ``n`` is the number of distinct characters before an n-gram."""
    out = {ORDER: counts.select("head", "rest", "n")}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("rest").bitwiseAND(F.lit(LOW[k])) if k < ORDER - 1 else F.col("rest")
        out[k] = out[k + 1].groupBy(shorter.alias("rest")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).cast("long").alias("head"), "rest", "n")
    return out


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, float]:
    """(order, head, rest, logp, back) of all n-grams seen and of all contexts: log10 probabilities, and log10 of the weight that an
    n-gram, as a context, leaves to the next shorter one; and the log10 probability of a character never seen."""
    orders = _orders(counts)
    stats = [x.agg(F.count(F.lit(1)), *(F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)), F.sum("n")).withColumn("k", F.lit(k)) for k, x in orders.items()]
    found = {r["k"]: tuple(r)[:6] for r in functools.reduce(DataFrame.unionByName, [x.toDF("types", "n1", "n2", "n3", "n4", "total", "k") for x in stats]).collect()}
    cuts = {k: discounts(*found[k][1:5]) for k in orders}
    types, n1, n2, _, _, total = found[1]
    rest_weight = (cuts[1][0] * n1 + cuts[1][1] * n2 + cuts[1][2] * (types - n1 - n2)) / total
    root = rest_weight / (types + 1)
    entries, lower = [], None
    for k in range(1, ORDER + 1):
        d = [F.lit(float(x)) for x in cuts[k]]
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        if k == 1:
            p = orders[1].select("head", "rest", ((F.col("n") - cut) / total + root).alias("p"))
        else:
            context = F.shiftright("rest", BITS) if k < ORDER else F.shiftleft("head", 2 * BITS) + F.shiftright("rest", BITS)
            rows = orders[k].withColumn("context", context).withColumn("cut", cut)
            weight = rows.groupBy(F.col("context").alias("c_context")).agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight"))
            backs = weight.select(F.col("c_context").alias("b_rest"), F.log10("weight").alias("back"))
            joined = entries[-1].join(backs, F.col("rest") == F.col("b_rest"), "full")
            entries[-1] = joined.select(F.coalesce("head", F.lit(0).cast("long")).alias("head"), F.coalesce("rest", "b_rest").alias("rest"), "p", "back")
            short = F.col("rest").bitwiseAND(F.lit(LOW[k - 1])) if k < ORDER else F.col("rest")
            shorter = lower.select(F.col("rest").alias("l_rest"), F.col("p").alias("l_p"))
            p = rows.withColumn("short", short).join(weight, F.col("context") == F.col("c_context")).join(shorter, F.col("short") == F.col("l_rest"))
            p = p.select("head", "rest", ((F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * F.col("l_p")).alias("p"))
        lower = p
        entries.append(p)
    entries[-1] = entries[-1].withColumn("back", F.lit(0.0))
    table = [x.select(F.lit(k).alias("order"), "head", "rest", F.log10("p").alias("logp"), F.coalesce("back", F.lit(0.0)).alias("back")) for k, x in enumerate(entries, 1)]
    return functools.reduce(DataFrame.unionByName, table), math.log10(root)


MODEL = "shard int, hashes binary, logp binary, back binary, n long"


def _hasher(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, head, rest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("order", "head", "rest"))
            h = np.empty(len(order), dtype=np.uint64)
            for k in range(1, ORDER + 1):
                own = order == k
                h[own] = mix(k, head[own].astype(np.uint64), rest[own])
            shard = (h >> np.uint64(64 - bits)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(h.view(np.int64)), batch.column("logp"), batch.column("back")], names=["shard", "hash", "logp", "back"])

    return run


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and hash to a row of arrays for each shard. A context that was never an n-gram has no probability: NaN."""
    kept: list[tuple[np.ndarray, ...]] = []

    def out() -> pa.RecordBatch:
        _, h, logp, back = (np.concatenate(c) for c in zip(*kept))
        row = [int(kept[0][0][0]), h.view(np.uint64).tobytes(), logp.astype("<f4").tobytes(), back.astype("<f4").tobytes(), len(h)]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[x.split()[0] for x in MODEL.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "hash", "logp", "back")]
        edges = np.flatnonzero(np.concatenate([[True], columns[0][1:] != columns[0][:-1], [True]]))
        for a, b in zip(edges, edges[1:]):
            if kept and kept[-1][0][0] != columns[0][a]:
                yield out()
                kept = []
            kept.append(tuple(c[a:b] for c in columns))
    if kept:
        yield out()


class Model:
    """N-grams in arrays sorted by hash: log10 of their probabilities (NaN where only the context is known) and back-off weights."""

    def __init__(self, rows: list[dict], root: float):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.hashes = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(r["hashes"], "<u8") for r in rows)])
        self.logp = np.concatenate([np.zeros(0, "<f4"), *(np.frombuffer(r["logp"], "<f4") for r in rows)])
        self.back = np.concatenate([np.zeros(0, "<f4"), *(np.frombuffer(r["back"], "<f4") for r in rows)])
        self.root = root

    def find(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logp, back) of n-grams; NaN and 0 for those not there."""
        if not len(self.hashes):
            return np.full(len(hashes), np.nan), np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        there = self.hashes[at] == hashes
        return np.where(there, self.logp[at], np.nan), np.where(there, self.back[at], 0.0)


Find = Callable[[int, np.ndarray], tuple[np.ndarray, np.ndarray]]


def score_grams(head: np.ndarray, rest: np.ndarray, find: Find, root: float) -> np.ndarray:
    """log10 probability of the last character of each four-gram after its first three."""
    out = np.zeros(len(head))
    left = np.arange(len(head))
    for k in range(ORDER, 0, -1):
        own = rest[left] & np.uint64(LOW[k]) if k < ORDER - 1 else rest[left]
        logp, _ = find(k, mix(k, head[left], own))
        there = ~np.isnan(logp)
        out[left[there]] += logp[there]
        left = left[~there]
        if not len(left):
            return out
        if k > 1:
            out[left] += find(k - 1, mix(k - 1, 0, _context(k, head[left], rest[left])))[1]
    out[left] += root
    return out


def _context(k: int, head: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The first k - 1 characters of the last k, as a code."""
    if k == ORDER:
        return head << np.uint64(2 * BITS) | rest >> np.uint64(BITS)
    return (rest & np.uint64(LOW[k]) if k < ORDER - 1 else rest) >> np.uint64(BITS)


def build_model(docs: DataFrame) -> tuple[DataFrame, float, int] | None:
    """The shards of the model of all texts, a written table; its root; the bits that name a shard. None without texts."""
    counts = materialize(count_ngrams(docs), "ngrams", small=True)
    n = counts.count()
    if not n:
        return None
    entries, root = kneser_ney(counts)
    bits = max(1, math.ceil(math.log2(max(1, n / SHARD_ENTRIES))))
    hashed = entries.mapInArrow(_hasher(bits), "shard int, hash long, logp double, back double")
    dealt = hashed.repartitionById(1 << bits, F.col("shard")).sortWithinPartitions("shard", "hash")
    return materialize(dealt.mapInArrow(_arrays, MODEL), "model"), root, bits


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_symbols = sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    word_chars = len(text) - sum(map(raw.count, (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")))
    dup_lines = 0
    if b"\n" in raw:
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        dup_lines = len(lines) - len(set(lines))
    return len(words), word_chars, n_symbols, dup_lines, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that are found twice or more. Hashes nominate windows, the words decide."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    w = h[:n].copy()
    for k in range(1, WINDOW):
        w *= np.uint64(0x9E3779B97F4A7C15)
        w += h[k : k + n]
    order = np.sort(w)
    if not (order[1:] == order[:-1]).any():
        return 0
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    at = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, w), len(twice) - 1)] == w).tolist()
    seen: dict[tuple, list[int]] = {}
    for i in at:
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for places in seen.values():
        if len(places) > 1:
            np.add.at(covered, places, 1)
            np.add.at(covered, [p + WINDOW for p in places], -1)
    return int((np.cumsum(covered) > 0).sum())


def _scripts() -> tuple[np.ndarray, list[str | None]]:
    numbers: dict[str | None, int] = {None: 0}
    table = np.zeros(0x110000, dtype=np.uint16)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            name = unicodedata.name(c, "").split(" ")[0]
            table[point] = numbers.setdefault(name, len(numbers))
    return table, list(numbers)


def scripts() -> tuple[np.ndarray, list[str | None]]:
    """A number for each code point, and what they stand for: the first word of a letter's name, None for what is no letter."""
    return held(("quality",), _scripts)


SCORED = (
    "rid long, doc_id long, tag long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, per_word double, per_char double"
)
MEASURES = ("per_word", "per_char")


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"),
        F.col("lang").cast("string").alias("lang"), text.alias("text"),
    )


def _judged(batch: pa.RecordBatch | pa.Table, find: Find, root: float) -> list[pa.Array]:
    """The columns of SCORED for some documents."""
    texts = batch.column("text").to_pylist()
    table, names = scripts()
    total, letters = np.zeros(len(texts)), np.zeros((len(texts), len(names)), dtype=np.int64)
    for run in runs(texts):
        grams = Grams(run)
        _, head, rest, back = distinct(grams)
        first, last = run[0][0], run[-1][0] + 1
        total[first:last] -= np.bincount(grams.text - first, weights=score_grams(head, rest, find, root)[back], minlength=last - first)
        which = (grams.text - first) * len(names) + table[grams.last]
        letters[first:last] += np.bincount(which, minlength=(last - first) * len(names)).reshape(-1, len(names))
    letters[:, 0] = 0
    most = [names[k] for k in letters.argmax(axis=1)]
    n_chars = np.array([len(t) for t in texts], dtype=np.int64)
    base = np.array([base_counts(t) for t in texts], dtype=np.int64).reshape(-1, 5)
    columns = [batch.column(c) for c in ("rid", "doc_id", "tag", "lang")] + [pa.array(most, pa.string())]
    return columns + [pa.array(base[:, k]) for k in range(5)] + [pa.array(total / np.maximum(n, 1)) for n in (base[:, 0], n_chars)]


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(_judged(batch, own.find, own.root), names=[x.split()[0] for x in SCORED.split(", ")])

    return run


#: What runs of texts ask the shards for, by order.
ANSWER = dict.fromkeys(range(1, ORDER + 1), np.dtype([("logp", "<f4"), ("back", "<f4")]))


def _prepare(texts: list[str]) -> tuple[dict[int, np.ndarray], None]:
    """The hashes of all n-grams and contexts that scoring may look for."""
    kept: dict[int, list[np.ndarray]] = {k: [] for k in ANSWER}
    for run in runs(texts):
        h, head, rest, _ = distinct(Grams(run))
        kept[ORDER].append(h)
        for k in range(1, ORDER):
            own = rest & np.uint64(LOW[k]) if k < ORDER - 1 else rest
            kept[k] += [np.unique(mix(k, 0, own)), np.unique(mix(k, 0, _context(k + 1, head, rest)))]
    return {k: np.unique(np.concatenate([np.zeros(0, np.uint64), *own])) for k, own in kept.items()}, None


def _answer(rows: list[dict]):
    own = Model(rows, 0.0)

    def answer(order: int, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), ANSWER[order])
        out["logp"], out["back"] = own.find(order, hashes)
        return out

    return answer


def _finish(root: float):
    def finish(docs: pa.Table, found: Found, _: None) -> pa.Table:
        def find(order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keys, values = found[order]
            own = values[np.searchsorted(keys, hashes)]
            return own["logp"].astype(float), own["back"].astype(float)

        return pa.Table.from_arrays(_judged(docs, find, root), names=[x.split()[0] for x in SCORED.split(", ")])

    return finish


def score(docs: DataFrame, model_bytes: int | None = None) -> DataFrame:
    """The base rules' counts and the measures of every document, a written table. A model of more than ``model_bytes`` (by default
    :func:`brindle.llm.work.broadcast_bytes`) is not broadcast but asked in its shards."""
    spark, built = docs.sparkSession, build_model(docs)
    if built is None:
        shards, root, bits, size = None, 0.0, 1, 0
    else:
        shards, root, bits = built
        size = 16 * shards.agg(F.sum("n")).first()[0]
    if size > (broadcast_bytes(spark) if model_bytes is None else model_bytes):
        rows = _texts(docs)
        docs_in_runs = with_runs(rows, rows.agg(F.sum(F.char_length("text").cast("long"))).first()[0])
        return materialize(look_up(docs_in_runs, _prepare, shards, bits, _answer, ANSWER, _finish(root), SCORED), "scored")
    rows = list(shards.toLocalIterator()) if shards is not None else []
    model = spark.sparkContext.broadcast(Model(rows, root))
    del rows
    scored = materialize(_texts(docs).mapInArrow(_scorer(model), SCORED), "scored")
    model.destroy()
    return scored


def base_failed() -> Column:
    """The base rules on their counts."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def _histogram(values: DataFrame, column: Column) -> DataFrame:
    """(lang, script, measure, bin, n): some BINS rows for each factor of e between a band's values. A null script stands for all of the
    language."""
    binned = values.select("lang", "script", "measure", F.floor(F.log1p(column / FINE) * BINS).alias("bin"))
    return binned.groupBy("lang", "script", "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def _middle(histogram: DataFrame, *keys: str) -> DataFrame:
    """(keys, texts, middle): the median of each histogram, to one BINS-th."""
    own = Window.partitionBy(*keys)
    ranked = histogram.withColumn("below", F.sum("n").over(own.orderBy("bin"))).withColumn("texts", F.sum("n").over(own))
    return ranked.where("2 * below >= texts").groupBy(*keys, "texts").agg((F.expm1((F.min("bin") + 0.5) / BINS) * FINE).alias("middle"))


def _with_bands(rows: DataFrame, bands: DataFrame, measure: bool = False) -> DataFrame:
    """``rows`` with the columns of ``bands`` (b_lang, b_script, ...), a written table, which is broadcast unless it is large."""
    side = F.broadcast(bands) if bands.count() <= BROADCAST_ROWS else bands
    met = F.col("lang").eqNullSafe(F.col("b_lang")) & F.col("script").eqNullSafe(F.col("b_script"))
    keys = ["b_lang", "b_script"] + ["b_measure"] * measure
    return rows.join(side, met & (F.col("measure") == F.col("b_measure")) if measure else met, "left").drop(*keys)


def find_bands(scored: DataFrame) -> DataFrame:
    """(b_lang, b_script, then median and deviation of each measure). A deviation is that of a text of one word."""
    own = F.when(F.col("script").isNull(), F.array(F.col("script"))).otherwise(F.array(F.col("script"), F.lit(None).cast("string")))
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES)))
    good = scored.where(~base_failed()).select("lang", "n_words", values.alias("x"), F.explode(own).alias("script"))
    good = good.select("lang", "script", "n_words", "x.measure", "x.value")
    keys = ["lang", "script", "measure"]
    mid = _middle(_histogram(good, F.col("value")), *keys).select(*(F.col(c).alias(f"b_{c}") for c in keys), F.col("middle").alias("mid"))
    mid = materialize(mid, "medians", small=True)
    spread = _histogram(_with_bands(good, mid, True), F.abs(F.col("value") - F.col("mid")) * F.sqrt(F.least("n_words", F.lit(SPAN))))
    whole = spread.where(F.col("script").isNull()).groupBy("measure", "bin").agg(F.sum("n").alias("n"))  # each text once
    every = _middle(whole, "measure").select(F.col("measure").alias("e_measure"), F.col("middle").alias("every"))
    dev = 1.4826 * F.when(F.col("texts") < FEW, F.greatest("middle", "every")).otherwise(F.col("middle"))
    devs = _middle(spread, *keys).join(F.broadcast(every), F.col("measure") == F.col("e_measure")).withColumn("dev", dev)
    both = _with_bands(devs, mid, True)
    columns = [F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}") for m in MEASURES for c in ("mid", "dev")]
    return materialize(both.groupBy(F.col("lang").alias("b_lang"), F.col("script").alias("b_script")).agg(*columns), "bands", small=True)


def judge(docs: DataFrame, model_bytes: int | None = None) -> DataFrame:
    """(doc_id, tag, counts, measures and their bands, base_failed, kept), a row per document."""
    scored = score(docs, model_bytes).withColumn("base_failed", base_failed())
    met = _with_bands(scored, find_bands(scored))
    inside = F.lit(True)
    for m in MEASURES:
        reach = BAND * F.col(f"{m}_dev") / F.sqrt(F.greatest(F.least("n_words", F.lit(SPAN)), F.lit(1)))
        met = met.withColumn(f"{m}_low", F.col(f"{m}_mid") - reach).withColumn(f"{m}_high", F.col(f"{m}_mid") + reach)
        inside = inside & F.coalesce(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))
    return met.withColumn("kept", ~F.col("base_failed") & inside)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return keep_rows(docs, judge(docs), ("lang",))
