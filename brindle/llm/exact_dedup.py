"""Exact duplicate removal by composable polynomial fingerprints.

A text's bytes are hashed as a polynomial modulo two 31-bit primes. The hash of a concatenation follows
from the hashes of its parts, H(a + b) = H(a) * B**len(b) + H(b), so blocks and chunks are hashed apart
and combined by length-shifted sums: within a task for ordinary texts, across tasks for huge ones, whose
chunks are dealt out. Equal fingerprints only nominate copies. Every nominated text is then compared,
chunk by chunk, with one representative of its fingerprint; a text that differs goes to another round
with another representative, until none is left. Results never rest on a hash alone.

Rows equal in both ``doc_id`` and text are one key, however many they are: each row's text meets its group's representative
once, and a representative has one row of text. A row is found again on the second read by its ``doc_id`` and two 64-bit hashes of
its text; should these hold for different texts, the comparison says so and the job fails.

Cases: a null text counts as empty, and all empty texts are copies of each other. A null ``doc_id`` sorts
below every other. Of rows equal in both ``doc_id`` and text exactly one is kept. A very long text is hashed and compared in chunks. An
empty table gives an empty result. Other columns are ignored by :func:`duplicate_groups` and returned by :func:`deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.work import BROADCAST_ROWS, keep_rows, materialize, slices

#: (prime, base) of the two polynomial hashes.
MODULI = ((2147483647, 1000003), (2147483629, 998244353))
#: Bytes of one block, hashed by a product with the powers of the base: 255 * 2**31 * 4096 < 2**53.
BLOCK = 4096
#: Bytes of one comparison chunk, and of one chunk of a huge text.
CHUNK = 1 << 18
#: Texts of more bytes than this are hashed in chunks by several tasks.
HUGE = 1 << 25
#: Members of a group that one representative is compared with, per salt.
PER_SALT = 64


def block_powers(moduli=MODULI) -> np.ndarray:
    """Column m holds base_m ** (BLOCK - 1 - i) mod prime_m, as floats that hold it exactly."""
    out = np.empty((BLOCK, len(moduli)))
    for m, (p, b) in enumerate(moduli):
        x = 1
        for i in range(BLOCK - 1, -1, -1):
            out[i, m] = x
            x = x * b % p
    return out


def combine(left: tuple[int, ...], right: tuple[int, ...], right_len: int, moduli=MODULI) -> tuple[int, ...]:
    """Hashes of a + b from the hashes of a and of b and the length of b."""
    return tuple((x * pow(b, right_len, p) + y) % p for x, y, (p, b) in zip(left, right, moduli))


def hash_bytes(data: bytes, powers: np.ndarray, moduli=MODULI) -> tuple[int, ...]:
    """Polynomial hashes of ``data``: all blocks at once, then their length-shifted combination."""
    n = len(data)
    head = n % BLOCK
    state = (0,) * len(moduli)
    raw = np.frombuffer(data, dtype=np.uint8)
    if head:
        state = tuple(int(x) % p for x, (p, _) in zip(raw[:head].astype(np.float64) @ powers[BLOCK - head :], moduli))
    for at in range(head, n, BLOCK * 256):
        part = raw[at : at + BLOCK * 256].reshape(-1, BLOCK).astype(np.float64) @ powers
        for row in part:
            state = combine(state, tuple(int(x) for x in row), BLOCK, moduli)
    return state


def hash_many(texts: list[bytes], powers: np.ndarray, moduli=MODULI) -> np.ndarray:
    """Hashes of many texts. Texts of one block are padded at their front, where zero bytes do not change
    a polynomial, and hashed in one product; the length beside the hash tells padded texts apart."""
    out = np.zeros((len(texts), len(moduli)), dtype=np.int64)
    primes = np.array([p for p, _ in moduli], dtype=np.float64)
    short = [i for i, t in enumerate(texts) if len(t) <= BLOCK]
    for at in range(0, len(short), 256):
        rows = short[at : at + 256]
        joined = b"".join([texts[i].rjust(BLOCK, b"\0") for i in rows])
        products = np.frombuffer(joined, dtype=np.uint8).reshape(-1, BLOCK).astype(np.float64) @ powers
        out[rows] = np.fmod(products, primes).astype(np.int64)
    for i, t in enumerate(texts):
        if len(t) > BLOCK:
            out[i] = hash_bytes(t, powers, moduli)
    return out


def _fingerprint_batches(moduli):
    """Batches of (..., data) to batches of (..., h0, h1): hashes of each row's bytes, shifted by ``after``,
    the number of bytes that follow it in its text. Null bytes have null hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = block_powers(moduli)
        for batch in slices(batches):
            data = batch.column("data").to_pylist()
            after = batch.column("after").to_pylist()
            absent = np.array([x is None for x in data], dtype=bool)
            hashes = hash_many([x or b"" for x in data], powers, moduli)
            for i, shift in enumerate(after):
                if shift:
                    hashes[i] = [int(h) * pow(b, shift, p) % p for h, (p, b) in zip(hashes[i], moduli)]
            keep = [k for k, n in enumerate(batch.schema.names) if n not in ("data", "after")]
            columns = [batch.column(k) for k in keep] + [pa.array(hashes[:, m], mask=absent) for m in range(len(moduli))]
            names = [batch.schema.names[k] for k in keep] + [f"h{m}" for m in range(len(moduli))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _chunks(df: DataFrame, size: int) -> DataFrame:
    """One row per chunk of ``data`` (an empty text has one): chunk number, its bytes, the bytes after it."""
    count = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / size)).cast("int")
    rest = [c for c in df.columns if c != "data"]
    at = F.col("chunk") * size
    return df.select(*rest, "data", F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk")).select(
        *rest,
        "chunk",
        F.substring("data", at.cast("int") + 1, F.lit(size)).alias("data"),
        F.greatest(F.lit(0).cast("long"), F.col("n_bytes") - at - size).alias("after"),
    )


def _more(text: Column) -> Column:
    """A second hash of a text, which does not depend on the first."""
    return F.xxhash64(F.lit(1), text)


def fingerprints(docs: DataFrame, moduli=MODULI, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """(rid, doc_id, tag, more, n_bytes, text_sha256, h0, h1), a row per document, a written table. ``tag`` and ``more`` are JVM-side hashes
    that, with ``doc_id``, find a row again when the table is read a second time.

    One pass hashes all texts but huge ones, of which it writes a row without hashes. Only if there are any, they are read again and
    their chunks are dealt out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("tag"),
        _more(text).alias("more"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("text_sha256"),
        text.cast("binary").alias("data"),
    )
    schema = "rid long, doc_id long, tag long, more long, n_bytes long, text_sha256 string, " + ", ".join(
        f"h{m} long" for m in range(len(moduli))
    )
    run = _fingerprint_batches(moduli)
    is_huge = F.col("n_bytes") > huge
    first = rows.withColumn("data", F.when(~is_huge, F.col("data"))).withColumn("after", F.lit(0).cast("long"))
    plain = materialize(first.mapInArrow(run, schema), "fingerprints")
    if not plain.where(F.col("h0").isNull()).head(1):
        return plain
    dealt = rows.where(is_huge).withColumn("rid", -1 - F.col("rid"))
    dealt = _chunks(dealt, chunk).repartition("rid", "chunk")
    sums = [(F.sum(f"h{m}") % p).alias(f"h{m}") for m, (p, _) in enumerate(moduli)]
    parts = dealt.drop("chunk").mapInArrow(run, schema)
    combined = parts.groupBy("rid", "doc_id", "tag", "more", "n_bytes", "text_sha256").agg(*sums)
    return materialize(plain.where(F.col("h0").isNotNull()).unionByName(combined), "fingerprints")


def _compare(docs: DataFrame, members: DataFrame, chunk: int) -> DataFrame:
    """(m_id, m_tag, m_more, is_rep, equal, whole) of each key that is compared: whether all its rows' texts equal its representative's, chunk
    against chunk, and whether as many chunks met as its rows have.

    ``members``: (doc_id, tag, more, gid, salts, is_rep, rows), a row per key. The texts of members only are read, cut into chunks and
    met by (gid, salt, chunk); a representative's chunks go to every salt, so no group meets in one task. Salts are told from a row's place
    in the table as it is read, before any shuffle: a task that runs again deals its rows out as before.
    A representative's key is compared too if it has several rows; only then are its chunks aggregated, to one row each.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("d_id"), F.xxhash64(text).alias("d_tag"), _more(text).alias("d_more"),
        F.octet_length(text).cast("long").alias("n_bytes"), text.cast("binary").alias("data"), F.monotonically_increasing_id().alias("place"),
    )
    keys = members.select(F.col("doc_id").alias("m_id"), F.col("tag").alias("m_tag"), F.col("more").alias("m_more"), "gid", "salts", "is_rep", "rows")
    if members.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    same = (F.col("d_tag") == F.col("m_tag")) & (F.col("d_more") == F.col("m_more")) & F.col("d_id").eqNullSafe(F.col("m_id"))
    found = read.join(keys, same).withColumn("salt", F.pmod(F.xxhash64("place"), F.col("salts")).cast("int"))
    pieces = _chunks(found.select("m_id", "m_tag", "m_more", "gid", "salts", "salt", "is_rep", "rows", "n_bytes", "data"), chunk)
    one = pieces.where(~F.col("is_rep") | (F.col("rows") > 1))
    rep = pieces.where("is_rep").select(F.col("gid").alias("r_gid"), F.col("chunk").alias("r_chunk"), F.col("salts").alias("r_salts"), F.col("data").alias("r_data"), "rows")
    repeated = rep.where("rows > 1").groupBy("r_gid", "r_chunk", "r_salts").agg(F.min("r_data").alias("r_data"))
    rep = rep.where("rows = 1").drop("rows").unionByName(repeated)
    rep = rep.select("r_gid", "r_chunk", "r_data", F.explode(F.sequence(F.lit(0), F.col("r_salts") - 1)).alias("r_salt"))
    met = one.join(rep, (F.col("gid") == F.col("r_gid")) & (F.col("salt") == F.col("r_salt")) & (F.col("chunk") == F.col("r_chunk")))
    same = met.select("m_id", "m_tag", "m_more", "is_rep", "rows", "n_bytes", (F.col("data") == F.col("r_data")).alias("same"))
    sums = same.groupBy("m_id", "m_tag", "m_more", "is_rep", "rows").agg(F.min("same").alias("equal"), F.count(F.lit(1)).alias("chunks"), F.max("n_bytes").alias("n_bytes"))
    whole = F.col("chunks") == F.col("rows") * F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk))
    return sums.select("m_id", "m_tag", "m_more", "is_rep", "equal", whole.alias("whole"))


def duplicate_groups(docs: DataFrame, moduli=MODULI, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, tag), a row per document; the largest doc_id stays."""
    prints = fingerprints(docs, moduli, huge, chunk)
    keys = ["n_bytes", *(f"h{m}" for m in range(len(moduli))), "round"]
    rows, newest = prints.withColumn("round", F.lit(0)), 0
    while True:
        groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("doc_id", "rid")).alias("top"))
        groups = groups.where("size > 1").select(
            *(F.col(c).alias(f"g_{c}") for c in keys), "size", F.col("top.rid").alias("keep_rid"), F.col("top.doc_id").alias("keep_id")
        )
        joined = rows.join(groups, [F.col(c) == F.col(f"g_{c}") for c in keys], "left")
        joined = materialize(joined.select(*rows.columns, "size", "keep_rid", "keep_id"), "groups")
        # Rows of earlier rounds were compared already; only the newest round has new representatives.
        members = joined.where(F.col("size").isNotNull() & (F.col("round") == newest)).groupBy(
            "doc_id", "tag", "more", F.col("keep_rid").alias("gid"), F.ceil(F.col("size") / PER_SALT).cast("int").alias("salts")
        )
        members = materialize(members.agg(F.max(F.col("rid") == F.col("keep_rid")).alias("is_rep"), F.count(F.lit(1)).alias("rows")), "members", small=True)
        compared = materialize(_compare(docs, members, chunk), "compared", small=True)
        n_keys = members.where("NOT is_rep OR rows > 1").count()
        n, n_whole, n_odd, n_rep = compared.agg(F.count(F.lit(1)), F.count_if("whole"), F.count_if(~F.col("equal")), F.count_if(F.col("is_rep") & ~F.col("equal"))).first()
        if n_rep or n_whole < n:
            raise ArithmeticError("rows of one doc_id whose texts differ and all their hashes do not, or rows that changed between two reads")
        if n < n_keys:
            raise RuntimeError("rows changed between two reads")
        if not n_odd:
            break
        differs = compared.where("NOT equal")
        newest += 1
        own = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("tag") == F.col("m_tag")) & (F.col("more") == F.col("m_more"))
        moved = rows.join(differs, own, "left")
        moved = moved.withColumn("round", F.when(F.col("m_tag").isNotNull(), newest).otherwise(F.col("round")))
        rows = materialize(moved.select(*rows.columns), "rounds")
    return joined.select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        "text_sha256",
        "tag",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, duplicate_groups(docs))
