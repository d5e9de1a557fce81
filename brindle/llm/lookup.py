"""Look-ups in a table of hashed keys that is too large to broadcast.

The table lies in shards by the leading bits of its keys. Documents are dealt into runs of bounded text. Each run asks for its
distinct keys, once each; requests are shuffled to the shards and answered there; answers are shuffled back and meet the documents
of their run, whose own shuffle serves both asking and meeting. Whatever the table's size, a text is shuffled once, a shard is
read once, and a task holds one run with its answers or one shard with its requests. A key that all texts have is asked
for once by each run, so that no shard gets more of it than there are runs.

Sorted keys and their answers travel byte plane by byte plane, in which the leading bytes of sorted numbers compress to almost nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a run, on average.
RUN_CHARS = 8_000_000
REQUESTS = "shard int, run long, kind int, keys binary"
ANSWERS = "run long, kind int, shard int, check long, answers binary"

#: Of some texts: their sorted distinct keys (uint64) by kind, and whatever is worth keeping until the answers are there.
Prepare = Callable[[list[str]], tuple[dict[int, np.ndarray], object]]
#: By kind: sorted keys and their answers.
Found = dict[int, tuple[np.ndarray, np.ndarray]]


def pack(values: np.ndarray) -> bytes:
    """The bytes of some numbers or records, plane by plane."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes() if len(values) else b""


def unpack(data: bytes, dtype: np.dtype | str) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def shard_edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each shard begins in sorted ``keys`` (uint64), and where the last ends."""
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def with_runs(docs: DataFrame, chars: int) -> DataFrame:
    """``docs``, of ``chars`` characters in all, with the column ``run``."""
    runs = max(1, -(-chars // RUN_CHARS))
    return docs.withColumn("run", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(runs).cast("long")))


def _parts(keys: dict[int, np.ndarray], bits: int):
    """(kind, shard, keys) of the shards that are asked."""
    for kind, asked in keys.items():
        edges = shard_edges(asked, bits)
        for s in np.flatnonzero(np.diff(edges)).tolist():
            yield kind, s, asked[edges[s] : edges[s + 1]]


def _check(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys) >> np.uint64(1)) ^ len(keys)


def _asker(keys_of: Callable[[list[str]], dict[int, np.ndarray]], bits: int):
    def run(docs: pa.Table) -> pa.Table:
        number = docs.column("run")[0].as_py()
        keys = keys_of(docs.column("text").to_pylist())
        rows = [(s, number, kind, pack(own)) for kind, s, own in _parts(keys, bits)]
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "run", "kind", "keys"])

    return run


def _answerer(answer):
    def run(requests: pa.Table, shard: pa.Table) -> pa.Table:
        own = answer(shard.to_pylist())
        checks, found = [], []
        for kind, data in zip(requests.column("kind").to_pylist(), requests.column("keys")):
            keys = unpack(data.as_py(), "<u8")
            checks.append(_check(keys))
            found.append(pack(own(kind, keys)))
        columns = [requests.column("run"), requests.column("kind"), requests.column("shard"), pa.array(checks, pa.int64()), pa.array(found, pa.binary())]
        return pa.Table.from_arrays(columns, names=["run", "kind", "shard", "check", "answers"])

    return run


def _finisher(prepare: Prepare, bits: int, finish, dtypes: dict[int, np.dtype]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, state = prepare(docs.column("text").to_pylist())
        held = {(kind, s): (check, data) for kind, s, check, data in zip(*(answers.column(c).to_pylist() for c in ("kind", "shard", "check", "answers")))}
        values: dict[int, list[np.ndarray]] = {kind: [np.zeros(0, dtype)] for kind, dtype in dtypes.items()}
        for kind, s, own in _parts(keys, bits):
            check, data = held[kind, s]
            if check != _check(own):
                raise RuntimeError("a run of documents changed between its request and the answer")
            values[kind].append(unpack(data, dtypes[kind]))
        return finish(docs, {kind: (keys[kind], np.concatenate(values[kind])) for kind in keys}, state)

    return run


def look_up(docs: DataFrame, prepare: Prepare, shards: DataFrame, bits: int, answer, dtypes: dict[int, np.dtype], finish, schema: str, keys_of=None) -> DataFrame:
    """What ``finish`` makes of the documents of each run and the answers to its keys.

    ``docs`` come from :func:`with_runs`. ``answer`` makes, of the rows of a shard (one or none), a function of kind and keys that returns
    an array of ``dtypes[kind]``; ``finish`` gets a table of documents, what was found, and what ``prepare`` kept for them, and
    returns a table of ``schema``. ``keys_of`` gives of some texts the same keys as ``prepare``, and nothing else."""
    asked = docs.groupBy("run").applyInArrow(_asker(keys_of or (lambda texts: prepare(texts)[0]), bits), REQUESTS)
    answers = asked.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(_answerer(answer), ANSWERS)
    return docs.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_finisher(prepare, bits, finish, dtypes), schema)
