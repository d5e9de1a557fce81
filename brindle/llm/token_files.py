"""Token ids in flat unsigned binary files with 64-bit document offsets.

Each partition of the doc_id-ordered corpus is one pair of files in a folder of the shared storage:

- ``NNNNNN.bin``: the ids of its documents, end ids included, little-endian, of the narrowest unsigned type;
- ``NNNNNN.idx``: magic ``BRNDLIDX``, version, item size, document count n (three uint64), n + 1 offsets
  (uint64, in ids, local to the partition), n document ids (int64), n bytes that are 1 where the id is null.

A partition's base, the number of ids before its first, is the prefix sum of the partitions' totals, so
no task waits for another. Files are written under a task-private name and renamed when complete: a task
that runs twice leaves one whole file. Local files are memory-mapped when read; others are read by range.

Cases: a null text counts as empty and yields its end id alone. Null doc_ids come first. Rows that repeat a
doc_id keep their own entries, ordered by their texts. Strings of added tokens in a text get those tokens' ids. A very
long text is encoded whole by one task, in pre-tokens. An empty table gives no documents. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import bpe_ids
from brindle.llm.work import materialize, slices

MAGIC = b"BRNDLIDX"
VERSION = 1
#: The id appended to each document.
END_ID = 2
#: Documents whose ids are in memory at once when files are read.
READ_DOCS = 2048


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        encoder = bpe_ids.encoder(tokenizer)
        end = encoder.id_bytes(end_id)
        width = encoder.dtype.itemsize
        counts, ids, nulls = [], [], bytearray()
        own = f"{root}/.{part:06d}-{task.taskAttemptId()}"
        with store.open_output_stream(f"{own}.bin") as out:
            for batch in slices(batches):
                texts = batch.column("text").to_pylist()
                for at in range(0, len(texts), 1024):
                    encoded = [e + end for e in encoder.encode(texts[at : at + 1024])]
                    counts += [len(e) // width for e in encoded]
                    out.write(b"".join(encoded))
                for d in batch.column("doc_id").to_pylist():
                    ids.append(d or 0)
                    nulls.append(d is None)
        encoder.trim()
        offsets = np.zeros(len(counts) + 1, dtype="<u8")
        np.cumsum(counts, out=offsets[1:])
        with store.open_output_stream(f"{own}.idx") as out:
            out.write(MAGIC + struct.pack("<QQQ", VERSION, width, len(counts)))
            for x in (offsets.tobytes(), np.array(ids, dtype="<i8").tobytes(), bytes(nulls)):
                out.write(x)
        for kind in ("bin", "idx"):
            final = f"{root}/{part:06d}.{kind}"
            if store.get_file_info(final).is_file:  # of an earlier attempt at this task, with the same content
                store.delete_file(final)
            store.move(f"{own}.{kind}", final)
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(counts)], "n_tokens": [int(offsets[-1])]})

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the files of ``docs`` into ``folder``; (part, n_docs, n_tokens, base), a row per partition.

    The manifest is bounded by the number of tasks, so its prefix sums are formed on the driver."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("text").asc()]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(order[0], order[2])
    written = materialize(ordered.mapInArrow(_writer(folder, tokenizer, end_id), "part long, n_docs long, n_tokens long"), "manifest")
    parts = sorted(written.collect())
    bases = itertools.accumulate((p.n_tokens for p in parts), initial=0)
    return docs.sparkSession.createDataFrame(
        [(*p, base) for p, base in zip(parts, bases)], "part long, n_docs long, n_tokens long, base long"
    )


class TokenFile:
    """One partition's files."""

    def __init__(self, folder: str, part: int):
        from pyarrow import fs

        store, root = _filesystem(folder)
        with store.open_input_file(f"{root}/{part:06d}.idx") as f:
            head = f.read(len(MAGIC) + 24)
            version, width, n = struct.unpack("<QQQ", head[len(MAGIC) :])
            if head[: len(MAGIC)] != MAGIC or version != VERSION:
                raise ValueError(f"not an index file of this version: {root}/{part:06d}.idx")
            self.offsets = np.frombuffer(f.read(8 * (n + 1)), dtype="<u8")
            self.doc_ids = np.frombuffer(f.read(8 * n), dtype="<i8")
            self.nulls = np.frombuffer(f.read(n), dtype=np.uint8).astype(bool)
        self.dtype = np.dtype(f"<u{width}")
        name = f"{root}/{part:06d}.bin"
        self._map = self._file = None
        if isinstance(store, fs.LocalFileSystem):
            if self.offsets[-1]:
                self._map = np.memmap(name, dtype=self.dtype, mode="r")
        else:
            self._file = store.open_input_file(name)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, doc: int) -> np.ndarray:
        """The ids of the doc-th document of this partition."""
        a, b = int(self.offsets[doc]), int(self.offsets[doc + 1])
        if self._file is not None:
            width = self.dtype.itemsize
            return np.frombuffer(self._file.read_at((b - a) * width, a * width), dtype=self.dtype)
        return self._map[a:b] if b > a else np.zeros(0, self.dtype)


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                file = TokenFile(folder, part)
                for at in range(0, len(file), READ_DOCS):
                    rows = range(at, min(at + READ_DOCS, len(file)))
                    ids = [file.ids(i) for i in rows]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[at : rows.stop], mask=file.nulls[at : rows.stop]),
                            pa.array(file.offsets[at : rows.stop].astype(np.int64) + base),
                            pa.array(np.diff(file.offsets[at : rows.stop + 1]).astype(np.int64)),
                            pa.array([ids_crc32(x) for x in ids], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    parts = manifest.select("part", "base")
    spread = parts.repartition(max(1, min(parts.count(), 10_000)))
    return spread.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
