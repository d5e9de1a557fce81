"""Shared working tables: where intermediate results are written and how they are read again."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

T = TypeVar("T")

#: A table of keys of at most so many rows (some 32 bytes each) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
#: Tasks for each core that write a table by size, at least, and bytes by Spark's estimate that justify another.
SMALL_TASKS, TASK_BYTES = 4, 64 << 20
#: Column names of ours that no table has.
TAG, KEEPS, NUMBER = "__brindle_tag", "__brindle_keeps", "__brindle_number"


#: Paths of tables and files written, for each open :func:`scratch`.
_written: list[list[str]] = []
#: Folders of sessions in which ``spark.checkpoint.dir`` is unset, by application.
_own: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local session may do without: it gets a
    folder of its own."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="brindle-")
        root = _own[context.applicationId]
    return f"{root.rstrip('/')}/brindle"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _written:
        _written[-1].append(path)
    return path


def _worker_memory(conf, master: str, parallelism: int, executors: int, as_mib) -> tuple[int, int]:
    """MiB outside the heap that an executor's Python workers share, and how many workers they are. In a local session they are the driver's."""
    local = re.match(r"local(\[(\d+|\*)|$)", master)
    kind = "driver" if local else "executor"
    heap = as_mib(conf.get(f"spark.{kind}.memory", "1g"))
    beside = conf.get(f"spark.{kind}.memoryOverhead", None)
    beside = as_mib(beside) if beside else max(384, int(heap * float(conf.get(f"spark.{kind}.memoryOverheadFactor", "0.1"))))
    cores = conf.get("spark.executor.cores", None)
    if local:
        cores = parallelism
    elif given := re.match(r"local-cluster\[\s*\d+\s*,\s*(\d+)", master):
        cores = given[1]
    elif not cores:
        cores = -(-parallelism // max(1, executors))
    return beside + as_mib(conf.get("spark.executor.pyspark.memory", "0m")) * (not local), max(1, int(cores))


def broadcast_bytes(spark: SparkSession) -> int:
    """Bytes of a table that every Python worker may hold. All workers of an executor together hold half of its memory outside the heap."""
    context = spark.sparkContext
    as_mib = context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb
    executors = context._jsc.sc().getExecutorMemoryStatus().size() - 1
    memory, workers = _worker_memory(context.getConf(), context.master, context.defaultParallelism, executors, as_mib)
    return (memory << 20) // (2 * workers)


@contextlib.contextmanager
def own_settings(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """While a table is written: few rows in an Arrow batch between Spark and Python, since texts are long and a batch is whole in both; and
    shuffle files go when the table is there, from which all that follows is read."""
    batch, cleanup = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = {key: spark.conf.get(key) for key in (batch, cleanup)}
    if not 0 < int(before[batch]) <= rows:
        spark.conf.set(batch, rows)
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def tasks_by_size(df: DataFrame) -> int:
    """How many tasks a table deserves by Spark's estimate of its size, which grows with what it is made from; joins are overestimated."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(max(SMALL_TASKS * df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)), (1 << 31) - 1)


def materialize(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: the lineage ends there,
    so a lost executor costs a file read, not a recomputation. A ``small`` table, of keys or sums, is written by as many tasks as its
    size deserves: not by as many as large shuffles have, in files of a few rows."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if small:
        df = df.coalesce(tasks_by_size(df))
    with own_settings(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def discard(df: DataFrame) -> None:
    """Delete a written table that nothing will read again; other frames stay as they are."""
    if path := getattr(df, "written_to", None):
        _delete(df.sparkSession, path)
        for paths in _written:
            if path in paths:
                paths.remove(path)


@contextlib.contextmanager
def scratch(spark: SparkSession, *kept: DataFrame) -> Iterator[list[DataFrame]]:
    """Tables and files written inside are deleted at the end, but for those added to the list that it gives: frames that are read later. Results
    that were not computed inside must not rest on the others."""
    _written.append([])
    keep = list(kept)
    try:
        yield keep
    finally:
        stay = {getattr(df, "written_to", None) for df in keep}
        paths = _written.pop()
        for path in paths:
            if path not in stay:
                _delete(spark, path)
        if _written:
            _written[-1] += [path for path in paths if path in stay]


def numbered(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """The rows of ``df`` with ``number``, their place from 0 in the order of ``keys``, and how many they are.

    Sorted partitions are written with each row's place in its partition; the sizes before a partition, a row per task, are added."""
    order = F.struct(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    own = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", order)
    own = materialize(own.select(*df.columns, F.col("place.part").alias("part"), F.col("place.row").bitwiseAND((1 << 33) - 1).alias("row")), name)
    sizes = sorted(own.groupBy("part").agg(F.max("row") + 1).collect())
    bases = list(itertools.accumulate((n for _, n in sizes), initial=0))
    table = df.sparkSession.createDataFrame([(p, base) for (p, _), base in zip(sizes, bases)], "b_part int, base long")
    met = own.join(F.broadcast(table), F.col("part") == F.col("b_part"))
    return met.select(*df.columns, (F.col("row") + F.col("base")).alias("number")), bases[-1]


def keep_rows(docs: DataFrame, verdicts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` (doc_id, tag, ``by`` as strings, kept) keeps, with all their columns.

    ``verdicts`` has a row per row of ``docs``; ``tag`` is the xxhash64 of the text, a null one being empty. ``by``: other
    columns that a verdict depends on. Of rows equal in all of these, as many stay as are kept. Only dropped keys are
    joined, and the texts move only if these are too many to broadcast."""
    keys = verdicts.groupBy("doc_id", "tag", *by).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("kept").cast("int")).alias("keeps"))
    others = [F.col(c).alias(f"x_{c}") for c in by]
    gone = keys.where("keeps < rows").select(F.col("doc_id").alias("x_id"), F.col("tag").alias("x_tag"), *others, F.col("keeps").alias(KEEPS))
    gone = materialize(gone, "dropped", small=True)
    side = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    tagged = docs.withColumn(TAG, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    met = (F.col(TAG) == F.col("x_tag")) & F.col("doc_id").cast("long").eqNullSafe(F.col("x_id"))
    for c in by:
        met = met & F.col(c).cast("string").eqNullSafe(F.col(f"x_{c}"))
    kept = tagged.join(side, met, "left_anti").select(*docs.columns)
    repeated, equal = gone.where(F.col(KEEPS) > 0), ["doc_id", TAG, *by]
    if not repeated.head(1):
        return kept
    ones = tagged.join(repeated.where(F.col(KEEPS) == 1), met, "left_semi").dropDuplicates(equal)
    kept = kept.unionByName(ones.select(*docs.columns))
    more = repeated.where(F.col(KEEPS) > 1)
    if not more.head(1):
        return kept
    ranked = tagged.join(more, met).withColumn(NUMBER, F.row_number().over(Window.partitionBy(*equal).orderBy(TAG)))
    return kept.unionByName(ranked.where(F.col(NUMBER) <= F.col(KEEPS)).select(*docs.columns))


#: By key, the one model that a worker process keeps.
_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` makes, kept in this worker process for its later tasks, until another key is asked for: workers serve all
    operators of a session, and hold one model at a time."""
    if key not in _held:
        _held.clear()
        gc.collect()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Return unused memory of this process to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()  # an idle worker holds no buffers of its last task
