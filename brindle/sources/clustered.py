"""Tables clustered along a space-filling curve, with the bounds of every file in a manifest: reads of ranges skip the files outside."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions.timeline import seconds

#: Bits of a column in the curve.
BITS = 6
MANIFEST = "file string, n long, low array<double>, high array<double>"


def _number(column: Column, kind: T.DataType) -> Column:
    """A value as a number that is never less for a larger one."""
    return column.cast("double") if isinstance(kind, T.FractionalType) else seconds(column, kind).cast("double")


def _place(df: DataFrame, column: str) -> Column:
    return _number(F.col(column), df.schema[column].dataType)


def _bound(kind: T.DataType, value) -> Column:
    return _number(F.lit(value).cast(kind), kind)


def _schema(current: dict) -> T.StructType:
    return T.StructType.fromJson(current["schema"])


def with_curve(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``__curve``, a row's place on the Z curve through the ``columns``; -1 if one is null. Each is told by BITS bits, of 2 ** BITS ranges with about
    as many rows: their bounds are approximate quantiles of the whole table, so that skewed columns are cut as evenly as others."""
    cuts = [k / 2**BITS for k in range(1, 2**BITS)]
    bounds = df.agg(*(F.percentile_approx(_place(df, c), cuts, 10_000).alias(f"c{k}") for k, c in enumerate(columns))).first()
    cells = {}
    for k, c in enumerate(columns):
        own = F.lit([float(x) for x in sorted(set(bounds[k] or [0.0]))])
        # How many bounds a value reaches; as a variable of a lambda, it is computed once a row.
        reached = F.transform(F.array(_place(df, c)), lambda p: F.size(F.filter(own, lambda x: x <= p)))  # noqa: B023
        cells[f"__cell{k}"] = F.get(reached, F.lit(0)).cast("long")
    code = F.lit(0).cast("long")
    for k, name in enumerate(cells):
        for b in range(BITS):
            bit = F.shiftright(name, b).bitwiseAND(F.lit(1).cast("long"))
            code = code.bitwiseOR(F.shiftleft(bit, b * len(columns) + k))
    code = reduce(lambda a, c: F.when(F.col(c).isNull(), -1).otherwise(a), columns, code)
    return df.withColumns(cells).withColumn("__curve", code).drop(*cells)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(there)


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name first, which then takes the path's place in one step."""
    fs, new = _file_system(spark, f"{path}-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(new, _file_system(spark, path)[1], how)


def write(df: DataFrame, folder: str, columns: list[str], files: int) -> str:
    """Write ``df`` to a new version of the table in ``folder``, in about ``files`` files along the curve through ``columns``; the version's name.

    Data and manifest of a version are written under a name of their own; then one rename makes the version the current one. Readers see the version before
    or the new one whole; a job that dies leaves no trace in what they see. Rows whose columns are null go first."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    if clash := [c for c in df.columns if c.startswith("__c")]:
        raise ValueError(f"columns of names that are used here: {clash}")
    order = ["__curve", *columns]  # many rows may share a place on the curve
    dealt = with_curve(df, columns).repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__curve")
    data = f"{folder}/data-{version}"
    dealt.write.parquet(data)
    written = spark.read.schema(df.schema).parquet(data)
    own = [_place(df, c) for c in columns]
    bounds = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*map(F.min, own)).alias("low"), F.array(*map(F.max, own)).alias("high")
    )
    manifest = f"{folder}/manifest-{version}"
    bounds.write.parquet(manifest)
    _replace(spark, f"{folder}/current", json.dumps({"manifest": manifest, "columns": columns, "schema": json.loads(df.schema.json())}))
    return version


def _current(spark: SparkSession, folder: str) -> dict:
    """What the current version says of itself."""
    fs, path = _file_system(spark, f"{folder}/current")
    if not fs.exists(path):
        raise FileNotFoundError(folder)
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def files_for(spark: SparkSession, folder: str, ranges: dict[str, tuple]) -> tuple[list[str], int]:
    """The files of the current version that may have rows in all ``ranges`` (column: (low, high), ends included), and how many there are in all.

    The manifest has a row a file and is filtered by Spark; the driver gets the names of files that are to be read, as for any scan."""
    current = _current(spark, folder)
    manifest = spark.read.schema(MANIFEST).parquet(current["manifest"])
    schema, may = _schema(current), F.lit(True)
    for c, (low, high) in ranges.items():
        if c in current["columns"]:
            k = current["columns"].index(c)
            may = may & (F.get("high", F.lit(k)) >= _bound(schema[c].dataType, low)) & (F.get("low", F.lit(k)) <= _bound(schema[c].dataType, high))
    return sorted(r.file for r in manifest.where(may).select("file").collect()), manifest.count()


def read(spark: SparkSession, folder: str, ranges: dict[str, tuple]) -> DataFrame:
    """The rows of the current version with all ``ranges``; files whose bounds lie outside are not opened."""
    current = _current(spark, folder)
    files, _ = files_for(spark, folder, ranges)
    schema = _schema(current)
    if not files:
        return spark.createDataFrame([], schema)
    inside = F.lit(True)
    for c, (low, high) in ranges.items():
        inside = inside & F.col(c).between(F.lit(low).cast(schema[c].dataType), F.lit(high).cast(schema[c].dataType))
    return spark.read.schema(schema).parquet(*files).where(inside)
