"""As-of join: each row of the left side with the last row of its key on the right side that is not later."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.timeline import seconds

#: Cells of equal width into which the time axis is cut to count rows; and rows of a bucket of neighbouring cells, about.
CELLS, BUCKET_ROWS = 65_536, 2_000_000
#: Classes of keys, by hash, whose rows are counted to find keys that may have more than a bucket's rows.
SLOTS = 65_536
#: The bucket of keys that are not split.
WHOLE = -1


def _cells(times: DataFrame) -> tuple[int, int]:
    """The first second and the width of a cell."""
    low, high = times.agg(F.min("at"), F.max("at")).first()
    return (0, 1) if low is None else (low, (high - low) // CELLS + 1)


def _buckets(times: DataFrame, cell: Column, rows: int) -> list[tuple[int, int]]:
    """(cell, bucket): neighbouring cells, each with rows, in buckets of about so many rows. There are at most CELLS."""
    counted = sorted(times.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = itertools.accumulate((n for _, n in counted), initial=0)
    return [(c, b // rows) for (c, _), b in zip(counted, before)]


def _carried(whole: DataFrame, r: DataFrame, order: Column, right_time: str) -> DataFrame:
    """What the buckets of keys that are split begin with: the last right row of the key in any earlier bucket."""
    whole, r = (rows.where(F.col("bucket") != WHOLE) for rows in (whole, r))
    # A row for each key and bucket: its last right row, if any.
    ends = r.groupBy("k", "bucket").agg(F.max_by("r", order).alias("r"))
    starts = whole.select("k", "bucket", F.lit(None).cast(r.schema["r"].dataType).alias("r")).distinct()
    each = ends.unionByName(starts).groupBy("k", "bucket").agg(F.any_value("r", ignoreNulls=True).alias("r"), F.count_if(F.col("r").isNull()).alias("asked"))
    earlier = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = each.withColumn("r", F.last("r", ignorenulls=True).over(earlier)).where((F.col("asked") > 0) & F.col("r").isNotNull())
    return carried.select("k", "bucket", F.col(f"r.{right_time}").alias("t"), F.lit(0).alias("side"), "r")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, ties: list[str] | None = None, within: Column | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The columns of ``left`` and those of ``right`` but ``key``: a row for each row of ``left``.

    Both sides lie on one time axis; the last row of the right side is carried forward by a window. The window's groups are a key, or, of a key that may have
    more than ``bucket_rows`` rows, a key in a bucket of time: buckets hold about ``bucket_rows`` rows of all such keys together, so a key that has most
    rows is split over them. What a bucket begins with is carried over as one row: the last of the key in any earlier bucket. Only rows of such
    keys are looked at for that, and if there are none, all rows are shuffled once. No side is collected or broadcast.

    Of right rows at one time the largest by the columns ``ties`` counts. ``within``: the most that the right row may be
    earlier, in the unit that the difference of both times has. Rows of the left side without a key or time have no match, those of the right one
    none either. Column names of both sides must differ but for ``key``. A key's rows at one second stay together.
    """
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    others = [c for c in right.columns if c != key]
    t, kind = F.col("t"), left.schema[left_time].dataType
    if right.schema[right_time].dataType != kind:
        raise TypeError("times of both sides must be of one type")
    order = F.struct("t", *(F.col(f"r.{c}") for c in ties or []))
    none = F.lit(None)
    l = left.select(F.col(key).alias("k"), F.col(left_time).alias("t"), F.lit(2).alias("side"), F.struct(*left.columns).alias("l"))
    r = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    r = r.select(F.col(key).alias("k"), F.col(right_time).alias("t"), F.lit(1).alias("side"), F.struct(*others).alias("r"))
    whole = l.where(F.col("k").isNotNull() & t.isNotNull())
    slot = F.pmod(F.xxhash64("k"), F.lit(SLOTS))
    counted = whole.select("k").unionByName(r.select("k")).groupBy(slot.alias("slot")).count().where(F.col("count") > bucket_rows)
    hot = [s for s, _ in counted.collect()]  # each stands for more than bucket_rows rows
    if hot:
        at, may_split = seconds(t, kind), slot.isin(hot)
        times = whole.where(may_split).select(at.alias("at")).unionByName(r.where(may_split).select(at.alias("at")))
        low, width = _cells(times)
        cell = F.floor((F.col("at") - low) / width).cast("long")
        buckets = F.broadcast(left.sparkSession.createDataFrame(_buckets(times, cell, bucket_rows), "cell long, bucket long"))

        def dealt(rows: DataFrame) -> DataFrame:
            placed = rows.withColumn("at", at).withColumn("cell", F.when(may_split, cell)).join(buckets, "cell", "left")
            return placed.withColumn("bucket", F.coalesce("bucket", F.lit(WHOLE))).drop("at", "cell")

        whole, r = dealt(whole), dealt(r)
    else:
        whole, r = (rows.withColumn("bucket", F.lit(WHOLE)) for rows in (whole, r))
    line = whole.withColumn("r", none.cast(r.schema["r"].dataType))
    for more in (r, _carried(whole, r, order, right_time)) if hot else (r,):
        line = line.unionByName(more.withColumn("l", none.cast(whole.schema["l"].dataType)))
    upto = Window.partitionBy("k", "bucket").orderBy("t", "side", *(F.col(f"r.{c}").asc_nulls_first() for c in ties or []))
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = line.withColumn("r", F.last("r", ignorenulls=True).over(upto)).where(F.col("side") == 2)
    if within is not None:
        met = met.withColumn("r", F.when(t - F.col(f"r.{right_time}") <= within, F.col("r")))
    alone = l.where(F.col("k").isNull() | t.isNull()).withColumn("r", none.cast(r.schema["r"].dataType))
    met = met.select("l", "r").unionByName(alone.select("l", "r"))
    return met.select("l.*", *(F.col(f"r.{c}").alias(c) for c in others))
