"""Weighted medians by selection: bits of the answer are found one group at a time, so that no group's rows are ever gathered or sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.sources.shared import new_folder, settings

#: Bits that a pass decides: so many sums a key, at most, leave a task.
BITS = 8
#: Rows that a task gets by a shuffle, about.
PART_ROWS = 1_000_000


def _written(spark: SparkSession, rows: DataFrame) -> DataFrame:
    folder = new_folder(spark, "medians")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def weighted_median(rows: DataFrame, key: str, value: str, weight: str, bits: int = BITS, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, median): of each key the least whole number ``value`` such that rows up to it have half of the weight or more.

    A pass adds up the weights by the next ``bits`` bits of the values, before the shuffle and after it, and decides the range of bits in which the half is reached; only rows
    of that range go on to the next pass. Sums are shuffled by key and bits, and rows met with what is decided by key and the bits decided, so that a key that
    has most rows is spread over all tasks. The number of passes is that of the bits in which values differ, not of rows. Shuffles have so many parts that each gets
    about ``part_rows`` rows: a task's memory does not grow with the table. What a pass decides is written to a folder, but for the last pass over a table that needs no more parts than usual. Rows whose key, value or weight is
    null, or whose weight is not above 0, do not count; keys without others have no row."""
    if len({key, value, weight, "median"}) < 4:
        raise ValueError("names of key, value and weight must differ, and none be median")
    own = rows.select(F.col(key).alias("k"), F.col(value).cast("long").alias("v"), F.col(weight).cast("long").alias("w")).where("k IS NOT NULL AND v IS NOT NULL AND w > 0")
    low, high, n = own.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if low is None:
        return own.select(F.col("k").alias(key), F.col("v").alias("median")).limit(0)
    spark = rows.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-n // part_rows))
    left = max((high - low).bit_length(), 1)
    own = own.select("k", (F.col("v") - low).alias("v"), "w")
    # Of each key: the bits decided, and the weight that is still to be passed.
    state = own.groupBy("k").agg(F.ceil(F.sum("w") / 2).cast("long").alias("needed"))
    with settings(spark, spark__sql__shuffle__partitions=str(parts)):
        while left > 0:
            left -= min(bits, left)
            sums = own.groupBy("k", F.shiftright("v", left).alias("decided")).agg(F.sum("w").alias("w"))
            upto = Window.partitionBy("k").orderBy("decided").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most 2 ** bits rows
            met = sums.join(state.select("k", "needed"), "k").withColumn("sum", F.sum("w").over(upto))
            reached = met.where((F.col("sum") >= F.col("needed")) & (F.col("sum") - F.col("w") < F.col("needed")))
            state = reached.select("k", "decided", (F.col("needed") - F.col("sum") + F.col("w")).alias("needed"))
            if left > 0 or parts > usual:
                state = _written(spark, state)
            if left > 0:
                own = _written(spark, own.withColumn("decided", F.shiftright("v", left)).join(state.select("k", "decided"), ["k", "decided"], "left_semi").drop("decided"))
    return state.select(F.col("k").alias(key), (F.col("decided") + low).alias("median"))
