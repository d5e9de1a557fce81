"""Stored sketches: distinct values and quantiles of small periods, merged to longer ones without reading any row again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the distinct sketch's cells: a standard error of some 1.04 / 2 ** (LOG / 2). Size of the quantile sketch: a rank error of about 1.3 / K at 99 percent.
LOG, K = 12, 200


def distinct_error(deviations: float = 4.0) -> float:
    """The relative error that an estimate of distinct values stays within, but for one case in some ten thousand."""
    return deviations * 1.04 / 2 ** (LOG / 2)


def rank_error(deviations: float = 2.0) -> float:
    """The error in rank, as a share of all values, that a quantile stays within; 1.33 percent is that of 99 in 100 cases for K = 200."""
    return deviations * 2.66 / K


def sketch(rows: DataFrame, period: Column, distinct: str, value: str) -> DataFrame:
    """(period, n, distinct_sketch, value_sketch): one row a period. Sketches are built where the rows are and merged: what is shuffled and stored is of
    fixed size. Null values are in none of the sketches, but count in ``n``."""
    return rows.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, LOG).alias("distinct_sketch"), F.kll_sketch_agg_double(F.col(value).cast("double"), K).alias("value_sketch")
    )


def merge(sketches: DataFrame, period: Column) -> DataFrame:
    """The sketches of longer periods from those of shorter ones."""
    return sketches.groupBy(period.alias("period")).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("value_sketch").alias("value_sketch")
    )


def estimates(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """(period, n, distinct_estimate, and each of ``quantiles`` by its name)."""
    own = (F.kll_sketch_get_quantile_double("value_sketch", F.lit(q)).alias(name) for name, q in quantiles.items())
    return sketches.select("period", "n", F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), *own)
