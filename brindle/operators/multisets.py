"""Set operations with multiplicity, of many sets at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From the numbers of copies of a row in each set, by name, how many copies a result has.
Copies = Callable[[dict[str, Column]], Column]


def intersect_all(*names: str) -> Copies:
    return lambda n: F.least(*(n[x] for x in names)) if len(names) > 1 else n[names[0]]


def except_all(first: str, *others: str) -> Copies:
    return lambda n: F.greatest(F.lit(0), reduce(lambda a, b: a - b, (n[x] for x in others), n[first]))


def union_all(*names: str) -> Copies:
    return lambda n: reduce(lambda a, b: a + b, (n[x] for x in names))


def combine(sets: dict[str, DataFrame], results: dict[str, Copies], label: str = "result", expand: bool = True) -> DataFrame:
    """The rows of all ``results``, each with its name in the column ``label``: as many copies as it has, or with ``expand=False`` one row with ``copies``.

    The sets, of equal column names and types, are read once each and meet in one aggregation: a row's copies in every set are counted together, before
    the shuffle and after it. All results are arithmetic on these counts. Nulls are equal to each other, as in SQL's set operations. Copies are made from
    one row where it lies, so that a row that is most of a set costs no more than others until it is written."""
    names = list(sets)
    columns = sets[names[0]].columns
    if label in columns or "copies" in columns:
        raise ValueError(f"columns of the sets must not be called {label} or copies")
    marked = [df.select(*columns, F.lit(k).alias("__set")) for k, df in enumerate(sets.values())]
    each = [F.count_if(F.col("__set") == k).alias(f"__n{k}") for k in range(len(names))]
    counted = reduce(DataFrame.unionAll, marked).groupBy(*columns).agg(*each)
    n = {name: F.col(f"__n{k}") for k, name in enumerate(names)}
    own = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), copies(n).cast("long").alias("copies")) for name, copies in results.items()))).alias("__own")
    found = counted.select(*columns, own).select(F.col("__own.name").alias(label), *columns, F.col("__own.copies").alias("copies")).where("copies > 0")
    if not expand:
        return found
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
