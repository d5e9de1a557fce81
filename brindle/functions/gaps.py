"""A table function that fills the gaps of daily series."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import timedelta
from decimal import Decimal

from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


@dataclass
class Series(AnalyzeResult):
    """What a query found out about its table: what a filled row has in a column that is not kept."""

    blank: dict | None = None


def _blank(kind: T.DataType):
    return 0 if isinstance(kind, T.IntegralType) else Decimal(0) if isinstance(kind, T.DecimalType) else 0.0 if isinstance(kind, T.FractionalType) else None


@udtf
class FillDays:
    """``fill_days(TABLE(t) PARTITION BY (k) ORDER BY (day), 'day', 'k')``: the rows of each series, and between two of them one for each day without; with ``filled``.

    Works for any table with a date column. A filled row has the columns named in the third argument, separated by commas, of the row before it, and zeros for other
    numbers, nulls for the rest. Memory is one row. Rows without a date are passed on."""

    @staticmethod
    def analyze(series: AnalyzeArgument, day: AnalyzeArgument, keep: AnalyzeArgument) -> Series:
        if not series.isTable or not isinstance(series.dataType, T.StructType):
            raise ValueError("the first argument must be a table")
        if day.value not in series.dataType.names or not isinstance(series.dataType[day.value].dataType, T.DateType):
            raise ValueError(f"{day.value} is no column of dates")
        if "filled" in series.dataType.names:
            raise ValueError("the table has a column that is called filled")
        kept = {x.strip() for x in keep.value.split(",")} | {day.value}
        blank = {f.name: _blank(f.dataType) for f in series.dataType.fields if f.name not in kept}
        return Series(schema=T.StructType([*series.dataType.fields, T.StructField("filled", T.BooleanType())]), blank=blank)

    def __init__(self, found: Series):
        self.blank, self.before = found.blank, None

    def eval(self, row, day: str, keep: str) -> Iterator[tuple]:
        at = row[day]
        if at is not None:
            if self.before is not None:
                own = self.before.asDict() | self.blank
                for k in range(1, (at - own[day]).days):
                    yield *(own | {day: own[day] + timedelta(days=k)}).values(), True
            self.before = row
        yield *row, False
