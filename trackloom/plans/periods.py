"""Tables kept by periods of a day: a folder `period=<first day>` for each, added to by batches or replaced whole."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trackloom.plans.store import swept
from trackloom.sources.files import folder, listed

UNITS = ("day", "month", "quarter")
#: Rows that a file of a period holds at most.
FILE_ROWS = 4_000_000


def period_of(day: Column, unit: str) -> Column:
    """The first day of the period that a day or moment lies in."""
    return day.cast("date") if unit == "day" else F.trunc(day.cast("date"), unit)


class PeriodTable:
    """A table whose rows lie in the period of their `day`; readers name periods by literals, so that other folders aren't opened.

    A period is a day, or a month or quarter where days are thin. Replacing is delete and insert by period: rows are written
    aside first, so a write that fails leaves the periods as they were, and only the exchange of folders is left.
    """

    def __init__(self, spark: SparkSession, path: str, day: str, unit: str = "day"):
        if unit not in UNITS:
            raise ValueError(f"a period is one of {UNITS}")
        self.spark, self.path, self.day, self.unit = spark, path, day, unit
        self.columns: StructType | None = None  # of what this object wrote last, for a table that has no rows

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("period", period_of(F.col(self.day), self.unit))

    def periods(self, batch: str | None = None) -> list[date]:
        """PRJ-27: the periods that are there, or that a batch touches, from folder names alone."""
        places = listed(self.spark, f"{self.path}/period=*" + (f"/batch={batch}" if batch else ""))
        found = [m[1] for p in places if (m := re.search(r"/period=(\d{4}-\d{2}-\d{2})(/|$)", p))]
        return sorted(map(date.fromisoformat, found))

    def border(self) -> date | None:
        """The last period, which the next increment builds anew; None before the first."""
        return max(self.periods(), default=None)

    def read(self, periods: Iterable[date] | None = None, start: date | None = None, before: date | None = None, within: Column | None = None) -> DataFrame:
        """Rows of some periods: those named, from `start` on, before a period, or `within` a condition that names `period` by literals."""
        if self.columns and not self.periods():
            return self.spark.createDataFrame([], self.columns)
        rows, period = self.spark.read.parquet(self.path), F.col("period")
        for condition in (None if periods is None else period.isin(sorted(periods)), None if start is None else period >= F.lit(start), None if before is None else period < F.lit(before), within):
            rows = rows if condition is None else rows.where(condition)
        return rows.drop("period", "batch")

    def append(self, df: DataFrame, batch: str) -> list[date]:
        """SNK-07: adds a batch and returns the periods it touches; the same batch again replaces itself."""
        return self._write(self.placed(df).withColumn("batch", F.lit(batch)), "period", "batch")

    def replace(self, df: DataFrame, periods: Iterable[date] | None = None, start: date | None = None) -> None:
        """SNK-05/06: the named periods, or all from `start` on, hold exactly the rows of `df` afterwards; one that has none any more goes."""
        meant = sorted(periods) if periods is not None else [p for p in self.periods() if start is None or p >= start]
        placed = self.placed(df)
        if periods is not None:
            placed = placed.where(F.col("period").isin(meant))
        elif start is not None:
            placed = placed.where(F.col("period") >= F.lit(start))
        written = self._write(placed, "period")
        files, _ = folder(self.spark, self.path)
        for gone in set(meant) - set(written):
            files.delete(folder(self.spark, f"{self.path}/period={gone}")[1], True)

    def _write(self, placed: DataFrame, *parts: str) -> list[date]:
        """Writes rows aside, dealt by period, and puts the folders they make in the stead of those of that name. Returns their periods.

        Adaptive execution splits a full period over tasks and joins thin ones.
        """
        self.columns = placed.drop("period", "batch").schema
        aside = f"{self.path}/_made-{uuid.uuid4().hex}"
        placed.hint("rebalance", "period").write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).partitionBy(*parts).parquet(aside)
        made = listed(self.spark, "/".join([aside, *(f"{p}=*" for p in parts)]))
        for place in made:
            files, target = folder(self.spark, f"{self.path}/{'/'.join(place.split('/')[-len(parts):])}")
            files.mkdirs(target.getParent())
            files.delete(target, True)
            if not files.rename(folder(self.spark, place)[1], target):
                raise OSError(f"{target.toString()} can't be made")
        files, rest = folder(self.spark, aside)
        files.delete(rest, True)
        swept(self.spark)
        return sorted({date.fromisoformat(re.search(r"/period=(\d{4}-\d{2}-\d{2})(/|$)", p)[1]) for p in made})
