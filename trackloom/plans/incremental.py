"""Marts maintained by increments: what is new is added to raw tables, and the periods it touches are built again.

A trip belongs to one service day, so a period of days can be built from its own reports, messages and timetable. Late
reports touch the period they are about, however far back. Polls differ: the first of a day is measured from the last of
the day before, and the hours between them belong to the collection as well, so an increment of polls starts with the period
of the last poll of its sources, which is replaced whole, and carries one row a source from before it.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.operators import consolidate, distinct, polls, sections, timetable
from trackloom.plans import marts
from trackloom.plans.periods import PeriodTable, period_of
from trackloom.sources.files import listed

BY_SERVICE_DAY = ("reports", "messages", "consolidated", "runs", "origin", "bottlenecks", "buffer", "punctuality", "quality", "line_sections")
DAYS = dict.fromkeys(BY_SERVICE_DAY, "service_date") | {"polls": "fetched_at", "ends": "last_poll", "collection": "calendar_day"} | {"days": "day", "poll_days": "day"}
#: Marts whose last days are extracted; `days` and `poll_days` keep which days of which source each of them has.
OF_LAST_DAYS = ("runs", "bottlenecks", "buffer", "punctuality")


#: Tables of polls; the others are of service days.
OF_POLLS = ("polls", "ends", "collection", "poll_days")
#: What each table of service days is made from; the marts whose days are kept add theirs to `days`.
MADE_FROM = {"consolidated": ("reports", "messages"), "runs": ("consolidated",), "line_sections": ("buffer",)} | dict.fromkeys(("origin", "bottlenecks", "buffer", "punctuality", "quality"), ("runs",))


def needed(names: Iterable[str]) -> set[str]:
    """The named tables with all that they are made from. Polls are loaded together."""
    out: set[str] = set()
    left = list(names)
    while left:
        name = left.pop()
        if name not in out:
            out.add(name)
            left += OF_POLLS if name in OF_POLLS else MADE_FROM.get(name, ())
    return out


SECTION = ("source", "from_label", "to_label")


class DailyMarts:
    """The tables of one folder by name; `planned`, `stop_names` and `line_names` are the timetable's relations."""

    def __init__(self, spark: SparkSession, path: str, planned: DataFrame, stop_names: DataFrame, line_names: DataFrame, unit: str = "day", config: Config = DEFAULT):
        self.spark, self.path, self.unit, self.config = spark, path, unit, config
        self.planned, self.stop_names, self.line_names = planned, stop_names, line_names
        self.tables = {name: PeriodTable(spark, f"{path}/{name}", day, unit) for name, day in DAYS.items()}

    def read(self, name: str, periods: Iterable[date] | None = None, start: date | None = None) -> DataFrame:
        return self.tables[name].read(periods, start)

    def load(self, reports: DataFrame, messages: DataFrame, batch: str, names: Iterable[str] | None = None) -> list[date]:
        """An increment of raw rows: they are added, and the periods they touch are built again, in the named tables or all. The same batch again changes nothing."""
        touched = sorted({*self.tables["reports"].append(reports, batch), *self.tables["messages"].append(messages, batch)})
        if touched:
            self.build(self.read("reports", touched), self.read("messages", touched), touched, names=names)
        return touched

    def build_batch(self, batch: str, names: Iterable[str]) -> list[date]:
        """The named tables in the periods that a batch, added earlier, touches. What they are made from is there, unless it is named too."""
        touched = sorted({p for raw in ("reports", "messages") for p in self.tables[raw].periods(batch)})
        if touched:
            self.build(self.read("reports", touched), self.read("messages", touched), touched, names=names)
        return touched

    def advance(self, reports: DataFrame, messages: DataFrame) -> date | None:
        """PRJ-27: from a source that holds all history: the border period of the run detail is built again, and all that follows it."""
        border = self.tables["runs"].border()
        self.build(*(df if border is None else df.where(F.col("service_date") >= F.lit(border)) for df in (reports, messages)), start=border)
        return border

    def build(self, reports: DataFrame, messages: DataFrame, periods: list[date] | None = None, start: date | None = None, names: Iterable[str] | None = None) -> None:
        """The named tables, or all, of some periods, or from one on, from these periods' raw rows."""
        names = set(DAYS) if names is None else set(names)
        held = lambda name: self.read(name, periods, start)

        def put(name: str, make) -> None:
            if name in names:
                self.tables[name].replace(make(), periods, start)

        def run_rows() -> DataFrame:
            seen = held("consolidated")
            rows = seen.unionByName(timetable.cancelled_rows(messages, seen, self.planned, self.config))
            return marts.run_detail(sections.stop_events(consolidate.with_names(rows, self.stop_names, self.line_names)))

        def section_sets() -> DataFrame:
            buffer = held("buffer")
            return distinct.daily_sets(buffer, self.numbered(buffer), ["service_date", "source", "line"], list(SECTION))

        put("consolidated", lambda: consolidate.consolidate(reports, self.config))
        put("runs", run_rows)
        put("origin", lambda: marts.delay_origin(held("runs")))
        put("bottlenecks", lambda: marts.bottlenecks(held("runs")))
        put("buffer", lambda: marts.buffer_balance(held("runs"), self.config))
        put("line_sections", section_sets)
        put("punctuality", lambda: marts.punctuality(held("runs"), timetable.run_coverage(held("consolidated"), self.planned), self.config))
        put("quality", lambda: marts.data_quality(held("runs")))
        kept = [name for name in OF_LAST_DAYS if self.tables[name].columns or self.tables[name].periods()]
        put("days", lambda: reduce(DataFrame.unionByName, (self._days_of(name, periods, start) for name in kept)))

    def _days_of(self, name: str, periods: list[date] | None = None, start: date | None = None) -> DataFrame:
        return self.read(name, periods, start).select(F.lit(name).alias("mart"), "source", F.col(DAYS[name]).alias("day")).distinct()

    def recent(self, name: str, n: int, of: str | None = None) -> DataFrame:
        """SRC-15, WIN-09: rows on the last `n` days that each source has in a mart (`of`, else `name` itself), other periods unopened.

        The days are kept beside the marts, a row for each day of a source, so a mart isn't read to know them. A source makes one
        range of literals; one that ended long ago doesn't open what lies between. Rows without a source are in no extract.
        """
        of, day = of or name, F.col(DAYS[name])
        kept = self.tables["poll_days" if of == "collection" else "days"]
        if not kept.periods():
            return self.read(name)
        last = kept.read().where((F.col("mart") == of) & F.col("source").isNotNull()).withColumn("_rank", F.dense_rank().over(Window.partitionBy("source").orderBy(F.col("day").desc()))).where(F.col("_rank") <= n)
        ends = last.groupBy("source").agg(F.min("day").alias("a"), F.max("day").alias("z"))
        spans = ends.withColumns({"first": period_of(F.col("a"), self.unit), "last": period_of(F.col("z"), self.unit)}).collect()  # a row a source
        of_source = lambda s: (F.col("source") == s["source"]) & day.between(F.lit(s["a"]), F.lit(s["z"])) & F.col("period").between(F.lit(s["first"]), F.lit(s["last"]))
        return self.tables[name].read(within=reduce(or_, map(of_source, spans), F.lit(False)))

    def numbered(self, rows: DataFrame) -> DataFrame:
        """AGG-21: the sections of the network with their numbers, those of `rows` that are new added behind the known ones.

        A number never changes, so sets of earlier days stay valid. The dictionary has a row for each section, not for each day.
        """
        path = f"{self.path}/sections"
        known = self.spark.read.parquet(path) if listed(self.spark, f"{path}/*.parquet") else None
        new = distinct.number(rows, list(SECTION), known)
        new.write.mode("append").parquet(path)
        return self.spark.read.parquet(path)

    def load_polls(self, rows: DataFrame) -> date | None:
        """An increment of polls (source, fetched_at, snapshot_ts); polls that are known already change nothing. Returns the first period built."""
        fresh = rows.where("fetched_at is not null")
        known = bool(self.tables["ends"].periods())
        begins = fresh.groupBy("source").agg(F.min("fetched_at").alias("at"))
        if known:  # a source's hours go on from its last poll before these
            ends = self.tables["ends"].read()
            last = ends.join(begins, "source").where("first_poll <= at").groupBy("source").agg(F.max(F.least("last_poll", "at")).alias("last"))
            begins = begins.join(last, "source", "left").select("source", F.least("at", "last").alias("at"))
        start = begins.agg(F.min(period_of(F.col("at"), self.unit)).alias("p")).first()["p"]
        if start is None:
            return None
        border = self.tables["polls"].border()
        if border and border >= start:
            fresh = fresh.select("source", "fetched_at", "snapshot_ts").unionByName(self.read("polls", start=start).select("source", "fetched_at", "snapshot_ts"))
        before = self.tables["ends"].read(before=start).groupBy("source").agg(F.max("last_poll").alias("fetched_at")) if known else None
        self.tables["polls"].replace(polls.polls(fresh, before), start=start)
        polled = self.read("polls", start=start)
        by = polled.groupBy("source", period_of(F.col("fetched_at"), self.unit).alias("p"))
        self.tables["ends"].replace(by.agg(F.min("fetched_at").alias("first_poll"), F.max("fetched_at").alias("last_poll")).drop("p"), start=start)
        since = None if before is None else before.select("source", F.lit(start).cast("timestamp_ntz").alias("since"))
        self.tables["collection"].replace(marts.collection(polled, self.config, since), start=start)
        self.tables["poll_days"].replace(self._days_of("collection", start=start), start=start)
        return start
