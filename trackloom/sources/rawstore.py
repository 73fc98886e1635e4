"""SNK-01, SRC-06: the raw table by date and hour of the fetch, added to by batches, read across schemas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.sources.staging import RAW

#: Rows of a file at most, however many an hour has.
FILE_ROWS = 2_000_000
NAMES = [c.split()[0] for c in RAW.split(", ")]


def append_raw(rows: DataFrame, path: str, batch: str) -> None:
    """Adds raw rows under date= and hour= of their fetch, as files of a batch of their own; the same batch again replaces itself.

    Columns may be those of an older schema. Rows without a fetch lie under the snapshot's hour. Rows are dealt by hour; adaptive
    execution splits a full hour over tasks and files hold FILE_ROWS at most, so a national feed makes no single task.
    """
    at = F.timestamp_seconds(F.coalesce("fetched_at", "snapshot_timestamp"))
    placed = rows.withColumns({"date": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH"), "batch": F.lit(batch)})
    written = placed.hint("rebalance", "date", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    written.option("maxRecordsPerFile", FILE_ROWS).partitionBy("date", "hour", "batch").parquet(path)


def read_raw(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Raw rows of some days, by column name: what an older file lacks is null, what a newer one has beside RAW is left out.

    Days are literals on folders, so files of other days aren't opened. The schema is RAW, not a merge over all files' footers.
    """
    rows = spark.read.schema(f"{RAW}, date string, hour string, batch string").parquet(path)
    for condition in (None if first is None else F.col("date") >= F.lit(str(first)), None if last is None else F.col("date") <= F.lit(str(last))):
        rows = rows if condition is None else rows.where(condition)
    return rows.select(*NAMES)
