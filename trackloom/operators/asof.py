"""As-of joins by merging: both sides in one ordered pass, so rows grow by sum, not by product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, since: str, carried: list[str]) -> DataFrame:
    """JOI-02: `left` with columns `since` and `carried` of the newest row of `right` of its key that is not after `at`; null where none is.

    `right` has one row for each key and `since`. Both are united and ordered by key and time, and the last right row is carried
    down to the left ones: a key costs the rows it has on both sides, one shuffle and one sort. Rows of a null key or time match
    nothing and stay. Column names that both sides share, but for the key, must not be carried.
    """
    held = F.struct(F.col(since), *carried)
    absent = F.lit(None).cast(right.select(held.alias("r")).schema["r"].dataType)
    own = F.struct(*left.columns)
    versions = right.select(*by, F.col(since).alias("_at"), F.lit(0).alias("_side"), held.alias("_right"), F.lit(None).cast(left.select(own.alias("l")).schema["l"].dataType).alias("_left"))
    asked = left.select(*by, F.col(at).alias("_at"), F.lit(1).alias("_side"), absent.alias("_right"), own.alias("_left"))
    before = Window.partitionBy(*by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    usable = F.col("_at").isNotNull()
    for key in by:
        usable = usable & F.col(key).isNotNull()
    merged = versions.where(usable).unionByName(asked).withColumn("_found", F.last("_right", ignorenulls=True).over(before)).where("_side = 1")
    found = F.when(usable, F.col("_found"))
    return merged.select("_left.*", *(found[c].alias(c) for c in (since, *carried)))
