from datetime import date

from pyspark.sql import functions as F

from trackloom.sources.rawstore import append_raw, read_raw
from trackloom.sources.staging import RAW


def test_old_and_new_schemas_and_pruned_days(spark, tmp_path):
    day = 1787270400  # 2026-08-21
    row = lambda i, at, fetched=True: (f"t{i}", "20260821", "r", "SCHEDULED", i, "S", 0, None, None, None, "SCHEDULED", False, at, at + 19 if fetched else None)
    rows = spark.createDataFrame([row(i, day + 3600 * i, i % 5 > 0) for i in range(72)], RAW)
    path = f"{tmp_path}/raw"
    for _ in range(2):  # a batch that runs again replaces itself
        append_raw(rows.where("stop_sequence < 40").drop("route_id"), path, "old")
        append_raw(rows.where("stop_sequence >= 40").withColumn("vehicle", F.lit(1)), path, "new")
    assert read_raw(spark, path).count() == 72
    found = read_raw(spark, path, date(2026, 8, 22), date(2026, 8, 22))
    assert found.dtypes == rows.dtypes
    assert sorted((r["stop_sequence"], r["route_id"]) for r in found.collect()) == [(i, None if i < 40 else "r") for i in range(24, 48)]
    assert all("date=2026-08-22/" in r["f"] for r in found.select(F.input_file_name().alias("f")).collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert read_raw(spark, path, first=date(2026, 8, 23)).count() == 24
