"""Files by Hadoop's file systems, so that tables may lie on any that the cluster reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Characters of headers and paths up to which they are broadcast to the lines.
HEADERS = 16 << 20


def folder(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern of Hadoop's names, in order; none where nothing matches."""
    files, place = folder(spark, pattern)
    return sorted(x.getPath().toString() for x in files.globStatus(place) or [])


def csv_by_name(spark: SparkSession, paths: list[str], columns: dict[str, str], sep: str = ",", lenient: bool = False) -> DataFrame:
    """Text columns of CSV files by name, with `_path`, in one plan: each row is parsed by its own file's header.

    Spark's reader takes one header for many files and fills columns by position. Here the lines are read as text; the first of
    each file is its header, found by an aggregate of one row a file, and joined to the lines by the file. A column
    that a file lacks is an error when its rows are read, or null where `lenient`. A line equal to its file's header is none
    of the rows; a path may be a folder of files, at any depth; records don't span lines; a byte-order mark and blanks around names don't count.
    """
    wanted = [F.lit(None).cast("string").alias(c) for c in columns]
    if not paths:
        return spark.range(0).select(*wanted, F.lit("").alias("_path"))
    lines = spark.read.text(paths, recursiveFileLookup=True).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    # within a file's first block, lines are numbered as they stand
    numbered = lines.where("_block = 0").withColumn("_line", F.monotonically_increasing_id())
    first = numbered.groupBy("_path").agg(F.min_by("value", "_line").alias("_header"))
    fields = lambda text, n: F.from_csv(text, F.lit(", ".join(f"c{i} string" for i in range(n))), {"sep": sep, "mode": "PERMISSIVE"})
    most, held = first.agg(F.max(F.size(F.split("_header", re.escape(sep)))), F.sum(F.length("_header") + F.length("_path"))).first()  # two numbers
    most = most or 1
    # read off a struct within an array, so that a line is parsed once and not again for each of its fields
    array = lambda text: F.transform(F.array(fields(text, most)), lambda line: F.array(*(line[f"c{i}"] for i in range(most))))[0]
    named = first.withColumn("_names", F.transform(array(F.regexp_replace("_header", "^\ufeff", "")), lambda c: F.trim(c)))
    places = named.withColumns({f"_at{k}": F.array_position("_names", c) for k, c in enumerate(columns)}).drop("_names")
    if (held or 0) <= HEADERS:  # else all lines would be shuffled by file, those of a file to one task
        places = F.broadcast(places)
    rows = lines.join(places, "_path").where(F.col("value") != F.col("_header")).withColumn("_fields", array(F.col("value")))
    absent = lambda c: F.lit(None).cast("string") if lenient else F.raise_error(F.concat(F.col("_path"), F.lit(f" has no column {c}"))).cast("string")
    value = lambda k, c: F.when(F.col(f"_at{k}") > 0, F.try_element_at("_fields", F.col(f"_at{k}").cast("int"))).otherwise(absent(c))
    return rows.select(*(value(k, c).alias(c) for k, c in enumerate(columns)), "_path")
