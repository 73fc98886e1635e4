"""What several operators share: reading, lineage cuts, literal tables, size-checked broadcasts."""

from __future__ import annotations

import json
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.session import ship

#: White space of the contracts: space and the controls from tab to carriage return.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"
#: Narrow rows in a part of a table that cut() knows the size of.
PART_ROWS = 25_000
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver, in a session made ready for Python stages by prepare()."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ships the package to Python workers, and bounds the bytes of the batches that these get: texts may be long."""
    ship(spark)
    if _bytes(spark.conf.get(BATCH_KEY, "64m")) > BATCH_BYTES:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def _bytes(text: str) -> int:
    """The number of a size such as `64m` or `67108864b`; none given: no bound."""
    digits, unit = text.rstrip("bBkKmMgG"), text.lower().rstrip("b")[-1:]
    n = int(digits) << {"k": 10, "m": 20, "g": 30}.get(unit, 0)
    return n if n > 0 else 1 << 62


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a local session takes a temporary one; on a cluster that is an error."""
    found = spark.sparkContext.getCheckpointDir()
    if not found:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(found or tempfile.mkdtemp(prefix="trackloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """`df` written once to the shared folder, so that nothing before it runs again and a lost executor loses no part of it.

    Where it is known to have at most `rows` narrow rows, it is written in parts of about PART_ROWS, so that small tables
    don't leave a file for each shuffle partition, nor the stages that read them.
    """
    shared_dir(df.sparkSession)
    return (df if rows is None else df.coalesce(1 + rows // PART_ROWS)).checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of files that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of driver-side rows, few by contract, made without Python on the executors."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def beside(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows; a larger one is joined by shuffle.

    `df` must be cheap to count: pass a table that cut() has written.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Rows of a table that may be broadcast.
FEW_ROWS = 100_000


def attach(many: DataFrame, one: DataFrame, key: str, rows: int, hot: int = 256) -> DataFrame:
    """`many` joined with `one` on `key`, wherever the rows of a key lie: none of its rows move for a hot one.

    `one` has a row for each key of `many` and `n`, how many of the `rows` rows of `many` have it at most. Of up to FEW_ROWS
    rows, it has no more itself, and is broadcast. Else it is written, and its keys of over max(hot, rows / FEW_ROWS)
    rows are fewer than FEW_ROWS, so these are broadcast; the others are joined by shuffle.
    """
    if rows <= FEW_ROWS:
        return many.join(F.broadcast(one.drop("n")), key)
    limit = max(hot, rows // FEW_ROWS)
    one = cut(one)
    if one.where(F.col("n") > limit).isEmpty():
        return many.join(one.drop("n"), key)
    few = F.broadcast(one.where(F.col("n") > limit).drop("n"))
    rest = one.where(F.col("n") <= limit).drop("n")
    return many.join(few, key).unionByName(many.join(few.select(key), key, "left_anti").join(rest, key))


def running(df: DataFrame, order: list, sums: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, int]]:
    """`df`, written, with `_rank`, the place of each row in `order` from 0, and `_before_<c>`, the sum of integer column c over the rows before; and the totals, "_rows" the rows.

    One range shuffle; what comes to the driver is a row for each of its partitions, and no window runs over
    all rows. Rows that are equal in `order` take any order, the same for every reader.
    """
    at = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    at = at.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    parts = at.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(c).cast("bigint").alias(c) for c in sums)).orderBy("_part").collect()  # a row for each partition of the shuffle
    totals, offsets = dict.fromkeys(["_rows", *sums], 0), []
    for p in parts:
        offsets.append({"_part": p["_part"], **{f"_from_{c}": n for c, n in totals.items()}})
        totals = {c: n + (p[c] or 0) for c, n in totals.items()}
    placed = at.join(F.broadcast(literal_table(df.sparkSession, offsets, ", ".join(["_part:int", *(f"_from_{c}:bigint" for c in totals)]))), "_part")
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = {f"_before_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)).cast("bigint") + F.col(f"_from_{c}") for c in sums}
    ranked = placed.withColumns({"_rank": F.col("_from__rows") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)), **before})
    return ranked.drop("_at", "_part", *(f"_from_{c}" for c in totals)), totals


def let(value: Column, body) -> Column:
    """body(value) with `value` evaluated once: a lambda variable stands for it."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
