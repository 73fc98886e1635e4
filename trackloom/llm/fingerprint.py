"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the k smallest distinct hashes of its shingles of five words; a text of fewer words
is one shingle, an empty text has none. Sketches of parts merge into the sketch of the whole, and estimate
resemblance (Jaccard), containment and the number of distinct shingles. With k = 256 the standard error of a
resemblance is 0.031 at most. All of it is column expressions; a text is hashed where it lies.

Nulls: a null text is empty. Two empty sketches resemble each other fully, an empty and another not at all.
Repeated rows are kept; equal texts have equal sketches. Rows of equal keys follow each other in the order of `tie`;
rows that agree in both are interchangeable and lie in one block. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import beside, cut, let, running

K = 256
SHINGLE = 5
#: Rows that neighbours() aims at in a block.
BLOCK_ROWS = 1024
_white = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+`, in order."""
    return F.filter(F.split(F.translate(text, _white, " " * len(_white)), " "), lambda w: w != "")


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """A hash for each shingle, repeats included."""

    def of(h: Column) -> Column:
        all_starts = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, shingle))))
        return F.slice(all_starts, 1, F.greatest(F.size(h) - (shingle - 1), F.lit(1)))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, shingle))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    shared = lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u)
    return let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(shared(u)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact under k."""
    largest = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of the shingles of `a` that `b` has; none: 1."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(both / distinct_shingles(a, k), F.lit(1.0)))


def encode(a: Column) -> Column:
    """A sketch as text: its hashes in order, 8 bytes each, as base64."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def neighbours(df: DataFrame, key: str, tie: Column, rows: int = BLOCK_ROWS) -> tuple[DataFrame, object]:
    """`df` with its rows in blocks of neighbouring keys, and the window in which lead() finds the next row.

    The result has `_guest`: a row that ends its block sees, as a guest, the first row of the next block, so
    one shuffle moves each row once; drop guests after use. The last block's guest is the first row of all.
    Blocks are even shares of the keys between quantiles, so their sizes are alike wherever keys are dense.
    A key that fills more than a quantile, or null, is cut by `tie`. Nulls come last.
    """
    number = F.col(key).cast("bigint")
    pieces = 256
    ends = df.agg(F.percentile_approx(number, [i / pieces for i in range(pieces + 1)], 20_000).alias("q"), F.count(F.lit(1)).alias("n"), F.count(number).alias("there")).first()
    quantiles = ends["q"] or [0]
    heavy = sorted({a for a, b in zip(quantiles, quantiles[1:], strict=False) if a == b})
    steps = sorted(set(quantiles))
    fine = max(1, ends["n"] // pieces // rows)
    bits = max(0, (ends["n"] // rows).bit_length())
    low = F.array(*(F.lit(x).cast("bigint") for x in steps))
    at = F.greatest(F.size(F.filter(low, lambda s: s <= number)), F.lit(1))
    by_tie = F.expr(f"shiftrightunsigned(_tie, {64 - bits})") if bits else F.lit(0)
    first = F.get(low, F.col("_at") - 1)
    inner = F.floor((number - first) / F.greatest(F.coalesce(F.get(low, F.col("_at")), number + 1) - first, F.lit(1)) * fine)
    inside = F.when(number.isin(heavy), by_tie).otherwise((1 << 39) + F.least(inner, F.lit(fine)))
    placed = df.withColumn("_tie", tie).withColumn("_at", F.when(number.isNull(), F.lit(pieces + 2)).otherwise(at)).withColumn("_block", F.shiftleft(F.col("_at").cast("long"), 40) + F.when(number.isNull(), by_tie).otherwise(inside)).drop("_at")
    order = F.struct(number.isNull().alias("a"), number.alias("b"), F.col("_tie").alias("c"))
    firsts = placed.groupBy("_block").agg(F.min(order).alias("_first"))
    ranked, totals = running(firsts, ["_block"])
    ranked = cut(ranked.select(F.col("_block").alias("_own"), F.col("_first.b").alias("_key"), F.col("_first.c").alias("_first_tie"), "_rank"))
    before = ranked.select(F.col("_own").alias("_before"), ((F.col("_rank") + 1) % max(totals["_rows"], 1)).alias("_rank"))
    firsts = cut(ranked.join(before, "_rank").drop("_rank"))
    few = beside(firsts, 1_000_000)
    joined = placed.join(few, (F.col("_block") == F.col("_own")) & number.eqNullSafe(F.col("_key")) & (F.col("_tie") == F.col("_first_tie")), "left")
    seats = F.when(F.col("_before").isNull(), F.array(F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest")))).otherwise(F.array(F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest")), F.struct(F.col("_before").alias("block"), F.lit(True).alias("guest"))))
    seated = joined.select(*df.columns, "_tie", F.explode(seats).alias("_seat")).select(*df.columns, "_tie", F.col("_seat.block").alias("_block"), F.col("_seat.guest").alias("_guest"))
    return seated, Window.partitionBy("_block").orderBy("_guest", number.asc_nulls_last(), "_tie")
