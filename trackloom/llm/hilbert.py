"""Sharding by Hilbert-curve order: quantise several dimensions, sort by curve index, cut runs.

Rows that are close in all dimensions lie close on the curve, so each shard spans a small box of the
metadata space, and a reader that keeps minima and maxima per file skips most files on any dimension.

Nulls: a null category is a category of its own, before all others; a null number is the lowest level.
Empty tables give empty results. Repeated rows are kept: each gets a slot of its own. Equal curve
indices are ordered by the tie-breakers given, and rows that agree in these too by their places in the table, so
one cell that holds a third of the rows is cut into runs like any other stretch. Other columns pass through
untouched; columns named shard or slot are replaced by cut_runs().
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import beside, cut, running


@cache
def curve_tables(dims: int) -> tuple[list[int], list[int], list[list[int]]]:
    """The Hilbert curve of `dims` dimensions as an automaton, from Hamilton's rule.

    A state is (entry corner, direction). Given the cell's bits at one level it yields the digit of the
    curve index, the inverse Gray code of the cell as seen from the state, and the state of the sub-cell.
    """
    full = (1 << dims) - 1
    turn = lambda x, k: ((x >> k % dims) | (x << (dims - k % dims))) & full
    gray = lambda i: i ^ (i >> 1)
    rank = {gray(i): i for i in range(1 << dims)}
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1
    entry = lambda i: 0 if i == 0 else gray(2 * ((i - 1) // 2))
    direction = lambda i: 0 if i == 0 else (trailing(i - 1) if i % 2 == 0 else trailing(i)) % dims
    states, digits, follow = {(0, 0): 0}, [], []
    order = [(0, 0)]
    for e, d in order:
        for cell in range(1 << dims):
            i = rank[turn(cell ^ e, d + 1)]
            back = turn(entry(i), dims - (d + 1) % dims)
            new = (e ^ back, (d + direction(i) + 1) % dims)
            if new not in states:
                states[new] = len(order)
                order.append(new)
            digits.append(i)
            follow.append(states[new])
    return digits, follow, [list(x) for x in order]


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """The place on the curve of a cell, given its level, 0 to 2**bits - 1, in each dimension."""
    dims = len(levels)
    if not 1 <= dims or dims * bits > 62:
        raise ValueError("the index must fit 62 bits")
    digits, follow, _ = curve_tables(dims)
    start = F.struct(F.lit(0).cast("int").alias("state"), F.lit(0).cast("long").alias("index"))
    digit_of, state_of = F.array(*map(F.lit, digits)), F.array(*map(F.lit, follow))

    def step(acc: Column, bit: Column) -> Column:
        cell = F.lit(0)
        for j, level in enumerate(levels):
            cell = cell + F.shiftleft(F.call_function("getbit", level.cast("long"), bit).cast("int"), j)
        at = (acc["state"] * (1 << dims) + cell).cast("int")
        return F.struct(F.get(state_of, at).cast("int").alias("state"), (F.shiftleft(acc["index"], dims) + F.get(digit_of, at)).cast("long").alias("index"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["index"])


def category_levels(df: DataFrame, column: str, bits: int) -> DataFrame:
    """Each value of a column with its level: equal shares of the rows to each level, in the values' order.

    The result has a row for each distinct value.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked, totals = running(counts, [F.col("value").asc_nulls_first()], ("n",))
    middle = (F.col("_before_n") + F.col("n") / 2) * (1 << bits) / max(totals["n"], 1)
    return ranked.select("value", F.least(F.floor(middle), F.lit((1 << bits) - 1)).cast("int").alias("level"))


def number_level(value: Column, edges: list[float]) -> Column:
    """The level of a number: how many of the ascending edges it reaches; null: 0.

    The edges are quantiles, so outliers take a level at most, and each level its share of the rows, but for repeated values.
    """
    if not edges:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*(F.lit(float(e)) for e in edges)), lambda e: e <= value.cast("double"))), F.lit(0)).cast("int")


def curve_order(df: DataFrame, categories: list[str], numbers: list[str], bits: int = 6) -> DataFrame:
    """`df` with `hilbert_index` over the given columns, each quantised to 2**bits levels of about equal shares."""
    levels = []
    out = df
    if numbers:
        steps = [i / (1 << bits) for i in range(1, 1 << bits)]
        ends = df.agg(*(F.percentile_approx(F.col(c).cast("double"), steps, 10_000).alias(f"c{k}") for k, c in enumerate(numbers))).first()
        levels += [number_level(F.col(c), sorted(set(ends[f"c{k}"] or []))) for k, c in enumerate(numbers)]
    for k, c in enumerate(categories):
        found = cut(category_levels(df, c, bits).select(F.col("value").alias(f"_value_{k}"), F.col("level").alias(f"_level_{k}")))
        out = out.join(beside(found), F.col(c).eqNullSafe(F.col(f"_value_{k}")), "left")
        levels.append(F.coalesce(F.col(f"_level_{k}"), F.lit(0)))
    return out.withColumn("hilbert_index", hilbert_index(levels, bits)).drop(*(x for k in range(len(categories)) for x in (f"_value_{k}", f"_level_{k}")))


def cut_runs(df: DataFrame, order: list[str], n_shards: int, law: str = "rows", size: str = "size") -> DataFrame:
    """`df` with shard and slot: the rows in `order` cut into `n_shards` runs.

    law `rows`: counts differ by one at most. law `bytes`: a run ends where the running sum of `size`
    passes its share. One range shuffle of `df`, which should hold no texts; ranks come from counts per
    range, so no task sees more than its range and no window runs over all rows.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(law)
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    held = df.select(F.struct("*").alias("_row"), *(F.col(c).alias(f"_order_{k}") for k, c in enumerate(order)), *([F.col(size).cast("bigint").alias("_size")] if law == "bytes" else []))
    # what no tie-breaker tells apart is told apart by a number, so that a third of equal rows needs no one task
    dealt = held.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    placed, totals = running(dealt, [*(f"_order_{k}" for k in range(len(order))), "_tie"], ("_size",) if law == "bytes" else ())
    total = max(totals["_rows"], 1)
    if law == "rows":
        out = placed.withColumn("shard", F.expr(f"cast(_rank * {n_shards} div {total} as int)"))
        out = out.withColumn("slot", F.col("_rank") - F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}"))
    else:
        middle = F.col("_before__size") + F.col("_size") / 2
        out = cut(placed.withColumn("shard", F.least(F.floor(middle * n_shards / max(totals["_size"], 1)), F.lit(n_shards - 1)).cast("int")))
        starts = out.groupBy("shard").agg(F.min("_rank").alias("_start"))  # n_shards rows
        out = out.join(F.broadcast(starts), "shard").withColumn("slot", F.col("_rank") - F.col("_start"))
    return out.select(*(F.col("_row")[c].alias(c) for c in columns), "shard", F.col("slot").cast("long").alias("slot"))
