"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sources weigh 5, 2, 1, repeating, in the order of their names by code point, null last. Targets share all
words by weight, each stopping at `most` times its source's words; the excess is shared again by weight
until none is above. A source is split into hash blocks. Its target is met by whole passes over its blocks
(epochs) and a part of one more pass: whole blocks in a permuted order while they fit, then documents of the
next blocks in that order, each that still fits, until SHARE of the target at most is left or no block is.

The blocks drawn are dealt to output shards by a tree: each node splits its exact quotas of blocks by source
between two halves of its shards by a multivariate hypergeometric draw, so every shard gets a fair share of every
source and the quotas add up exactly. A shard then draws its quota as the next blocks of the source's permuted
order, disjoint from all others, and orders its documents by a seeded hash. Each source is a stratum of the
tree of its own; of more than MOST_STRATA sources, those of equal hashes share one, whose permuted blocks are
drawn in one order, which splits them hypergeometrically as well.

Nulls: a null source is a source, the last; a null text has no words. Sources without words have target 0.
Documents without words are drawn with their block, and repeated rows are drawn together, as one document
of their joint size; each keeps its own row. Empty tables give empty results. Other columns pass through
untouched, but those named like the columns that mix() adds. Equal seeds give equal mixes, whatever the partitioning.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import beside, cut, literal_table, running

WEIGHTS = (5, 2, 1)
MOST = 3
#: Rows of a block at most, while a source has no more than MOST_BLOCKS; and blocks in a shard that are aimed at, at least.
BLOCK_ROWS, MOST_BLOCKS, SHARD_BLOCKS = 256, 1_000_000, 16
#: Groups of sources that the tree tells apart.
MOST_STRATA = 512
#: Share of a target that may be left once whole blocks are drawn, and blocks whose documents fill it first.
SHARE, FILL_BLOCKS = 0.001, 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source of `sizes` (source, size): n_rows, source_size, weight, target, place (from 0, by name).

    Water filling: with sources in the order of cap over weight, a source stops at its cap if the level
    that the words left would reach, shared by the weights left, is not below cap over weight.
    """
    totals = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").cast("bigint").alias("source_size"))
    named, _ = running(totals, [F.col("source").asc_nulls_last()])
    weighed = named.select("source", "n_rows", "source_size", F.col("_rank").alias("place"), F.get(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights)).cast("int")).alias("weight")).withColumn("cap", F.col("source_size") * most)
    ranked, sums = running(weighed.withColumn("_level", F.col("cap") / F.col("weight")), ["_level", F.col("source").asc_nulls_last()], ("cap", "weight", "source_size"))
    level = (F.lit(sums["source_size"]) - F.col("_before_cap")) / (F.lit(sums["weight"]) - F.col("_before_weight"))
    filled = ranked.withColumn("level", level).withColumn("full", F.col("level") >= F.col("_level"))
    common = filled.where(~F.col("full")).agg(F.min(F.struct("_rank", "level"))["level"].alias("level")).first()[0]  # one number
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(F.lit(common) * F.col("weight"), F.col("cap").cast("double")))
    return filled.withColumn("target", target).select("source", "n_rows", "source_size", "weight", "target", "place")


def split_quotas(quotas: list[int], n_shards: int, seed: int) -> list[list[int]]:
    """The splitting tree: how many blocks of each source each shard draws; [shard][source].

    Draws are exact hypergeometric ones at every size up to 10**9 blocks, which MOST_BLOCKS * MOST_STRATA stays under.
    """
    rng = np.random.default_rng(seed)

    def split(counts: np.ndarray, shards: int) -> list[list[int]]:
        if shards == 1:
            return [counts.tolist()]
        left = shards // 2
        part = rng.multivariate_hypergeometric(counts, int(counts.sum()) * left // shards, method="marginals")
        return split(part, left) + split(counts - part, shards - left)

    return split(np.array(quotas, np.int64), n_shards) if quotas else [[]] * n_shards


def block_of(key: Column, n_rows: Column, rows: int) -> Column:
    blocks = F.greatest(F.least(F.ceil(n_rows / rows), F.lit(MOST_BLOCKS)), F.lit(1))
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks)


def fill(blocked: DataFrame, passed: DataFrame, seed: int) -> DataFrame:
    """(source, block, key, size), written: the documents drawn one by one after the whole blocks.

    `blocked` has source, block, key and size; `passed` a row a block with source, its place, block, nth, part, left, target. A round
    takes documents of the next blocks in order, each that still fits: all that come before the first that doesn't, then
    again of those that fit what is left. Rounds look at four times as many blocks each, until SHARE is met.
    """
    left_over = passed.where("part <> 'whole'").select(F.col("source").alias("_source"), F.col("block").alias("_block"), "place", "nth")
    ends = beside(cut(left_over.groupBy("place").agg(F.min("nth").alias("first"), F.max("nth").alias("last"))))
    open_blocks = cut(left_over.join(ends, "place").select("_source", "_block", (F.col("nth") - F.col("first")).alias("at"), (F.col("last") - F.col("first")).alias("last")))
    state = cut(passed.where("part = 'boundary'").select(F.col("source").alias("_of"), "left", "target"))
    found, low, high = None, 0, FILL_BLOCKS
    while True:
        want = open_blocks.where((F.col("at") >= low) & (F.col("at") < high)).join(state, F.col("_source").eqNullSafe(F.col("_of")))
        few = beside(cut(want.drop("_of")))
        docs = blocked.join(few, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))).groupBy("source", "block", "at", "left", "key").agg(F.sum("size").alias("size"))
        order = Window.partitionBy("source").orderBy("at", F.xxhash64("key", F.lit(seed)), "key").rowsBetween(Window.unboundedPreceding, 0)
        docs = docs.withColumn("taken", F.lit(False))
        for _ in range(4):
            fits = ~F.col("taken") & (F.col("size") <= F.col("left"))
            docs = docs.withColumn("run", F.sum(F.when(fits, F.col("size")).otherwise(0)).over(order))
            docs = docs.withColumn("now", fits & (F.col("run") <= F.col("left")))
            docs = docs.withColumn("left", F.col("left") - F.coalesce(F.sum(F.when(F.col("now"), F.col("size"))).over(Window.partitionBy("source")), F.lit(0))).withColumn("taken", F.col("taken") | F.col("now"))
        picked = cut(docs.where("taken").select("source", "block", "key", "size"))
        found = picked if found is None else found.union(picked)
        used = picked.groupBy("source").agg(F.sum("size").alias("used"))
        after = state.join(used, F.col("_of").eqNullSafe(F.col("source")), "left").withColumn("left", F.col("left") - F.coalesce("used", F.lit(0)))
        more = open_blocks.where(F.col("last") >= high).select("_source").distinct()
        state = cut(after.join(more, F.col("_of").eqNullSafe(F.col("_source")), "left_semi").where(F.col("left") > F.col("target") * SHARE).select("_of", "left", "target"))
        if state.isEmpty():
            return cut(found)
        low, high = high, 4 * high


def mix(docs: DataFrame, sizes: DataFrame, key: str = "doc_key", n_shards: int = 64, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`docs` with source_size, target and draws, an array of (shard, epoch, order) for each time the mix takes the row; `order` is the seeded place within the shard.

    `docs` has source and `key`, a hash of the row; `sizes` has source, `key` and size for the same rows,
    written by cut(). `docs` isn't shuffled: tables of sources and blocks are joined to it, by broadcast
    where they are small. A block table has a row for BLOCK_ROWS documents.
    """
    spark = docs.sparkSession
    sizes = sizes.select("source", F.col(key).alias("key"), "size")
    targets = cut(source_targets(sizes, weights, most))
    shape = targets.agg(F.count(F.lit(1)).alias("sources"), F.sum("n_rows").alias("rows")).first()
    block_rows = max(1, min(BLOCK_ROWS, (shape["rows"] or 0) // (SHARD_BLOCKS * n_shards)))
    stratum = F.col("place") if shape["sources"] <= MOST_STRATA else F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(MOST_STRATA))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(F.lit(0)).cast("int")
    sources = cut(targets.withColumn("epochs", epochs).withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))).withColumn("stratum", stratum.cast("int")).withColumnRenamed("source", "_source"))
    few = beside(sources)
    blocked = sizes.join(few, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn("block", block_of(F.col("key"), F.col("n_rows"), block_rows))
    blocks = blocked.groupBy("source", "place", "stratum", "block", "epochs", "rest", "target").agg(F.sum("size").cast("bigint").alias("words"))
    # the part of a pass: whole blocks in a permuted order, then the block that the target's end falls in and those behind it
    ranked, _ = running(blocks.withColumn("_deal", F.xxhash64("block", "source", F.lit(seed))), ["place", "_deal", "block"], ("words",))
    ranked = cut(ranked.drop("_deal"))
    firsts = beside(cut(ranked.groupBy("place").agg(F.min("_rank").alias("_first"), F.min("_before_words").alias("_first_words"))))
    passed = ranked.join(firsts, "place").withColumns({"nth": F.col("_rank") - F.col("_first") + 1, "through": F.col("_before_words") - F.col("_first_words") + F.col("words")})
    passed = cut(passed.withColumn("part", F.when(F.col("through") <= F.col("rest"), "whole").when(F.col("through") - F.col("words") < F.col("rest"), "boundary").otherwise("none")).withColumn("left", F.col("rest") - F.col("through") + F.col("words")))
    chosen = fill(blocked.select("source", "block", "key", "size"), passed, seed)
    some = chosen.select(F.col("source").alias("_some_source"), F.col("block").alias("_some_block")).distinct()
    marked = passed.join(some, F.col("source").eqNullSafe(F.col("_some_source")) & (F.col("block") == F.col("_some_block")), "left").withColumn("some", F.col("_some_block").isNotNull())
    drawn = marked.select("source", "place", "stratum", "block", F.explode(F.sequence(F.lit(0), F.col("epochs"))).alias("epoch"), "epochs", "part", "some").where("epoch < epochs or part = 'whole' or some")
    dealt, _ = running(drawn.withColumn("_deal", F.xxhash64("epoch", "block", "source", F.lit(seed + 1))), ["stratum", "_deal", "place", "block", "epoch"])
    drawn = cut(dealt.drop("_deal"))
    groups = drawn.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("first")).collect()  # a row for each stratum
    quotas, first = {r["stratum"]: r["n"] for r in groups}, {r["stratum"]: r["first"] for r in groups}
    strata = sorted(quotas)
    ends: dict[int, list[int]] = {s: [] for s in strata}
    for leaf in split_quotas([quotas[s] for s in strata], n_shards, seed):
        for s, n in zip(strata, leaf, strict=True):
            ends[s].append((ends[s][-1] if ends[s] else first[s]) + n)
    cuts = F.broadcast(literal_table(spark, [{"stratum": s, "ends": e} for s, e in ends.items()], "stratum:int,ends:array<bigint>"))  # MOST_STRATA rows at most
    dealt = drawn.join(cuts, "stratum").withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_rank"))))
    plan = cut(dealt.groupBy(F.col("source").alias("_plan_source"), F.col("block").alias("_plan_block")).agg(F.sort_array(F.collect_list(F.struct("shard", "epoch"))).alias("_plan"), F.max("epochs").alias("_passes"), F.bool_or("some").alias("_some")))
    picks = beside(chosen.select(F.col("source").alias("_chosen_source"), F.col("key").alias("_chosen")))
    rows = docs.select(F.struct("*").alias("_doc"), F.col("source").alias("_own_source"), F.col(key).alias("_key"))
    rows = rows.join(few, F.col("_own_source").eqNullSafe(F.col("_source")), "left").withColumn("_block", block_of(F.col("_key"), F.col("n_rows"), block_rows))
    rows = rows.join(beside(plan), F.col("_own_source").eqNullSafe(F.col("_plan_source")) & (F.col("_block") == F.col("_plan_block")), "left")
    rows = rows.join(picks, F.col("_own_source").eqNullSafe(F.col("_chosen_source")) & (F.col("_key") == F.col("_chosen")), "left")
    whole = F.coalesce("_plan", F.expr("cast(array() as array<struct<shard:int,epoch:int>>)"))
    taken = F.when(F.col("_some") & F.col("_chosen").isNull(), F.filter(whole, lambda d: d["epoch"] < F.col("_passes"))).otherwise(whole)
    added = {"source_size": F.col("source_size"), "target": F.col("target"), "draws": F.transform(taken, lambda d: F.struct(d["shard"].alias("shard"), d["epoch"].alias("epoch"), F.xxhash64("_key", d["epoch"], F.lit(seed)).alias("order")))}
    return rows.select(*(F.col("_doc")[c].alias(c) for c in docs.columns if c not in added), *(v.alias(c) for c, v in added.items()))


def shuffled(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each draw: the columns, then mix_shard and mix_order, the seeded place within the shard."""
    drawn = mixed.select(*columns, F.inline("draws"))
    return drawn.select(*columns, F.col("shard").alias("mix_shard"), F.col("order").alias("mix_order"))
