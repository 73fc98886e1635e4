"""Best-fit packing by a grouping genetic algorithm, on islands with elite migration.

Items of bounded lengths go to sequences of `capacity`. Items are dealt by hash to districts of about
DISTRICT items; each district is evolved by ISLANDS islands. An island holds a population of packings, seeded by
best fit in perturbed orders. A crossover injects whole well-filled bins of one parent into another, dissolves the
bins that held any of their items, with the emptiest and a few others that aren't full, exchanges displaced items for
shorter ones where that fills a bin better, and best-fits the rest, longest first. A child costs in
proportion to what it changes. After each epoch the elite of an island migrates to the next island of its
district. An island rests once its best packing has as few bins as its total length allows. The emptiest bins of
the districts, of up to 1/16 of the items, are packed again in districts of their own, level by level, until one
district is left, so that many districts waste no more than one would.

All randomness comes from seeds and item ids. Islands are rows of a table written between epochs, so a lost
executor costs its own islands' epoch alone; a task holds one island at a time.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import cut, prepare

CAPACITY = 1024
DISTRICT, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 16384, 3, 2, 100, 5
#: Fill from which a bin counts as well-filled.
WELL = 0.99
#: Bins that a crossover injects, others that it dissolves, and bins in which it tries an exchange, at most.
INJECTED, DISSOLVED, TRIED = 24, 32, 48


@dataclass
class Packing:
    """Bins of items, what is free in each, and the bin of each item. Bins are shared between packings, never changed."""

    bins: list[tuple[int, ...]]
    free: np.ndarray
    bin_of: np.ndarray

    def fitness(self, capacity: int) -> tuple[int, float]:
        """Fewer bins first, then bins as unequally filled as can be; smaller is better."""
        return len(self.bins), -float((np.square(capacity - self.free.astype(np.float64))).sum())

    def copy(self) -> Packing:
        return Packing(list(self.bins), self.free.copy(), self.bin_of.copy())

    def drop(self, empty: list[int]) -> None:
        """Takes out empty bins; the last ones move to their places."""
        for b in sorted(empty, reverse=True):
            last = len(self.bins) - 1
            if b != last:
                self.bins[b], self.free[b] = self.bins[last], self.free[last]
                self.bin_of[list(self.bins[b])] = b
            self.bins.pop()
            self.free = self.free[:last]

    @staticmethod
    def of(bin_of: np.ndarray, lengths: list[int], capacity: int) -> Packing:
        order = np.argsort(bin_of, kind="stable")
        ends = np.flatnonzero(np.diff(bin_of[order])) + 1
        bins = [tuple(x.tolist()) for x in np.split(order, ends)] if len(order) else []
        return Packing(bins, capacity - np.bincount(bin_of, lengths, len(bins)).astype(np.int64), bin_of.astype(np.int64))


def best_fit(lengths: list[int], items: list[int], packing: Packing, capacity: int, empty: list[int]) -> list[int]:
    """Puts items, in the order given, each into the fullest bin that it fits; else into an `empty` or a new one. Returns the bins left empty."""
    if not items:
        return empty
    packing.free = np.concatenate([packing.free, np.full(len(items), -1)])  # room for new bins; an empty one has -1
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    open_bins = np.flatnonzero(packing.free >= min(lengths[i] for i in items))
    for b, f in zip(open_bins.tolist(), packing.free[open_bins].tolist(), strict=True):
        at[f].append(b)
        mask |= 1 << f
    put: dict[int, list[int]] = {}
    for i in items:
        n = lengths[i]
        room = mask >> n
        if room:
            f = n + (room & -room).bit_length() - 1
            b = at[f].pop()
            if not at[f]:
                mask ^= 1 << f
        else:
            f = capacity
            if empty:
                b = empty.pop()
            else:
                b = len(packing.bins)
                packing.bins.append(())
        put.setdefault(b, []).append(i)
        at[f - n].append(b)
        mask |= 1 << (f - n)
        packing.free[b], packing.bin_of[i] = f - n, b
    for b, more in put.items():
        packing.bins[b] = (*packing.bins[b], *more)
    packing.free = packing.free[: len(packing.bins)]
    return empty


def packed(lengths: list[int], order: list[int], capacity: int) -> Packing:
    """Best fit of all items in an order."""
    out = Packing([], np.empty(0, np.int64), np.zeros(len(lengths), np.int64))
    best_fit(lengths, order, out, capacity, [])
    return out


def crossover(rng: np.random.Generator, lengths: list[int], a: Packing, b: Packing, capacity: int) -> Packing:
    """Well-filled bins of `b` put whole into `a`; items of the bins they displace are exchanged and best-fitted."""
    well = np.flatnonzero(b.free <= (1 - WELL) * capacity)
    if not len(well):
        well = np.argsort(b.free, kind="stable")[: max(1, len(b.bins) // 4)]
    chosen = rng.choice(well, min(len(well), int(rng.integers(1, INJECTED + 1))), replace=False).tolist()
    there = lambda x: len(a.bins[a.bin_of[x[0]]]) == len(x) and len({*a.bin_of[list(x)].tolist()}) == 1
    injected = [k for k in chosen if not there(b.bins[k])]
    taken = {i for k in injected for i in b.bins[k]}
    emptiest = min(len(a.bins), 2 + int(rng.integers(0, 8)))
    loose = np.flatnonzero(a.free > 0)
    gone = {*np.argpartition(a.free, len(a.bins) - emptiest)[-emptiest:].tolist(), *rng.choice(loose, min(len(loose), int(rng.integers(0, DISSOLVED - 7))), replace=False).tolist(), *a.bin_of[list(taken)].tolist()}
    displaced = [i for s in sorted(gone) for i in a.bins[s] if i not in taken]
    child, empty = a.copy(), sorted(gone, reverse=True)
    for s in empty:
        child.bins[s], child.free[s] = (), -1
    for k in injected:
        if empty:
            s = empty.pop()
        else:
            s = len(child.bins)
            child.bins.append(())
            child.free = np.append(child.free, -1)
        child.bins[s], child.free[s] = b.bins[k], b.free[k]
        child.bin_of[list(b.bins[k])] = s
    displaced = exchange(rng, lengths, child, displaced)
    displaced.sort(key=lambda i: (-lengths[i], i))
    child.drop(best_fit(lengths, displaced, child, capacity, empty))
    return child


def exchange(rng: np.random.Generator, lengths: list[int], packing: Packing, displaced: list[int]) -> list[int]:
    """Puts longer displaced items in the stead of shorter ones where they fit, in some bins; returns what is displaced then."""
    pool = sorted((lengths[i], i) for i in displaced)
    loose = np.flatnonzero(packing.free > 0)
    for s in rng.choice(loose, min(len(loose), TRIED), replace=False).tolist():
        room, gain, out, at = int(packing.free[s]), 0, None, -1
        for x in packing.bins[s]:
            k = bisect_right(pool, (lengths[x] + room, len(lengths))) - 1
            if k >= 0 and pool[k][0] - lengths[x] > gain:
                gain, out, at = pool[k][0] - lengths[x], x, k
        if out is not None:
            new = pool.pop(at)[1]
            packing.bins[s] = tuple(new if i == out else i for i in packing.bins[s])
            packing.free[s] -= gain
            packing.bin_of[new] = s
            insort(pool, (lengths[out], out))
    return [i for _, i in pool]


def evolve(lengths: list[int], population: list[Packing], seed: int, capacity: int = CAPACITY, generations: int = GENERATIONS, size: int = POPULATION) -> list[Packing]:
    """An island's population after some generations, best first. An empty one is seeded by best fit in perturbed orders."""
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    if not population:
        population = [packed(lengths, sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)), capacity)]
        while len(population[0].bins) > least and len(population) < size:
            noise = rng.normal(0, 0.05 * len(population), len(lengths)) * capacity / 8
            population.append(packed(lengths, sorted(range(len(lengths)), key=lambda i: -(lengths[i] + noise[i])), capacity))
    scored = sorted(((p.fitness(capacity), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])[:size]
    for g in range(generations):
        if len(scored[0][2].bins) <= least or len(scored) < 2:
            break
        x, y = (min(rng.integers(len(scored), size=2)) for _ in range(2))
        child = crossover(rng, lengths, scored[x][2], scored[y if y != x else (x + 1) % len(scored)][2], capacity)
        fitness = child.fitness(capacity)
        # a child as fit as another takes its place, so that the population stays diverse
        kept = [s for s in scored if s[0] != fitness]
        scored = sorted([*kept, (fitness, size + g, child)], key=lambda x: x[:2])[:size]
    return [p for _, _, p in scored]


def pack(items: DataFrame, capacity: int = CAPACITY, district: int = DISTRICT, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 1) -> DataFrame:
    """(uid, sequence_id, offset) for items (uid bigint, length int), lengths from 1 to `capacity`, uids distinct.

    `items` should be a table written by cut(). sequence_id holds level, district and bin. An empty table
    gives an empty result.
    """
    prepare(items.sparkSession)
    left, level, placed = items.select("uid", F.col("length").cast("int").alias("length")), 0, None
    while True:
        n = left.count()
        districts = max(1, -(-n // district))
        last = districts == 1
        dealt = left.groupBy(F.pmod(F.xxhash64("uid", F.lit(seed + level)), F.lit(districts)).alias("district")).agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items"))
        towns = cut(dealt.select("district", F.col("items.uid").alias("uids"), F.col("items.length").alias("lengths")))
        state = towns.select("district", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.expr("cast(array() as array<binary>)").alias("population"))
        for epoch in range(epochs):
            state = cut(_epoch(state, capacity, seed * 1000 + level * 100 + epoch))
            if epoch + 1 < epochs:  # each island's elite joins the next island's population
                elite = state.select("district", ((F.col("island") + 1) % islands).alias("island"), F.get("population", F.lit(0)).alias("elite"))
                state = state.join(elite, ["district", "island"]).select("district", "lengths", "island", F.concat("population", F.array("elite")).alias("population"))
        best = state.groupBy("district").agg(F.min_by(F.get("population", F.lit(0)), F.struct("bins", "order", "island")).alias("best"))
        out = cut(_places(towns.join(best, "district"), capacity, level, last))
        done = out.where("sequence_id is not null")
        placed = done if placed is None else placed.union(done)
        if last:
            return placed.select("uid", "sequence_id", "offset")
        left, level = out.where("sequence_id is null").select("uid", "length"), level + 1


def _epoch(state: DataFrame, capacity: int, seed: int) -> DataFrame:
    schema = pa.schema([("district", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32())), ("population", pa.list_(pa.binary())), ("bins", pa.int32()), ("order", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = row["lengths"]
                population = [Packing.of(np.frombuffer(p, "<u4"), lengths, capacity) for p in row["population"]]
                found = evolve(lengths, population, seed + 7919 * row["island"] + row["district"], capacity)
                score = found[0].fitness(capacity)
                out = {"district": row["district"], "island": row["island"], "lengths": lengths, "population": [p.bin_of.astype("<u4").tobytes() for p in found], "bins": score[0], "order": score[1]}
                yield pa.RecordBatch.from_pylist([out], schema)

    spread = state.select("district", "island", "lengths", "population").repartition("district", "island")
    return spread.mapInArrow(run, "district bigint, island int, lengths array<int>, population array<binary>, bins int, order double")


def _places(best: DataFrame, capacity: int, level: int, last: bool) -> DataFrame:
    """A row per item; without a sequence where its bin is packed again at the next level."""
    schema = pa.schema([("uid", pa.int64()), ("length", pa.int32()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths, uids = row["lengths"], row["uids"]
                bins = sorted(Packing.of(np.frombuffer(row["best"], "<u4"), lengths, capacity).bins, key=lambda b: (sum(lengths[i] for i in b), b))
                again, passed = 0, 0
                while not last and again < len(bins) and passed + len(bins[again]) <= len(uids) // 16 and sum(lengths[i] for i in bins[again]) < WELL * capacity:
                    passed += len(bins[again])
                    again += 1
                out: dict[str, list] = {"uid": [], "length": [], "sequence_id": [], "offset": []}
                for b, items in enumerate(bins):
                    at = 0
                    for i in items:
                        out["uid"].append(uids[i])
                        out["length"].append(lengths[i])
                        out["sequence_id"].append(None if b < again else (level << 56) | (row["district"] << 20) | b)
                        out["offset"].append(at)
                        at += lengths[i]
                yield pa.RecordBatch.from_pydict(out, schema)

    return best.select("district", "uids", "lengths", "best").mapInArrow(run, "uid bigint, length int, sequence_id bigint, offset bigint")
