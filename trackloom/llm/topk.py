"""Exact top-k inner-product search by three-phase uniform threshold.

The dimensions are cut into `lists` stretches; for a query, a stretch ranks all vectors by their partial score in
it. (1) Each block of vectors gathers the best k entries of one list, the lists by turns, and the totals of those
few entries alone; the k-th best total seen is a safe cutoff, as k vectors reach it. (2) The cutoff is broadcast
with the queries. A vector whose total reaches it has a partial score of cutoff / lists at least in some list, so
each block scores its lists, as products of matrices, and collects the entries that pass this uniform threshold in one of
them. (3) Those alone are resolved: their totals are compared with the cutoff and compete, and a task sends its best k a
query on. Few lists prune best: partial scores of unrelated vectors spread as the root of a list's length, the threshold
as the length itself.

Queries of up to CHUNK_BYTES are broadcast, and no vector moves. More queries are dealt to chunks of that size and
the vectors to cells of about CELL_BYTES; each chunk meets each cell as one group of a cogroup, so any number of
queries takes one plan of two passes, and no task holds more than a chunk and a cell.

Components x count as floor(1024 * x). Vectors that are null, or hold null or non-finite components, take no
part. A vector shorter than another counts as padded with zeros. Null ids take no part. A repeated id as a
query is asked once, with the row of the greatest vector; as candidates, repeated rows compete each for itself.
Ties go to the smaller id. Empty tables give empty results. Sums are exact: in doubles where they fit 53 bits,
else in 64-bit or Python's integers; a score beyond a long is returned as the nearest long, and ranked by its true value.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import cut, prepare

CHUNK_BYTES, CELL_BYTES = 16 << 20, 32 << 20
SCALE = 1024.0
#: Stretches of dimensions; see above for why they are few.
LISTS = 2
#: Numbers held at once, per block of vectors.
CELLS = 2 << 20
LEAST, MOST = -(1 << 63), (1 << 63) - 1
SCHEMA = "query_id bigint, vec_id bigint, score bigint, wide binary"
_arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("wide", pa.binary())])


def whole_vectors(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components, a row each, of the entries that take part; short ones end in zeros."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    fine = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid()) & np.isfinite(out).all(axis=1)
    return ids.filter(pa.array(fine)).to_numpy(zero_copy_only=False).astype(np.int64), out[fine]


def blocks(batches: Iterator[pa.RecordBatch], n_queries: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """whole_vectors() of stretches of the batches, of CELLS numbers or scores at most."""
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(batch):
            n = min(len(batch) - at, max(1, CELLS // max(n_queries, 1)))
            while n > 1 and n * int(lengths[at : at + n].max()) > CELLS:
                n //= 2
            part = batch.slice(at, n)
            yield whole_vectors(part.column(0), part.column(1))
            at += n


class Asked:
    """Queries with their cutoffs; None is no cutoff yet."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        column = lambda c: table.column(c).combine_chunks() if isinstance(table, pa.Table) else table.column(c)
        self.ids, self.vectors = whole_vectors(column("vec_id"), column("embedding"))
        known = dict(zip(table.column("vec_id").to_pylist(), table.column("cutoff").to_pylist(), strict=True))
        self.cutoffs = [known[int(i)] for i in self.ids]


def sides(asks: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Both sides over the dimensions that both have, and the bits that a component may have for sums to fit 53 bits."""
    dim = min(asks.shape[1], block.shape[1])
    return asks[:, :dim], block[:, :dim], (53 - max(dim, 1).bit_length()) // 2


def narrow(side: np.ndarray, bits: int) -> np.ndarray:
    return (np.abs(side) < 2.0**bits / SCALE).all(axis=1)


def scaled(side: np.ndarray) -> np.ndarray:
    return np.floor(side * SCALE)


def integers(side: np.ndarray) -> np.ndarray:
    """Components as Python's integers; doubles of 2**60 and more are whole, and times 1024 may leave their range."""
    whole = [[int(x) * int(SCALE) if abs(x) > 2.0**60 else math.floor(x * SCALE) for x in row] for row in side.tolist()]
    return np.array(whole, object).reshape(side.shape)


def stretches(dim: int, lists: int) -> list[tuple[int, int]]:
    edges = [dim * j // lists for j in range(lists + 1)]
    return list(zip(edges, edges[1:], strict=False))


class Best:
    """The best k (score, id) of each query, scores downward, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.query, self.score, self.id = k, *(np.empty(0, np.int64) for _ in range(3))
        self.wide: dict[int, list[tuple[int, int]]] = {}

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query = query[order]
        starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.empty(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        keep = order[rank < self.k]
        self.query, self.score, self.id = query[rank < self.k], score[keep], ids[keep]

    def add_wide(self, query: int, found: Iterator[tuple[int, int]]) -> None:
        """Totals of any size, as (total, id)."""
        self.wide[query] = heapq.nsmallest(self.k, [*self.wide.get(query, []), *found], key=lambda x: (-x[0], x[1]))

    def rows(self, ids: np.ndarray) -> pa.RecordBatch:
        wide = [(int(ids[q]), i, min(max(n, LEAST), MOST), sortable(n)) for q, found in self.wide.items() for n, i in found]
        columns = list(zip(*wide, strict=True)) or [()] * 4
        narrow_rows = [ids[self.query].tolist(), self.id.tolist(), self.score.tolist(), [None] * len(self.query)]
        return pa.RecordBatch.from_arrays([pa.array([*a, *b], t) for a, b, t in zip(narrow_rows, columns, _arrow.types, strict=True)], schema=_arrow)


def sortable(n: int) -> bytes | None:
    """A total beyond a long as bytes that order like it; None for others, which come after those at a long's top end."""
    if LEAST < n <= MOST:
        return None
    size = (abs(n).bit_length() + 7) // 8
    return (0x8000 + size).to_bytes(2) + n.to_bytes(size) if n > 0 else (0x7FFF - size).to_bytes(2) + ((1 << 8 * size) + n).to_bytes(size + 1)[-size:]


def gather(asked: Asked, batches: Iterator[pa.RecordBatch], k: int, lists: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: the totals of the best k entries of one list of each block."""
    best = Best(k)
    for turn, (own, block) in enumerate(blocks(batches, len(asked.ids))):
        asks, block, bits = sides(asked.vectors, block)
        q_at, c_at = np.flatnonzero(narrow(asks, bits)), np.flatnonzero(narrow(block, bits))
        if not len(q_at) or not len(c_at):
            continue
        q, b, own = scaled(asks[q_at]), scaled(block[c_at]), own[c_at]
        a, z = stretches(q.shape[1], lists)[turn % lists]
        score = np.where(own[None, :] == asked.ids[q_at][:, None], -np.inf, q[:, a:z] @ b[:, a:z].T)
        few = min(k, len(own))
        at = np.argpartition(-score, few - 1, axis=1)[:, :few]
        qs, cs = np.repeat(np.arange(len(q)), few), at.ravel()
        there = score[qs, cs] > -np.inf
        qs, cs = qs[there], cs[there]
        for part in range(0, len(qs), 1 << 14):  # bounded gathers
            x, y = qs[part : part + (1 << 14)], cs[part : part + (1 << 14)]
            best.add(q_at[x], np.einsum("ij,ij->i", q[x], b[y]).astype(np.int64), own[y])
    yield best.rows(asked.ids)


def resolve(asked: Asked, batches: Iterator[pa.RecordBatch], k: int, lists: int) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3: the entries over the uniform threshold, and the totals of those that can reach the cutoff."""
    best = Best(k)
    cutoff = np.array([-np.inf if c is None else float(c) * (1 - np.sign(c) * 2.0**-50) for c in asked.cutoffs])  # rounded downward
    for own, block in blocks(batches, len(asked.ids)):
        asks, block, bits = sides(asked.vectors, block)
        q_fine, c_fine = narrow(asks, bits), narrow(block, bits)
        q_at, c_at = np.flatnonzero(q_fine), np.flatnonzero(c_fine)
        if len(q_at) and len(c_at):
            q, c, total = survivors(scaled(asks[q_at]), scaled(block[c_at]), cutoff[q_at], asked.ids[q_at], own[c_at], lists)
            best.add(q_at[q], total, own[c_at][c])
        for rows, columns in ((np.flatnonzero(~q_fine), np.arange(len(own))), (q_at, np.flatnonzero(~c_fine))):
            if len(rows) and len(columns):
                wide_totals(best, asked, rows, asks[rows], own[columns], block[columns])
    yield best.rows(asked.ids)


def passing(q: np.ndarray, b: np.ndarray, cutoff: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each (query, vector) is over the uniform threshold in some list, and its total."""
    level = np.floor(cutoff / lists)[:, None]
    over, total = np.zeros((len(q), len(b)), bool), np.zeros((len(q), len(b)))
    for a, z in stretches(q.shape[1], lists):
        local = q[:, a:z] @ b[:, a:z].T
        over |= local >= level
        total += local
    return over, total


def survivors(q: np.ndarray, b: np.ndarray, cutoff: np.ndarray, ids: np.ndarray, own: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, total) of the pairs whose totals reach the cutoff: those over the threshold in some list, resolved."""
    over, total = passing(q, b, cutoff, lists)
    pairs = np.nonzero(over & (own[None, :] != ids[:, None]))
    score = total[pairs]
    keep = score >= cutoff[pairs[0]]
    return pairs[0][keep], pairs[1][keep], score[keep].astype(np.int64)


def wide_totals(best: Best, asked: Asked, rows: np.ndarray, asks: np.ndarray, own: np.ndarray, block: np.ndarray) -> None:
    """Totals of pairs that may pass 53 bits: in 64-bit integers where they fit, else in Python's."""
    most = float(np.abs(asks).max(initial=0)) * SCALE + 1, float(np.abs(block).max(initial=0)) * SCALE + 1
    fits = math.log2(most[0]) + math.log2(most[1]) + math.log2(max(asks.shape[1], 1)) < 62 if all(map(math.isfinite, most)) else False
    b = scaled(block).astype(np.int64) if fits else integers(block)
    for r, ask in zip(rows.tolist(), asks, strict=True):
        total = b @ (scaled(ask).astype(np.int64) if fits else integers(ask[None, :])[0])
        low = asked.cutoffs[r]
        best.add_wide(r, ((int(n), int(i)) for n, i in zip(total.tolist(), own.tolist(), strict=True) if i != asked.ids[r] and (low is None or n >= low)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of `vectors` (vec_id, embedding) for each of `queries`, but itself."""
    prepare(vectors.sparkSession)
    vectors = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    asked = cut(queries.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.max("embedding").alias("embedding"))).withColumn("cutoff", F.lit(None).cast("bigint"))
    shape = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    chunks = shape["n"] * ((shape["dim"] or 0) + 1) * 8 // CHUNK_BYTES + 1
    run = _beside if chunks == 1 else _grid
    order = [F.col("score").desc(), F.col("wide").desc_nulls_last(), F.col("vec_id")]
    ranked = Window.partitionBy("query_id").orderBy(*order)
    seen = run(vectors, asked, chunks, lambda a, batches: gather(a, batches, k, lists)).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    reached = cut(seen.groupBy("query_id").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "cutoff"))
    asked = asked.drop("cutoff").join(reached, "vec_id", "left")
    found = run(vectors, asked if chunks == 1 else cut(asked), chunks, lambda a, batches: resolve(a, batches, k, lists))
    ranks = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return ranks.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _beside(vectors: DataFrame, asked: DataFrame, chunks: int, kernel: Callable) -> DataFrame:
    """The kernel over each partition of the vectors, beside all queries: CHUNK_BYTES of them at most."""
    sent = vectors.sparkSession.sparkContext.broadcast(asked.toArrow())

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(Asked(sent.value), batches)

    return vectors.mapInArrow(over, SCHEMA)


def _grid(vectors: DataFrame, asked: DataFrame, chunks: int, kernel: Callable) -> DataFrame:
    """The kernel over each cell of the vectors with each chunk of the queries.

    Rows are dealt to cells by their places in the table, not by their ids, so that a repeated id is spread.
    """
    size = vectors.agg(F.sum(F.coalesce(F.size("embedding"), F.lit(0)).cast("long") * 8 + 16)).first()[0] or 0
    cells = size // CELL_BYTES + 1
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n - 1))))
    left = vectors.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)).cast("int")).withColumn("chunk", each(chunks))
    right = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")).withColumn("cell", each(cells))

    def over(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not rows.num_rows or not asks.num_rows:
            return _arrow.empty_table()
        return pa.Table.from_batches(kernel(Asked(asks), rows.select(["vec_id", "embedding"]).to_batches(max_chunksize=10_000)), _arrow)

    return left.groupBy("chunk", "cell").cogroup(right.groupBy("chunk", "cell")).applyInArrow(over, SCHEMA)
