"""Ranked lexical search over a bit-sliced impact index.

A term's impact in a document is an integer (see `impact`), so a document's score is a sum of integers. The index keeps,
for each block of at most BLOCK documents and each term, the impacts as bitmaps over the block's places, one for each
bit; bytes that no document of the term falls in are left out. A query adds the bitmaps of its terms with
carries, for all places and a batch of queries at a time, and never looks at one document alone. The best k of a block are
found from the highest bitmap downwards: places that have the bit while more than k do stay, else they are in, and so on;
what is tied at the end goes by id.

`postings` reads every text once and writes, for each block, its documents' lengths and the places and counts of asked
terms. `index` turns that into bitmaps without a shuffle, as corpus statistics are known by then: what is shuffled for
these is a row for each term and task. `lookup` keeps the best k a query of its task, and a window ranks what the tasks
found. Queries are broadcast in chunks of CHUNK_BYTES of text at most; more of them take several passes over the texts.

Terms: maximal stretches of letters and digits of ASCII and of all characters beyond it; A-Z become lower case,
nothing else does. Defined cases: a null or empty text has no terms; a document without an id counts in the statistics
but can't be found; repeated rows are documents of their own; queries with a null id are left out, and of repeated
query ids the row with the greatest text is asked. A query without terms, or whose terms weigh nothing, finds none. Empty
tables find none. Texts of any length are read whole.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import cut, prepare
from trackloom.llm.topk import Best

BLOCK, CHUNK_BYTES = 8192, 16 << 20
#: Queries whose sums are held at once, and bits of a sum.
BATCH, BITS = 256, 63
#: Postings in a row batch that leaves a task.
SENT = 1 << 18

_table = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

POSTINGS = "block bigint, term binary, ids array<bigint>, ns array<bigint>, held bigint, length bigint, places array<int>, counts array<bigint>"
_postings = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("ids", pa.list_(pa.int64())), ("ns", pa.list_(pa.int64())), ("held", pa.int64()), ("length", pa.int64()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
INDEX = "block bigint, term binary, ids array<bigint>, at binary, slices binary"
_index = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("ids", pa.list_(pa.int64())), ("at", pa.binary()), ("slices", pa.binary())])


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (text or b"").translate(_table).split()


def impact(weight: int, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """w * ((1000000000 * tf) div (1000 * tf + 8 * m)), with m = 100 - 75 + ((75 * n * N) div L)."""
    m = 100 - 75 + (75 * n * documents) // length
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def postings(docs: DataFrame, asked: list[bytes]) -> DataFrame:
    """A row for each block of documents, and one for each block and asked term."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(frozenset(asked))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, number = sent.value, TaskContext.get().partitionId() << 32
        ids, ns, places, counts = [], [], {}, {}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, ns, places, counts
            yield pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "ns": ns, "held": sum(n > 0 for n in ns), "length": sum(ns)}], _postings)
            names = sorted(places)
            while names:
                few, size = [], 0
                while names and size < SENT:
                    few.append(names.pop())
                    size += len(places[few[-1]])
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x[t]) for t in few)]), pa.int32()), pa.array(np.concatenate([np.asarray(x[t]) for t in few]))) for x in (places, counts)]
                none = [pa.nulls(len(few), _postings.field(c).type) for c in ("ids", "ns", "held", "length")]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(few), pa.int64()), pa.array(few, pa.binary()), *none, *lists], schema=_postings)
            number += 1
            ids, ns, places, counts = [], [], {}, {}

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                found = terms(text)
                tf = Counter(found)
                for t in tf.keys() & wanted:
                    if t not in places:
                        places[t], counts[t] = array("i"), array("q")
                    places[t].append(len(ids))
                    counts[t].append(tf[t])
                ids.append(doc_id)
                ns.append(len(found))
                if len(ids) == BLOCK:
                    yield from flush()
        if ids:
            yield from flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(read, POSTINGS)


def sliced(places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that `places` fall in, ascending, and the values' bitmaps over them, from the lowest bit on."""
    at, column = np.unique(places >> 3, return_inverse=True)
    bits = int(values.max(initial=0)).bit_length()
    spread = np.zeros((bits, len(at) * 8), bool)
    spread[:, column * 8 + (places & 7)] = (values[None, :] >> np.arange(bits)[:, None]) & 1
    return at.astype(np.uint16), np.packbits(spread, axis=1)


def index(found: DataFrame, weights: dict[bytes, int], documents: int, length: int) -> DataFrame:
    """The bitmaps of `postings`: for each block a row with its ids, then one for each term that weighs something."""
    sent = found.sparkSession.sparkContext.broadcast(weights)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ns = np.empty(0, np.int64)
        for batch in batches:
            out, size = [], 0
            for k, term in enumerate(batch.column(1).to_pylist()):
                block = batch.column(0)[k].as_py()
                if term is None:
                    ns = np.asarray(batch.column(3)[k].values, np.int64)
                    out.append({"block": block, "ids": batch.column(2)[k].as_py()})
                elif sent.value.get(term, 0) > 0:
                    places, tf = (batch.column(c)[k].values.to_numpy() for c in (6, 7))
                    at, slices = sliced(places, impact(sent.value[term], tf, ns[places], documents, length))
                    out.append({"block": block, "term": term, "at": at.tobytes(), "slices": slices.tobytes()})
                    size += slices.size
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, _index)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, _index)

    return found.mapInArrow(build, INDEX)


def add(sums: np.ndarray, rows: np.ndarray, at: np.ndarray, slices: np.ndarray, shift: int) -> None:
    """Adds bitmaps, times 2 ** shift, to those of queries `rows` (sums: bit, query, byte), by carries."""
    here = np.ix_(rows, at)
    carry = np.zeros((len(rows), len(at)), np.uint8)
    for bit in range(shift, BITS):
        if bit - shift >= len(slices):
            if not carry.any():
                return
            more = np.zeros(len(at), np.uint8)
        else:
            more = slices[bit - shift]
        old = sums[bit][here]
        half = old ^ more
        sums[bit][here] = half ^ carry
        carry = (old & more) | (half & carry)


def best_places(sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (query, byte) of the places among the k best for certain, and of those tied for what is left of k; sums of 0 are in neither."""
    tied = np.bitwise_or.reduce(sums, axis=0)
    sure = np.zeros_like(tied)
    for plane in sums[::-1]:
        if not plane.any():
            continue
        high = sure | (tied & plane)
        n = np.bitwise_count(high).sum(axis=1, dtype=np.int64)
        more = (n > k)[:, None]
        tied = np.where(more, tied & plane, tied & ~plane)
        tied[n == k] = 0
        sure = np.where(more, sure, high)
    return sure, tied


def values_at(sums: np.ndarray, query: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The sums of some places of some queries as integers."""
    bits = (sums[:, query, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
    return (bits.astype(np.int64) << np.arange(len(sums))[:, None]).sum(axis=0)


class Asked:
    """Queries by term: for each, batches of (queries of the batch, shift), so that a repeated term adds its binary multiples."""

    def __init__(self, queries: list[Counter]):
        self.n, by = len(queries), {}
        for q, counted in enumerate(queries):
            for term, n in counted.items():
                for shift in range(n.bit_length()):
                    if n >> shift & 1:
                        by.setdefault(term, {}).setdefault((q // BATCH, shift), []).append(q % BATCH)
        self.batches = [{t: [(np.array(rows), shift) for (b, shift), rows in x.items() if b == number] for t, x in by.items() if any(b == number for b, _ in x)} for number in range(-(-self.n // BATCH))]


def answer(asked: Asked, ids: list[int | None], block: dict[bytes, tuple[np.ndarray, np.ndarray]], best: Best) -> None:
    """Adds the best places of a block to `best`."""
    width = -(-len(ids) // 8)
    known = np.array([i is not None for i in ids])
    numbers = np.array([i if i is not None else 0 for i in ids], np.int64)
    mask = np.packbits(known)
    for number, queries in enumerate(asked.batches):
        sums = np.zeros((BITS, min(BATCH, asked.n - number * BATCH), width), np.uint8)
        for term in queries.keys() & block.keys():
            for rows, shift in queries[term]:
                add(sums, rows, *block[term], shift)
        sums &= mask
        sure, tied = best_places(sums, best.k)
        query, place = np.nonzero(np.unpackbits(sure | tied, axis=1))
        best.add(query + number * BATCH, values_at(sums, query, place), numbers[place])


def lookup(indexed: DataFrame, queries: list[tuple[int, Counter]], k: int) -> DataFrame:
    """(query_id, doc_id, score): the k best of each task, by query."""
    sent = indexed.sparkSession.sparkContext.broadcast(queries)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, best, ids, block = Asked([c for _, c in sent.value]), Best(k), None, {}
        for batch in batches:
            for number, term, own, at, slices in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if term is None:
                    if ids is not None:
                        answer(asked, ids, block, best)
                    ids, block = own, {}
                else:
                    places = np.frombuffer(at, np.uint16)
                    block[term] = places, np.frombuffer(slices, np.uint8).reshape(-1, len(places))
        if ids is not None:
            answer(asked, ids, block, best)
        names = np.array([i for i, _ in sent.value], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names[best.query]), pa.array(best.id), pa.array(best.score)], names=["query_id", "doc_id", "score"])

    return indexed.mapInArrow(over, "query_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, query_id: str, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best of `docs` (doc_id, text) for each of `queries` (query_id, text)."""
    asked = cut(queries.where(F.col(query_id).isNotNull()).groupBy(F.col(query_id).cast("bigint").alias("query_id")).agg(F.max("text").alias("text")))
    size = asked.agg(F.sum(F.octet_length("text").cast("bigint") + 64)).first()[0] or 0
    chunks = size // CHUNK_BYTES + 1
    found = None
    for chunk in range(chunks):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(chunks)) == chunk).toArrow()  # about CHUNK_BYTES
        counted = [(i, Counter(terms(t))) for i, t in zip(rows["query_id"].to_pylist(), rows["text"].cast(pa.binary()).to_pylist(), strict=True)]
        counted = sorted((x for x in counted if x[1]), key=lambda x: x[0])
        read = cut(postings(docs, sorted({t for _, c in counted for t in c})))
        stats = read.agg(F.sum("held").alias("documents"), F.sum("length").alias("length")).first()
        documents, length = stats["documents"] or 0, stats["length"] or 0
        weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("bigint")
        weights = read.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum(F.size("places")).alias("df")).select("term", weight.alias("w")).toArrow()  # terms of the chunk
        indexed = cut(index(read, dict(zip(weights["term"].to_pylist(), weights["w"].to_pylist(), strict=True)), documents, length))
        part = lookup(indexed, counted, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
