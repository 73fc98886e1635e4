"""Near-duplicates: SimHash fingerprints with pigeonhole blocks, MinHash bands, verified links, connected components.

A fingerprint of 64 bits is the bitwise majority of the XXH64 values of a text's word shingles. To find all
pairs of at most `max_bits` differing bits, the bits are dealt to max_bits + r blocks: such a pair agrees on
r blocks at least, so it shares the key of one of the C(max_bits + r, r) choices of r blocks. r grows with
the number of distinct fingerprints, so that chance seldom puts two into one bucket.

Within a bucket a search over the rows not yet reached verifies distances and emits a spanning forest, never
all pairs: n - 1 links at most for n fingerprints. A bucket of over BUCKET fingerprints is keyed again: a close pair
in it agrees on some of the blocks that its other bits are dealt to. As its fingerprints differ, each step halves
or at least shrinks what they can differ in, so no task ever holds a larger bucket and no row meets all others.
Equal fingerprints are one node from the start. Components come from alternating large-star and small-star
rounds on the cluster.

near_copies() goes by resemblance instead, the Jaccard measure of sets of word shingles. Signatures are BANDS * BAND
true MinHash values, so a pair of resemblance J shares no band with a chance of (1 - J**BAND)**BANDS, however its
edits lie: 2 in 10,000 at 0.8. Buckets beyond BUCKET sets or BUCKET_BYTES are dealt to chunks in DEALS ways and linked
within those; what then is one component needs no more comparing. Only sets outside a bucket's largest component are
compared with all of it, chunk by chunk, which is exact and costs in proportion to those few.

Nulls: a null text is empty, with fingerprint zero, and links like any other. A component's id is its
smallest non-null doc_id. Repeated rows are kept and share a component. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import attach, beside, cut, prepare

#: Rows of one bucket that a task compares at once; larger buckets are keyed again or dealt to chunks.
BUCKET = 1024
#: Ways in which a large bucket is dealt to chunks.
DEALS = 2
SEED = 42
#: Bands of a MinHash signature, and values in a band.
BANDS, BAND = 36, 7
#: Pairs whose resemblance two bits of each value put under this are not compared. At 0.8, 3 in 100,000 are.
LOOSE = 0.68
#: Bytes of one bucket's sets that a task holds at once, about.
BUCKET_BYTES = 16 << 20
_odd = np.array([xxhash.xxh64_intdigest(b"%d" % i, SEED) | 1 for i in range(BANDS * BAND)], np.uint64)


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The fingerprint of a UTF-8 text: A-Z lower-cased, words between ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)], np.uint64)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):  # long texts in bounded memory
        bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint as a signed long, for each row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())], names=[key, "fp"])

    prepare(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(compute, f"`{key}` {kind}, fp bigint")


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    k = min(size, len(words))
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)], np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash: the least of the hashes under each of BANDS * BAND multipliers."""
    out = np.full(len(_odd), np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(hashes), 256):
        np.minimum(out, (hashes[part : part + 256, None] * _odd).min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A key for each band of each row, int64."""
    parts = signatures.reshape(-1, BANDS, BAND)
    key = np.zeros(parts.shape[:2], np.uint64)
    for i in range(BAND):
        key = (key ^ parts[:, :, i]) * _odd[i]
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def two_bits(signatures: np.ndarray) -> list[bytes]:
    """Two bits of each value, in 64 bytes a row: all first bits, then all second bits."""
    bits = np.zeros((len(signatures), 2, 256), bool)
    for i in range(2):
        bits[:, i, : len(_odd)] = signatures >> np.uint64(24 + i) & np.uint64(1)
    return [row.tobytes() for row in np.packbits(bits.reshape(-1, 512), axis=1)]


def block_masks(n: int, max_bits: int, crowd: int = 0, within: int = (1 << 64) - 1) -> list[int]:
    """Masks of the choices of blocks of the bits `within` for `n` distinct fingerprints, of 2**`crowd` or fewer by chance in a bucket."""
    places = [i for i in range(64) if within >> i & 1]
    most = len(places) - max_bits
    r = next((r for r in range(1, most) if len(places) * r // (max_bits + r) >= max(n, 2).bit_length() - crowd), most)
    edges = [len(places) * i // (max_bits + r) for i in range(max_bits + r + 1)]
    masks = [sum(1 << i for i in places[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, r)]


def forest(n: int, near) -> list[tuple[int, int]]:
    """A spanning forest of the links among n rows; near(i, rows) tells which of the rows link to row i."""
    links: list[tuple[int, int]] = []
    left = np.arange(n)
    while len(left) > 1:
        reach, left = [int(left[0])], left[1:]
        while reach and len(left):
            node = reach.pop()
            hit = near(node, left)
            if hit.any():
                hits = left[hit].tolist()
                links.extend((node, h) for h in hits)
                reach.extend(hits)
                left = left[~hit]
    return links


def within_bits(ids: np.ndarray, data: np.ndarray | None, max_bits: int):
    """near() of fingerprints that differ in at most `max_bits` bits."""
    fps = ids.view(np.uint64)  # of a signed number bitwise_count counts the absolute value's bits
    return lambda i, rows: np.bitwise_count(fps[rows] ^ fps[i]) <= max_bits


def loosely_alike(ids: np.ndarray, data: np.ndarray | None, least: float):
    """near() of two_bits() whose estimated resemblance is `least` or more."""
    bits = np.frombuffer(b"".join(data), np.uint64).reshape(-1, 8)
    most = (1 - least) * 0.75 * len(_odd)  # values that differ agree in two bits once in four

    def near(i: int, rows: np.ndarray) -> np.ndarray:
        apart = bits[rows] ^ bits[i]
        return np.bitwise_count(apart[:, :4] | apart[:, 4:]).sum(axis=1) <= most

    return near


def resembling(ids: np.ndarray, data: np.ndarray | None, least: float):
    """near() by the exact Jaccard of whole sets; `data` holds 64 bytes of two_bits(), then the sorted hashes.

    Pairs whose sizes are too far apart, or estimated under LOOSE, are rejected before their sets are compared.
    """
    sizes = np.array([len(x) // 8 - 8 for x in data])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    codes = np.unique(np.frombuffer(b"".join(x[64:] for x in data), np.uint64), return_inverse=True)[1]
    close = loosely_alike(ids, [x[:64] for x in data], LOOSE)
    own = np.zeros(codes.max(initial=-1) + 1, bool)

    def near(i: int, rows: np.ndarray) -> np.ndarray:
        out = (np.minimum(sizes[rows], sizes[i]) >= least * np.maximum(sizes[rows], sizes[i]) - 1e-9) & close(i, rows)
        mine = codes[starts[i] : ends[i]]
        own[mine] = True
        for at in np.flatnonzero(out).tolist():
            row = rows[at]
            shared = np.count_nonzero(own[codes[starts[row] : ends[row]]])
            out[at] = shared >= least * (sizes[i] + sizes[row] - shared) - 1e-9
        own[mine] = False
        return out

    return near


def connected(rows: DataFrame, groups: list[str], near, limit: float, data: DataFrame | None = None) -> DataFrame:
    """(u, v), u > v, bigint: a spanning forest of the links within each group of bounded size.

    `rows` has the group columns and `id`; ids of a group are distinct. What else the test needs is in `data` (id, data),
    binary. near(ids, data, limit) makes the test.
    """
    extra = [] if data is None else ["data"]

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of equal groups of a sorted partition, one after the other."""
        width = len(groups)
        held, held_data = np.empty((0, width + 1), np.int64), None
        found: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            pairs = np.array(found, np.int64).reshape(-1, 2)
            found.clear()
            return pa.RecordBatch.from_pydict({"u": pa.array(pairs.max(axis=1)), "v": pa.array(pairs.min(axis=1))})

        def runs(rows: np.ndarray, data: np.ndarray | None, last: bool) -> int:
            """Links the whole runs; returns where the last one begins."""
            if not len(rows):
                return 0
            starts = np.flatnonzero(np.concatenate(([True], (rows[1:, :width] != rows[:-1, :width]).any(axis=1))))
            ends = np.append(starts[1:], len(rows))
            whole = ends - starts > 1
            if not last:
                whole[-1] = False
            for a, b in zip(starts[whole].tolist(), ends[whole].tolist(), strict=True):
                ids = np.ascontiguousarray(rows[a:b, width])
                found.extend((int(ids[x]), int(ids[y])) for x, y in forest(b - a, near(ids, None if data is None else data[a:b], limit)))
            return len(rows) if last else int(starts[-1])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[: width + 1]], axis=1)
            held = np.concatenate([held, rows])
            if extra:
                data = np.array([*batch.columns[-1].to_pylist(), None], object)[:-1]
                held_data = data if held_data is None or not len(held_data) else np.concatenate([held_data, data])
            at = runs(held, held_data, False)
            held, held_data = held[at:], None if held_data is None else held_data[at:]
            if len(found) > 100_000:
                yield out()
        runs(held, held_data, True)
        yield out()

    dealt = (rows if data is None else rows.join(data, "id")).repartition(*groups).sortWithinPartitions(*groups, "id")
    return dealt.select(*groups, "id", *extra).mapInArrow(connect, "u bigint, v bigint").distinct()


def bucket_links(rows: DataFrame, groups: list[str], near, limit: float, data: DataFrame) -> DataFrame:
    """(u, v), u > v, bigint: links that connect, over all buckets, what connected() would within each; any size of bucket.

    `rows`, cheap to read again, may have a `size` in bytes. Buckets are counted by partial aggregates. A small one is one
    group. A large one is dealt to chunks by a hash of id and bucket, DEALS times; see the module's text for the rest.
    """
    size = F.sum("size") if "size" in rows.columns else F.lit(0)
    chunks = F.greatest(F.ceil(F.count(F.lit(1)) / BUCKET), F.least(F.count(F.lit(1)), F.ceil(size / BUCKET_BYTES))).cast("int")
    several = cut(rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), chunks.alias("chunks")).where("n > 1"))
    left = several.agg(F.sum("n")).first()[0] or 0
    counted = cut(rows.select(*groups, "id").join(beside(several.drop("n")), groups), left)
    deal = lambda k: F.pmod(F.xxhash64("id", *groups, F.lit(k)), F.col("chunks")).cast("int")
    found = connected(counted.where("chunks = 1").select(*groups, "id"), groups, near, limit, data)
    large = counted.where("chunks > 1")
    if large.isEmpty():
        return cut(found, left)
    for k in range(DEALS):
        found = found.union(connected(large.select(*groups, deal(k).alias("own"), "id"), [*groups, "own"], near, limit, data))
    links = cut(found, (1 + DEALS) * left)
    roots = components(links)
    labelled = cut(large.join(roots, F.col("id") == F.col("node"), "left").select(*groups, "id", F.coalesce("root", "id").alias("root")), left)
    shares = cut(labelled.groupBy(*groups, "root").agg(F.count(F.lit(1)).alias("n")), left)
    spread = shares.groupBy(*groups).agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all")).where(F.col("all") > F.col("most.n"))
    apart = cut(spread.select(*groups, F.col("most.root").alias("main"), F.ceil((F.col("all") - F.col("most.n")) / BUCKET).cast("int").alias("minors")).join(several, groups), left)
    if apart.isEmpty():
        return links
    parted = labelled.join(beside(apart), groups)
    other = F.pmod(F.xxhash64("id", F.lit("minor")), F.col("minors")).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    # a minor chunk j meets each chunk i of the main component, and minor chunk i as -1 - i
    main = parted.where("root = main").select(*groups, "id", deal(0).alias("i"), F.explode(each(F.col("minors"))).alias("j"))
    minor = parted.where("root <> main").withColumn("own", other)
    beside_main = minor.select(*groups, "id", F.explode(each(F.col("chunks"))).alias("i"), F.col("own").alias("j"))
    among = minor.select(*groups, "id", "own", F.explode(each(F.col("minors"))).alias("x")).select(*groups, "id", (-1 - F.least("own", "x")).alias("i"), F.greatest("own", "x").alias("j"))
    rest = connected(main.unionByName(beside_main).unionByName(among), [*groups, "i", "j"], near, limit, data)
    return cut(links.union(rest).distinct())


def links(nodes: DataFrame, max_bits: int = 4, crowd: int = 0) -> DataFrame:
    """(u, v), u > v: links that connect all fingerprints of `nodes`.fp, distinct, within `max_bits` of each other."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    rows = nodes.count()
    choices = F.array(*(F.lit(signed(m)) for m in block_masks(rows, max_bits, crowd)))
    keyed, groups, found = nodes.select(F.col("fp").alias("id"), F.explode(choices).alias("mask")), ["mask", "key"], None
    while True:
        keyed = keyed.withColumn("key", F.col("id").bitwiseAND(F.col("mask")))
        hot = cut(keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET))
        crowded = {r["mask"]: r["n"] for r in hot.groupBy("mask").agg(F.max("n").alias("n")).collect()}  # a row for each choice of blocks
        # what differs in max_bits places at most needs no other key, and has no more than 2**max_bits rows
        finer = {m: [signed(m % (1 << 64) | x) for x in block_masks(n, max_bits, BUCKET.bit_length() - 3, ~m % (1 << 64))] for m, n in crowded.items() if (~m % (1 << 64)).bit_count() > max_bits}
        few = beside(hot.where(F.col("mask").isin(list(finer))).select(*groups))
        part = connected(keyed.join(few, groups, "left_anti") if finer else keyed, groups, within_bits, max_bits)
        found = part if found is None else found.union(part)
        if not finer:
            return cut(found.distinct(), rows)
        again = F.create_map(*(x for m, subs in finer.items() for x in (F.lit(m), F.array(*map(F.lit, subs)))))
        keyed = cut(keyed.join(few, groups).select("id", F.explode(again[F.col("mask")]).alias("mask")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each end of the edges (u, v), u > v, written by cut(): root is the smallest node reachable."""
    seen, rows = None, edges.count()
    while True:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = cut(attach(both, least, "u", 2 * rows).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), rows)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = attach(large, least, "u", rows).select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
        edges = cut(small.where("u <> v").distinct(), 2 * rows)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen, rows = now, now[0]


def named(nodes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """(key, n, component_id) for `nodes` (key, least, n): the least of each component's, by components() of the keys."""
    rooted = cut(nodes.join(roots, F.col(key) == F.col("node"), "left").select(key, "least", F.col("n").alias("copies"), F.coalesce("root", key).alias("root")))
    joined = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    return attach(rooted, joined, "root", rooted.count()).select(key, F.col("copies").alias("n"), "component_id")


def group(fps: DataFrame, max_bits: int = 4, key: str = "doc_id") -> DataFrame:
    """`fps` (key, fp), written by cut(), with component_id, the smallest key of the component."""
    nodes = cut(fps.groupBy("fp").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("n")))
    found = named(nodes, components(links(nodes.select("fp"), max_bits)), "fp")
    return attach(fps, found, "fp", fps.count()).select(key, "fp", "component_id")


def fingerprint_links(rows: DataFrame, max_bits: int = 4) -> DataFrame:
    """(u, v), u > v: links that connect the ids of `rows` (id, fp), written by cut(), whose fingerprints group() would link."""
    pairs = cut(rows.distinct())
    grouped = group(pairs, max_bits, "id")
    return grouped.where(F.col("id") > F.col("component_id")).select(F.col("id").alias("u"), F.col("component_id").alias("v"))


def near_copies(docs: DataFrame, key: str, least: float = 0.8, text: str = "text") -> DataFrame:
    """(key, component_id) for documents whose five-word shingles resemble each other by `least` or more.

    Texts whose fingerprints differ in 4 bits or fewer meet, by the same pigeonhole blocks as group(), and so do texts that
    share a band of their MinHash signatures, where two bits of each value reject far pairs. Within the groups so linked, each link is verified by the exact Jaccard of the whole sets of 64-bit shingle hashes, which
    are made again for the texts of these groups alone.
    """

    def hashed(x: str | None) -> np.ndarray:
        return shingles((x or "").encode())

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, signed = np.empty(len(batch), np.uint64), np.empty(len(batch), np.int64), np.empty((len(batch), len(_odd)), np.uint64)
            for i, t in enumerate(batch.column(2)):
                found = hashed(t.as_py())
                ids[i], sizes[i], signed[i] = xxhash.xxh64_intdigest(found.tobytes(), SEED), found.nbytes, signature(found)
            fps = [fingerprint((t.as_py() or "").encode()) for t in batch.column(2)]
            bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(signed).ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids.view(np.int64)), pa.array(sizes), bands, pa.array(two_bits(signed), pa.binary()), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], names=["key", "hash", "id", "size", "bands", "bits", "fp"])

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [b + hashed(t.as_py()).tobytes() for b, t in zip(part.column(1).to_pylist(), part.column(2), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["id", "data"])

    prepare(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(key, F.xxhash64(key, text).alias("hash"), text)
    rows = cut(texts.mapInArrow(compute, f"key {kind}, hash bigint, id bigint, size bigint, bands array<bigint>, bits binary, fp bigint"))
    nodes = cut(rows.groupBy("id").agg(F.min("key").alias("least"), F.min("hash").alias("hash"), F.min_by("key", "hash").alias("of"), *(F.first(c).alias(c) for c in ("size", "bands", "bits")), F.count(F.lit(1)).alias("n")))
    keyed = nodes.select("id", F.posexplode("bands").alias("t", "band"))
    met = bucket_links(keyed, ["t", "band"], loosely_alike, LOOSE, nodes.select("id", F.col("bits").alias("data")))
    roots = components(cut(met.union(fingerprint_links(rows.select("id", "fp"))).distinct()))
    several = cut(nodes.join(roots, F.col("id") == F.col("node")).select(F.col("root").alias("bucket"), "id", "hash", "of", "size", "bits"))
    # a text for each set: that of the row whose hash its node holds
    found = texts.join(beside(several.select("hash")), "hash", "left_semi").select("hash", F.col(key).alias("key"), F.col(text).alias("text")).dropDuplicates(["hash", "key"])
    sets = cut(found.join(several, "hash").where("key <=> of").select("id", "bits", "text").mapInArrow(whole_sets, "id bigint, data binary"))
    fine = components(bucket_links(several.select("bucket", "id", "size"), ["bucket"], resembling, least, sets))
    return attach(rows.select("key", "id"), named(nodes, fine, "id"), "id", rows.count()).select("key", "component_id")
