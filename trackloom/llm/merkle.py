"""A Merkle manifest of a table: a tree a group, and a tree over the groups' roots, with a proof for each leaf.

H is the lower-case hex SHA-256 of inputs written one after the other, digests as hex text. Leaves of a group ascend in a
given order; while several nodes remain, each run of FAN consecutive ones (the last may be shorter, even of one)
becomes their H. What remains is the group's subroot; a lone leaf is its own. Subroots, by group, make a tree alike.

How a tree is built (`grow`): leaves are sorted by range, so a group may lie in several parts and a part may hold
several groups. One row for each part (its first and last group with their counts) goes to the driver, and gives each part
the place of its first leaf within its group: a group that ends where it begins needs none. Each part then builds the
complete aligned subtrees over its leaves; what is left of groups that cross parts, a few ragged nodes a level, is shuffled
by the coordinate of an ancestor STRIDE levels up and built on there, until all levels are there. A proof needs,
beside its own part's nodes, the siblings of the two border paths of a part; these come back by a join on their coordinates.
A task holds one part (about ROWS leaves), or the nodes under one coordinate (FAN ** STRIDE at most). Nothing is
broadcast but a row for each part, and subroots as `common.attach` does it.

Defined cases. Null values enter a leaf as `-`; a null group comes first, and null ids first within a group; rows that are
equal in the order are ordered by their leaves, and equal leaves are interchangeable. A repeated row is a leaf each time.
An empty table gives no rows. Proofs of a single leaf hold no siblings, and its root is itself. Columns of the
input may have any names; the leaves' own columns are those that are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import attach, cut, prepare

FAN = 3
#: Levels that one shuffle of ragged nodes builds: 3 ** 6 nodes, 729, under a coordinate at most.
STRIDE = 6
#: Leaves of a part, about 1.3 KB each with their proofs.
ROWS = 32_768

NODE = "group string, level int, index bigint, digest string"
_node = pa.schema([("group", pa.string()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.string())])
_step = pa.struct([("before", pa.string()), ("after", pa.string())])


def join_digests(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(*columns: Column) -> Column:
    """H of the columns: `-` if null, else the UTF-8 byte count, `:` and the value; integers in decimal."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def group_key(column: Column) -> Column:
    """A group's name as a key that is never null and orders like it, null first."""
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column.cast("string")))


def width(n: int, level: int) -> int:
    """Nodes at a level over n leaves."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """The level of the root over n leaves."""
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def subtrees(leaves: list[str], start: int, n: int) -> list[tuple[int, int, str]]:
    """(level, index, digest) of the largest complete aligned subtrees over leaves start.. of n; a whole group gives its root."""
    out: list[tuple[int, int, str]] = []
    level, at, nodes = 0, start, leaves
    while nodes:
        total, end = width(n, level), at + len(nodes)
        if total == 1:
            return [*out, (level, 0, nodes[0])]
        head = min(-at % FAN, len(nodes))  # their run begins in another part
        tail = 0 if end == total else (end % FAN if head < len(nodes) else 0)  # their run ends in another part
        ragged = [*range(head), *range(len(nodes) - tail, len(nodes))]
        out += [(level, at + i, nodes[i]) for i in ragged]
        body = nodes[head : len(nodes) - tail]
        level, at, nodes = level + 1, (at + head) // FAN, [join_digests(body[i : i + FAN]) for i in range(0, len(body), FAN)]
    return out


def built(nodes: list[tuple[int, int, str]], n: int, top: int) -> list[tuple[int, int, str]]:
    """The ancestors, up to level `top` or the root, of nodes that fill the runs they are in."""
    out, by_level = [], {}
    for level, index, digest in nodes:
        by_level.setdefault(level, {})[index] = digest
    for level in range(min(by_level, default=top), min(top, height(n))):
        here = by_level.get(level, {})
        for parent in {i // FAN for i in here}:
            last = min(FAN * parent + FAN, width(n, level))
            digest = join_digests([here[i] for i in range(FAN * parent, last)])
            by_level.setdefault(level + 1, {})[parent] = digest
            out.append((level + 1, parent, digest))
    return out


def paths(leaves: list[str], start: int, n: int, around: dict[tuple[int, int], str]) -> tuple[list[pa.Array], list[np.ndarray], str]:
    """For leaves start.. of n: by level the steps of their proofs, and which of them each leaf takes; and the root.

    `around` has the siblings of the two border paths that lie outside, by (level, index).
    """
    steps, takes = [], []
    at = np.arange(start, start + len(leaves), dtype=np.int64)
    low, nodes, level = start, leaves, 0
    while (total := width(n, level)) > 1:
        high = low + len(nodes)
        first, last = low - low % FAN, min(-(-high // FAN) * FAN, total)
        row = [*(around[level, i] for i in range(first, low)), *nodes, *(around[level, i] for i in range(high, last))]
        before = ["".join(row[i - i % FAN : i]) for i in range(low - first, high - first)]
        after = ["".join(row[i + 1 : i - i % FAN + FAN]) for i in range(low - first, high - first)]
        steps.append(pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(_step)))
        takes.append(at // FAN**level - low)
        nodes = [join_digests(row[i : i + FAN]) for i in range(0, len(row), FAN)]
        low, level = first // FAN, level + 1
    return steps, takes, nodes[0]


def _runs(groups: list[str]) -> list[tuple[int, int]]:
    """Places where stretches of equal groups begin and end."""
    edges = [0, *(i for i in range(1, len(groups)) if groups[i] != groups[i - 1]), len(groups)] if groups else [0]
    return list(zip(edges, edges[1:], strict=False))


def _span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one part: its number, first and last group, and their counts."""
    part, first, last, n_first, n_last = None, None, None, 0, 0
    for batch in batches:
        groups = batch.column(1).to_pylist()
        for a, z in _runs(groups):
            part = batch.column(0)[0].as_py()
            if groups[a] != last:
                last, n_last = groups[a], 0
            n_last += z - a
            first = last if first is None else first
            n_first += z - a if last == first else 0
    if part is not None:
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "first": [first], "n_first": pa.array([n_first], pa.int64()), "last": [last], "n_last": pa.array([n_last], pa.int64())})


def offsets(spans: list[dict]) -> list[dict]:
    """Of groups that cross parts, for each part that has leaves of one: where these begin and how many the group has in all."""
    total: dict[str, int] = {}
    seen, crossing = [], set()
    for s in spans:
        for group, n in dict([(s["first"], s["n_first"]), (s["last"], s["n_last"])]).items():
            crossing |= {group} & total.keys()
            seen.append({"part": s["part"], "group": group, "begins": total.get(group, 0), "n": n})
            total[group] = total.get(group, 0) + n
    return [x | {"total": total[x["group"]]} for x in seen if x["group"] in crossing]


def grow(leaves: DataFrame, order: list[str], rows: int = ROWS) -> DataFrame:
    """`leaves` (_group, _leaf and further columns) with _index, _n (leaves of the group), _root and _proof, an array of (before, after).

    `order` names the columns that order a group. Columns that begin with an underscore are this function's.
    """
    spark = leaves.sparkSession
    prepare(spark)
    parts = max(1, -(-leaves.count() // rows))
    keys = ["_group", *order, "_leaf", "_salt"]  # the salt spreads equal rows over parts
    at = leaves.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    at = cut(at)
    spans = at.select("_part", "_group").mapInArrow(_span, "part int, first string, n_first bigint, last string, n_last bigint").orderBy("part").toArrow().to_pylist()  # a row for each part
    crossing = offsets(spans)
    begins = {(x["part"], x["group"]): (x["begins"], x["total"]) for x in crossing}
    sent = spark.sparkContext.broadcast(begins)
    asked = pa.Table.from_pylist(crossing, pa.schema([("part", pa.int32()), ("group", pa.string()), ("begins", pa.int64()), ("n", pa.int64()), ("total", pa.int64())]))

    def ragged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(part: int, group: str | None, digests: list[str]) -> Iterator[pa.RecordBatch]:
            if (part, group) in sent.value and digests:
                found = subtrees(digests, *sent.value[part, group])
                yield pa.RecordBatch.from_pylist([{"group": group, "level": k, "index": i, "digest": d} for k, i, d in found], _node)

        part, group, held = -1, None, []
        for batch in batches:
            groups = batch.column(1).to_pylist()
            for a, z in _runs(groups):
                if groups[a] != group:
                    yield from finish(part, group, held)
                    part, group, held = batch.column(0)[0].as_py(), groups[a], []
                if (part, group) in sent.value:
                    held += batch.column(2).slice(a, z - a).to_pylist()
        yield from finish(part, group, held)

    nodes = None
    if crossing:
        totals = {x["group"]: x["total"] for x in crossing}
        sizes = spark.sparkContext.broadcast(totals)
        nodes = cut(at.select("_part", "_group", "_leaf").mapInArrow(ragged, NODE))
        frontier, below, top = nodes, 0, 0
        while top < height(max(totals.values())):
            below, top = top, top + STRIDE

            reach = top

            def up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
                group = key[0].as_py()
                found = built(list(zip(*(table.column(c).to_pylist() for c in ("level", "index", "digest")), strict=True)), sizes.value[group], reach)
                return pa.Table.from_pylist([{"group": group, "level": k, "index": i, "digest": d} for k, i, d in found], _node)

            coordinate = F.floor(F.col("index") / F.pow(F.lit(float(FAN)), F.lit(top) - F.col("level"))).cast("bigint")
            under = frontier.where((F.col("level") >= below) & (F.col("level") < top)).withColumn("under", coordinate)
            made = cut(under.groupBy("group", "under").applyInArrow(up, NODE))
            nodes = nodes.unionByName(made)
            frontier = frontier.where(F.col("level") >= top).unionByName(made.where(F.col("level") == top))

    wanted = None
    if nodes is not None:
        border = spark.createDataFrame(asked)
        power = F.pow(F.lit(float(FAN)), F.col("level")).cast("bigint")
        tall = F.ceil(F.log(float(FAN), F.col("total").cast("double"))).cast("int") + 1  # a level too many finds no siblings
        levels = border.withColumn("level", F.explode(F.sequence(F.lit(0), tall)))
        low, high = F.floor(F.col("begins") / power).cast("bigint"), F.floor((F.col("begins") + F.col("n") - 1) / power).cast("bigint")
        around = levels.withColumns({"low": low, "high": high})
        beyond = F.concat(*(F.sequence(F.col(c) - F.pmod(F.col(c), F.lit(FAN)), F.col(c) - F.pmod(F.col(c), F.lit(FAN)) + FAN - 1) for c in ("low", "high")))
        index = F.explode(F.array_distinct(F.filter(beyond, lambda i: (i < F.col("low")) | (i > F.col("high")))))
        wanted = around.select("part", "group", "level", index.alias("index")).join(nodes, ["group", "level", "index"])

    kept = [c for c in leaves.columns if c != "_salt"]

    def prove(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("_at")
        around: dict[str, dict[tuple[int, int], str]] = {}
        for g, k, i, d in zip(*(right.column(c).to_pylist() for c in ("group", "level", "index", "digest")), strict=True):
            around.setdefault(g, {})[k, i] = d
        groups, digests = left.column("_group").to_pylist(), left.column("_leaf").to_pylist()
        part = left.column("_part")[0].as_py() if left.num_rows else -1
        index, totals, roots, pieces = [], [], [], []
        for a, z in _runs(groups):
            begins, total = sent.value.get((part, groups[a]), (0, z - a))
            steps, takes, root = paths(digests[a:z], begins, total, around.get(groups[a], {}))
            index.append(np.arange(begins, begins + z - a))
            totals.append(np.full(z - a, total))
            roots += [root] * (z - a)
            if steps:
                starts = np.cumsum([0, *map(len, steps)])[:-1]
                flat = np.stack([t + s for t, s in zip(takes, starts, strict=True)], axis=1).ravel()
                values = pa.concat_arrays(steps).take(pa.array(flat))
            else:
                values = pa.array([], _step)
            pieces.append(pa.ListArray.from_arrays(pa.array(np.arange(z - a + 1) * len(steps), pa.int32()), values))
        out = left.select(kept)
        for name, array in (("_index", pa.array(np.concatenate(index) if index else [], pa.int64())), ("_n", pa.array(np.concatenate(totals) if totals else [], pa.int64())), ("_root", pa.array(roots, pa.string())), ("_proof", pa.chunked_array(pieces, pa.list_(_step)))):
            out = out.append_column(name, array)
        return out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema if f.name in kept)
    out_schema = f"{fields}, _index bigint, _n bigint, _root string, _proof array<struct<before:string,after:string>>"
    if wanted is None:
        wanted = spark.range(0).selectExpr("cast(id as int) as part", "'' as group", "0 as level", "id as index", "'' as digest")
    return at.groupBy("_part").cogroup(wanted.withColumnRenamed("part", "_part").groupBy("_part")).applyInArrow(prove, out_schema)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def siblings_digest(proof: Column) -> Column:
    """H of all siblings of a proof, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def manifest(rows: DataFrame, group: str, order: list[str], values: list[str], more: dict[str, Column] | None = None, rows_per_part: int = ROWS) -> DataFrame:
    """A leaf for each of `rows`, made of columns `values`: `group`, `order`, `more`, leaf, index, n, subroot, root and proof, the siblings (before, after) of each level up to the root.

    `more` adds columns by their names, such as the leaf of an altered row.
    """
    more = more or {}
    clean = rows.select(F.col(group).alias("_name"), group_key(F.col(group)).alias("_group"), *(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)), leaf_of(*(F.col(c) for c in values)).alias("_leaf"), *(c.alias(f"_m{i}") for i, c in enumerate(more.values())))
    leaves = cut(clean.withColumn("_salt", F.monotonically_increasing_id()))
    below = cut(grow(leaves, [f"_o{i}" for i in range(len(order))], rows_per_part))
    roots = below.groupBy("_group").agg(F.first("_root").alias("_leaf"), F.count(F.lit(1)).alias("n"))
    tops = cut(roots.select(F.lit("").alias("_group"), F.col("_group").alias("_own"), "_leaf", "n", F.lit(0).cast("bigint").alias("_salt")))
    above = grow(tops, ["_own"], rows_per_part).select(F.col("_own").alias("_group"), F.col("_root").alias("_top"), F.col("_proof").alias("_upper"), "n")
    joined = attach(below, above, "_group", leaves.count())
    names = [F.col("_name").alias(group), *(F.col(f"_o{i}").alias(c) for i, c in enumerate(order)), *(F.col(f"_m{i}").alias(c) for i, c in enumerate(more))]
    return joined.select(*names, F.col("_leaf").alias("leaf"), F.col("_index").alias("index"), F.col("_n").alias("n"), F.col("_root").alias("subroot"), F.col("_top").alias("root"), F.concat("_proof", "_upper").alias("proof"))
