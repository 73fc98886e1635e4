import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from trackloom.llm import merkle
from trackloom.llm.op12 import VALUES, op12_merkle_manifest


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row)


def tree(nodes):
    """All levels over the nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def proof(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = i - i % 3
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 3])))
        i //= 3
    return out


def folded(digest, steps):
    for before, after in steps:
        digest = h([before, digest, after])
    return digest


def brute(rows):
    """The query's rows for documents (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for g, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            steps = proof(trees[s], i) + proof(top, g)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            got = folded(leaf((*r[:4], r[4].replace("\n", ""))) if changed else leaf(r), steps)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(a + b for a, b in steps), got, got == top[-1][0]))
    return out


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", "b", "b", "ü", "", None, f"s{i % 7}"]), rng.choice(["en", None]), rng.choice([None, i]), rng.choice(["x\ny", "", "é\n\n", None, "plain"])) for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "b", None, None, "x"), *rows[3:5], *[(5, "b", "en", 1, "same")] * 20]


@pytest.mark.parametrize("rows_per_part", [20, 10_000])
@pytest.mark.parametrize("stride", [2, 12])
def test_against_brute_force(spark, monkeypatch, rows_per_part, stride):
    monkeypatch.setattr(merkle, "STRIDE", stride)
    rows = corpus(300)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, _group int").repartition(3)
    got = merkle.manifest(df, "source", ["doc_id"], VALUES, rows_per_part=rows_per_part)
    assert got.columns == ["source", "doc_id", "leaf", "index", "n", "subroot", "root", "proof"]
    made = key(got.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof"))).collect())
    assert made == key(r[:5] for r in brute(rows))
    assert got.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    per = {(r["source"], r["index"]) for r in got.collect()}
    assert len(per) == len(rows)


def test_the_query_against_brute_force(spark, tmp_path):
    rows = corpus(500, 2) + [(9_000, "a", "en", 3, "long\n" * 100_000)]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert key(out) == key(brute(rows))
    assert any(r["verified"] for r in out) and not all(r["verified"] for r in out)


def test_roots_of_many_groups_cross_parts(spark):
    rows = [(i, f"s{i % 40}", "en", 1, "t") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    got = merkle.manifest(df, "source", ["doc_id"], VALUES, rows_per_part=11).select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof"))).collect()
    assert key(got) == key(r[:5] for r in brute(rows))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10])
def test_small_tables(spark, n):
    rows = [(i, "s", "en", 1, "t") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    got = merkle.manifest(df, "source", ["doc_id"], VALUES, rows_per_part=2).select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof"))).collect()
    assert key(got) == key(r[:5] for r in brute(rows))


@pytest.mark.parametrize("n", [1, 2, 3, 8, 27, 100])
def test_subtrees_and_ancestors_make_the_whole_tree(n):
    leaves = [h([str(i)]) for i in range(n)]
    levels = tree(leaves)
    rng = random.Random(n)
    cuts = sorted({0, n, *(rng.randrange(n) for _ in range(5))})
    ragged = [x for a, z in zip(cuts, cuts[1:]) for x in merkle.subtrees(leaves[a:z], a, n)]
    assert all(levels[k][i] == d for k, i, d in ragged)
    made = merkle.built(ragged, n, 99)
    assert all(levels[k][i] == d for k, i, d in made)
    assert (merkle.height(n), 0, levels[-1][0]) in [*ragged, *made]
