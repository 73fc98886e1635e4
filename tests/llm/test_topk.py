from fractions import Fraction
from math import floor

import numpy as np
import pytest

from trackloom.llm import topk
from trackloom.llm.op7 import op7_exact_topk


def brute(vectors, k, ask):
    fine = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            fine.setdefault(i, []).append([floor(1024 * Fraction(float(x))) for x in v])
    out = set()
    for q in fine:
        if ask(q):
            scored = sorted((-sum(a * b for a, b in zip(max(fine[q]), v)), i) for i, vs in fine.items() if i != q for v in vs)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("lists", [1, 2, 3])
@pytest.mark.parametrize("chunk", [16 << 20, 200])
def test_against_brute_force(spark, monkeypatch, lists, chunk):
    monkeypatch.setattr(topk, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(50, None), (51, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (60, [float("nan")] * 6), (70, [float("inf")] * 6), (None, [1.0] * 6), (90, []), (91, [2.0] * 3), (5, [9.0] * 6), (5, [9.0] * 6)]
    rows += [(200 + i, [float(x) for x in np.float32(rng.normal(size=6) * 10.0 ** (i % 4 + 2))]) for i in range(24)]  # beyond 65,536, and sums beyond 53 bits
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int")
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 7, lists).collect()
    assert {tuple(r) for r in got} == brute(rows, 7, lambda q: q % 10 == 0) and len(got) == len({tuple(r) for r in got})


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0


def test_scores_beyond_a_long_rank_by_their_true_values(spark):
    rows = [(i, [x]) for i, x in enumerate([1e300, 2e300, -1e300, 1e18, 3.0, 1.7e308, -1.7e308, 2e18])]
    got = topk.top_k(df := spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), df).collect()
    clipped = {(q, r, i, min(max(s, topk.LEAST), topk.MOST)) for q, r, i, s in brute(rows, 10, lambda q: True)}
    assert {tuple(r) for r in got} == clipped and len(got) == 56


def test_sortable_totals():
    low, high = [-(1 << 2000), -(1 << 70) - 1, -(1 << 70), -(1 << 64), topk.LEAST - 1, topk.LEAST], [topk.MOST + 1, topk.MOST + 2, 1 << 64, 1 << 70, 1 << 2000]
    assert sorted(map(topk.sortable, low + high)) == list(map(topk.sortable, low + high))
    assert topk.sortable(topk.LEAST + 1) is None and topk.sortable(topk.MOST) is None


@pytest.mark.parametrize("lists", [1, 2, 3, 8])
def test_survivors_reach_the_cutoff(lists):
    """Exactly the pairs that reach the cutoff are left, of few that pass the threshold."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 64))
    v = topk.scaled(v / np.linalg.norm(v, axis=1)[:, None])
    q, ids = v[:40], np.arange(4000)
    total = q @ v.T
    total[np.arange(40), np.arange(40)] = -np.inf
    cutoff = np.sort(total, axis=1)[:, -10]
    found = topk.survivors(q, v, cutoff, ids[:40], ids, lists)
    if lists == topk.LISTS:
        assert topk.passing(q, v, cutoff, lists)[0].mean() < 0.2
    assert sorted(zip(found[0].tolist(), found[1].tolist())) == sorted(map(tuple, np.argwhere(total >= cutoff[:, None]).tolist()))


def test_the_query_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(450)] + [(600, [70000.0] * 8), (601, [70000.0, 1.0]), (700, None), (None, [1.0])]
    spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert {tuple(r) for r in op7_exact_topk(spark, str(tmp_path)).collect()} == brute(rows, 10, lambda q: q % 100 == 0)
