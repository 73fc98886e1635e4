import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from trackloom.llm import mixing
from trackloom.llm.common import cut, running
from trackloom.llm.op9 import op9_mix_sources
from trackloom.llm.stages import mix_sources


def test_quotas_add_up_and_shards_get_equal_shares():
    leaves = np.array(mixing.split_quotas([100, 3, 0, 977], 8, 5))
    assert leaves.sum(axis=0).tolist() == [100, 3, 0, 977] and leaves.min() >= 0
    assert leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 3
    assert mixing.split_quotas([100, 3, 0, 977], 8, 5) == leaves.tolist()


def test_draws_follow_the_hypergeometric_mean():
    first = [mixing.split_quotas([300, 700], 2, seed)[0][0] for seed in range(200)]
    assert abs(np.mean(first) - 150) < 3 and 5 < np.std(first) < 12


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / share for s in names}
        above = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_targets_fill_and_stop(spark):
    sizes = {"a": 10, "b": 5000, "c": 800, "d": 0, "e": 1, None: 4000}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint").withColumn("doc_key", F.xxhash64("doc_id"))
    df = cut(df)
    return mixing.mix(df, df.select("source", "doc_key", "size"), n_shards=8)


def test_taken_words_come_near_targets_and_reruns_agree(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", i * 7919 % 400) for i in range(3000)] + [(5000 + i, None, 50) for i in range(40)]
    out = mixed(spark, rows).select("doc_id", "source", "size", "target", "draws").collect()
    assert len(out) == len(rows)
    for s in {r["source"] for r in out}:
        mine = [r for r in out if r["source"] == s]
        taken, size = sum(len(r["draws"]) * r["size"] for r in mine), sum(r["size"] for r in mine)
        assert abs(taken - mine[0]["target"]) <= max(0.01 * size, 400)
        assert max(len(r["draws"]) for r in mine) <= 3
        assert all(len({d["epoch"] for d in r["draws"]}) == len(r["draws"]) for r in mine)
    again = mixed(spark, rows).repartition(3).select("doc_id", "draws").collect()
    assert {r["doc_id"]: r["draws"] for r in again} == {r["doc_id"]: r["draws"] for r in out}


def test_edges(spark):
    assert mixed(spark, []).count() == 0
    out = mixed(spark, [(1, "a", 0), (2, "a", 0), (3, None, 5)]).collect()
    assert {r["doc_id"]: len(r["draws"]) * r["size"] for r in out} == {1: 0, 2: 0, 3: 5}


def test_shards_share_sources_evenly(spark):
    rows = [(i, f"s{i % 2}", 10) for i in range(20000)]
    got = mixing.shuffled(mixed(spark, rows), ["doc_id", "source"]).groupBy("mix_shard").agg(F.count("*").alias("n")).collect()
    assert len(got) == 8 and min(r["n"] for r in got) > 0.5 * max(r["n"] for r in got)


def test_draws_are_exact_at_any_size():
    leaves = np.array(mixing.split_quotas([40_000_000, 7, 0, 300_000_000], 16, 5))
    assert leaves.sum(axis=0).tolist() == [40_000_000, 7, 0, 300_000_000] and leaves.min() >= 0
    assert mixing.split_quotas([], 4, 1) == [[], [], [], []]
    small = [mixing.split_quotas([2, 10**6], 2, seed)[0][0] for seed in range(300)]  # near a binomial of 2 draws
    assert set(small) == {0, 1, 2} and 100 < small.count(1) < 200


def test_running_ranks_and_sums(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"), (F.col("id") % 13).alias("w"))
    out, totals = running(df.repartition(5), ["k"], ("w",))
    got = sorted((r["k"], r["_rank"], r["_before_w"], r["w"]) for r in out.collect())
    before = 0
    for place, (k, rank, run, w) in enumerate(got):
        assert (k, rank, run) == (place, place, before)
        before += w
    assert totals == {"_rows": 500, "w": before} and running(df.limit(0), ["k"], ("w",))[1] == {"_rows": 0, "w": 0}


def test_no_shard_is_empty_while_there_are_rows_enough(spark):
    rows = [(i, f"s{i % 20}", 1 + i * 31 % 300) for i in range(1000)]
    assert mixing.shuffled(mixed(spark, rows), ["doc_id"]).select("mix_shard").distinct().count() == 8


def test_a_long_document_at_the_border_leaves_no_gap(spark):
    """Whatever document the target's end falls in, documents of further blocks fill what it leaves."""
    rows = [(i, "hot", 40) for i in range(4000)] + [(9000 + i, "hot", 30_000) for i in range(6)] + [(20_000 + i, "small", 900) for i in range(400)]
    out = mixed(spark, rows).select("source", "size", "target", F.size("draws").alias("n")).collect()
    for s in ("hot", "small"):
        mine = [r for r in out if r["source"] == s]
        gap = mine[0]["target"] - sum(r["n"] * r["size"] for r in mine)
        assert 0 <= gap <= max(0.001 * mine[0]["target"], 900 if s == "small" else 40)


def test_columns_pass_through(spark):
    df = cut(spark.createDataFrame([(i, "a", 5, i, "w", i + 1) for i in range(50)], "doc_id bigint, source string, size bigint, weight int, stratum string, draws int").withColumn("doc_key", F.xxhash64("doc_id")))
    out = mixing.mix(df, df.select("source", "doc_key", "size"), n_shards=2)
    assert out.columns == ["doc_id", "source", "size", "weight", "stratum", "doc_key", "source_size", "target", "draws"]
    assert all(r["weight"] == r["doc_id"] and r["stratum"] == "w" and len(r["draws"]) == 1 for r in out.collect())


def documents(n=1500):
    rng = random.Random(9)
    rows = [(i, " ".join("w" * rng.randint(1, 6) for _ in range(rng.randint(0, 90))), "en", "hot" if i % 3 == 0 else f"s{i % 11}", 0) for i in range(n)]
    return rows + [(3, "again and again", "en", "hot", 0), (3, "again and again", "en", "hot", 0), (None, "no id", None, None, 0), (5000, None, "en", "s1", 0), (5001, "\x85 \u3000", "en", "only", 0)]


def test_the_query_against_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    out = op9_mix_sources(spark, str(tmp_path)).collect()
    sizes = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, _, s, _ in rows]
    total = Counter()
    for _, n, s in sizes:
        total[s] += n
    want = brute_targets(dict(total))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in out), key=key) == sorted(sizes, key=key)
    for s in total:
        mine = [r for r in out if r["source"] == s]
        assert {r["source_size"] for r in mine} == {total[s]} and abs(mine[0]["target"] - want[s]) < 1e-6
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= max(0.01 * want[s], 90)
    assert all(r["taken"] == len(r["shards"]) * r["size"] <= 3 * r["size"] and len(r["shards"]) == len(r["orders"]) for r in out)
    again = op9_mix_sources(spark, str(tmp_path)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_the_stage_against_the_targets(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = mix_sources(df)
    assert out.columns == df.columns
    known, got, words, total = Counter(map(repr, rows)), Counter(), Counter(), Counter()
    for r in out.collect():
        got[repr(tuple(r))] += 1
        words[r["source"]] += len((r["text"] or "").split())
    for _, t, _, s, _ in rows:
        total[s] += len((t or "").split())
    assert set(got) <= set(known) and all(n <= 3 * known[r] for r, n in got.items())
    want = brute_targets(dict(total))
    assert all(abs(words[s] - want[s]) <= max(0.01 * want[s], 90) for s in total if s != "only")
    assert mix_sources(df.limit(0)).count() == 0
