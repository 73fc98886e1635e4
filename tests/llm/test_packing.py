import random
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import packing
from trackloom.llm.common import cut
from trackloom.llm.op1 import default_tokenizer, op1_pack_sequences, pack_documents


def valid(lengths, packing, capacity):
    assert sorted(i for b in packing.bins for i in b) == list(range(len(lengths)))
    assert packing.free.tolist() == [capacity - sum(lengths[i] for i in b) for b in packing.bins] and min(packing.free) >= 0
    assert all(packing.bin_of[i] == k for k, b in enumerate(packing.bins) for i in b)


def descending(lengths):
    return sorted(range(len(lengths)), key=lambda i: -lengths[i])


def optimum(lengths, capacity):
    best = len(lengths)
    for order in permutations(lengths):
        bins, free = 0, 0
        for n in order:
            if n > free:
                bins, free = bins + 1, capacity
            free -= n
        best = min(best, bins)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_small_instances_reach_the_optimum(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(7)]
    best = packing.evolve(lengths, [], seed, capacity=20, generations=60)[0]
    valid(lengths, best, 20)
    assert len(best.bins) == optimum(lengths, 20)


def test_crossover_keeps_injected_bins_whole():
    rng = np.random.default_rng(1)
    lengths = [random.Random(i).randint(50, 700) for i in range(300)]
    a, b = packing.packed(lengths, list(range(300)), 1024), packing.packed(lengths, descending(lengths), 1024)
    before = a.bin_of.copy()
    child = packing.crossover(rng, lengths, a, b, 1024)
    valid(lengths, child, 1024)
    valid(lengths, a, 1024)
    assert (a.bin_of == before).all()
    whole = {frozenset(x) for x in b.bins} - {frozenset(x) for x in a.bins}
    assert any(frozenset(x) in whole for x in child.bins)


@pytest.mark.parametrize("low,high,n", [(250, 450, 3000), (200, 520, 3000), (100, 600, 2000)])
def test_crossover_saves_bins_that_seeds_do_not(low, high, n):
    rng = random.Random(low)
    lengths = [rng.randint(low, high) for _ in range(n)]
    seeds = packing.evolve(lengths, [], 3, generations=0)
    plain = packing.packed(lengths, descending(lengths), 1024)
    found = packing.evolve(lengths, [], 3, generations=200)
    for p in found:
        valid(lengths, p, 1024)
    assert len(plain.bins) > -(-sum(lengths) // 1024) and len(found[0].bins) < min(len(p.bins) for p in [plain, *seeds])
    assert packing.evolve(lengths, [], 3, generations=200)[0].bins == found[0].bins


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_districts_and_levels(spark, n):
    rows = cut(spark.range(n).select(F.col("id").alias("uid"), (F.col("id") * 7919 % 1023 + 1).cast("int").alias("length")))
    out = packing.pack(rows, district=300, epochs=2).join(rows, "uid").collect()
    assert sorted(r["uid"] for r in out) == list(range(n))
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = sorted((r["length"] for r in out), reverse=True)
    assert len(bins) <= len(packing.packed(lengths, list(range(n)), 1024).bins) * 1.03  # in small districts exact pairs are rarer


def test_one_length_alone_ends(spark):
    rows = cut(spark.range(2000).select(F.col("id").alias("uid"), F.lit(700).alias("length")))
    assert packing.pack(rows, district=100).select("sequence_id").distinct().count() == 2000


def test_documents_round_trip(docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(default_tokenizer())
    rng = random.Random(4)
    texts = [None, "", "word", "a <|endoftext|> b", "Füße naïve 東京 🙂 ſ", "x " * 1023, "y " * 1500, " ".join(str(rng.random()) for _ in range(900)), "\x85  odd　spaces", "it's we'll THEY'RE"]
    rows = list(enumerate(texts)) + [(2, "word"), (None, "word")]
    out = pack_documents(docs(rows, "0 as piece")).collect()
    by = defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        ids = exact.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted(by[i], key=lambda r: r["piece"])
        if i == 2:
            assert len(mine) == 2
            mine = mine[:1]
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert all(r["length"] == 1024 for r in mine[1:]) and (len(ids) > 1024 or len(mine) == 1)
    assert len(by[None]) == 1
    assert pack_documents(docs([])).count() == 0


def test_the_query_is_gapless_and_near_its_bound(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, None if i % 50 == 7 else " ".join(rng.choice(["word", "a", "other", "\u00e9t\u00e9"]) for _ in range(rng.choice([3, 80, 500, 1800])))) for i in range(400)]
    spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, length int").write.parquet(f"{tmp_path}/documents.parquet")
    out = op1_pack_sequences(spark, str(tmp_path)).collect()
    pieces = pack_documents(spark.read.parquet(f"{tmp_path}/documents.parquet")).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, pieces)) == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        ends = [0]
        for offset, length in sorted(b):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024
    rest = [r["length"] for r in out if r["length"] < 1024]
    assert len(bins) <= len(out) - len(rest) + len(packing.packed(rest, descending(rest), 1024).bins)
