import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trackloom.llm import simhash
from trackloom.llm.common import attach, cut
from trackloom.llm.op4 import op4_simhash_groups
from trackloom.llm.stages import drop_near_copies


def brute_fingerprint(text, k=4):
    words = text.lower().split() if text.isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", ["", "  \t\n", "One", "a b c", "The cat sat on THE mat and ÄÖ sat", "x y " * 300])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("n", [10, 1000, 10**6, 10**9, 10**12])
@pytest.mark.parametrize("bits", [4, 8])
def test_any_close_pair_shares_a_block(n, bits):
    masks = simhash.block_masks(n, bits, crowd=6)
    rng = random.Random(n)
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), bits))
        assert any(not flips & m for m in masks)


def brute_groups(fps, bits):
    label = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= bits:
                    label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("bucket", [8192, 3])
def test_groups_agree_with_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(20)]
    for _ in range(60):  # chains of close ones
        fps.append(rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = cut(spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint"))
    got = {r["doc_id"]: r["component_id"] for r in simhash.group(df).collect()}
    assert [got[i] for i in range(len(fps))] == brute_groups(fps, 4)


def test_many_equal_and_empty(docs):
    rows = [(i, "same words in all of these texts") for i in range(200)] + [(300, None), (301, ""), (302, " "), (None, "same words in all of these texts")]
    out = simhash.group(cut(simhash.fingerprints(docs(rows, "1 as fp2")))).collect()
    assert len(out) == len(rows)
    assert {r["component_id"] for r in out if r["doc_id"] is None or r["doc_id"] < 300} == {0}
    assert {r["component_id"] for r in out if r["doc_id"] and r["doc_id"] >= 300} == {300}


def test_no_documents(docs):
    assert simhash.group(cut(simhash.fingerprints(docs([])))).count() == 0


def test_long_chain_of_components(spark):
    edges = cut(spark.range(1, 400).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v")))
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def text(seed, n=300):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_stage_keeps_one_of_near_copies_and_leaves_others(docs):
    base = text(1)
    near = [w if i % 70 else "edit" for i, w in enumerate(base)]  # five-word resemblance about 0.87
    far = [w if i % 9 else f"e{i}" for i, w in enumerate(base)]  # about 0.3
    rows = [(10, " ".join(base)), (4, " ".join(near)), (7, " ".join(base)), (1, " ".join(far)), (2, " ".join(text(2))), (2, " ".join(text(2))), (None, " ".join(base)), (20, None), (21, ""), (None, " ".join(text(3)))]
    out = drop_near_copies(docs(rows, "true as component_id")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in out) == [(False, 1), (False, 2), (False, 4), (False, 20), (True, None)]
    assert all(r["component_id"] is True for r in out)
    assert drop_near_copies(docs([])).count() == 0


def resemblance(a, b, k=5):
    a, b = ({tuple(x[i : i + k]) for i in range(max(1, len(x) - k + 1))} for x in (a, b))
    return len(a & b) / len(a | b)


def edited(way, n, new, seed):
    """A text and its copy with a passage of `new` words replaced, or as many appended."""
    base, words = text(seed, n), text(seed + 10**6, new)
    at = random.Random(seed).randrange(n - new)
    return base, base + words if way == "appended" else base[:at] + words + base[at + new :]


@pytest.mark.parametrize("way, sizes", [("replaced", {300: 20, 1000: 70}), ("appended", {25: 4, 60: 9, 300: 45, 1000: 150})])
def test_contiguous_edits_are_found(docs, way, sizes):
    pairs = [edited(way, n, new, n + i) for n, new in sizes.items() for i in range(20)]
    assert all(0.8 < resemblance(*p) < 0.9 for p in pairs)
    out = drop_near_copies(docs([(i, " ".join(t)) for i, t in enumerate(t for p in pairs for t in p)])).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(0, 2 * len(pairs), 2))


@pytest.mark.parametrize("limit", [16 << 20, 4000])
def test_links_are_exact(docs, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET_BYTES", limit)
    base = [text(s, 204) for s in range(40)]  # 200 shingles
    pairs = [(t, t[:k] + text(100 + i, 204 - k)) for i, (t, k) in enumerate(zip(base, [182, 181] * 20, strict=True))]
    assert all(resemblance(*p) >= 0.8 for p in pairs[::2]) and all(0.79 < resemblance(*p) < 0.8 for p in pairs[1::2])
    out = drop_near_copies(docs([(i, " ".join(t)) for i, t in enumerate(t for p in pairs for t in p)])).collect()
    assert sorted(r["doc_id"] for r in out) == [i for i in range(80) if i % 4 != 1]


def test_concentrated_fingerprints_are_keyed_again(spark, monkeypatch):
    """Many fingerprints that differ in few places crowd every bucket; all links are found without a large one."""
    monkeypatch.setattr(simhash, "BUCKET", 16)
    rng = random.Random(2)
    fps = sorted({rng.getrandbits(14) << 30 | 5 for _ in range(200)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = cut(spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint"))
    got = {r["doc_id"]: r["component_id"] for r in simhash.group(df).collect()}
    assert [got[i] for i in range(len(fps))] == brute_groups(fps, 4)


@pytest.mark.parametrize("bucket", [1024, 8])
def test_a_large_group_of_distinct_near_copies(docs, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    base, other = text(1), text(2)
    rows = [(i, " ".join(base[:k] + [f"edit{i}"] + base[k + 1 :])) for i, k in enumerate(range(40, 240, 2))]
    rows += [(500 + i, " ".join(other[: 300 - i])) for i in range(30)] + [(900, " ".join(text(3)))]
    out = drop_near_copies(docs(rows)).collect()
    assert sorted(r["doc_id"] for r in out) == [0, 500, 900]


def test_attach_finds_every_row_of_hot_keys(spark):
    many = cut(spark.range(3000).select((F.col("id") % F.when(F.col("id") < 2000, 1).otherwise(50)).alias("k"), "id"))
    one = cut(many.groupBy("k").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("k <> 7"))
    tops = {r["k"]: r["top"] for r in one.collect()}
    got = attach(many, one, "k", 3000, hot=100).collect()
    assert sorted((r["id"], r["k"], r["top"]) for r in got) == sorted((r["id"], r["k"], tops[r["k"]]) for r in many.collect() if r["k"] != 7)


def test_the_query_against_brute_force(spark, tmp_path):
    rng = random.Random(6)
    texts = [" ".join(text(i, rng.randint(1, 60))) for i in range(60)]
    texts += [t.replace("w1", "W1") for t in texts[:20]] + [" ".join([*t.split()[:-1], "end"]) for t in texts[:30]] + [None, "", " \t", "\x0b"]
    rows = [(7 * i % 211, t, i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, fp int").write.parquet(f"{tmp_path}/documents.parquet")
    rows.sort()
    fps = [brute_fingerprint(t or "") for _, t, _ in rows]
    want = {(i, f"{f:016x}", rows[g][0]) for (i, _, _), f, g in zip(rows, fps, brute_groups(fps, 4))}
    assert {tuple(r) for r in op4_simhash_groups(spark, str(tmp_path)).collect()} == want


def test_near_copies_meet_by_fingerprints(docs, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join(words[::-1]))]
    none = lambda rows, groups, near, limit, data, real=simhash.bucket_links: real(rows.where("false") if "t" in groups else rows, groups, near, limit, data)
    monkeypatch.setattr(simhash, "bucket_links", none)  # no band is shared
    found = {r["key"]: r["component_id"] for r in simhash.near_copies(docs(rows).select(F.col("doc_id").alias("key"), "text"), "key").collect()}
    assert found == {1: 1, 2: 1, 3: 3}
