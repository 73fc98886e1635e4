"""Texts of 120,000 words through the operators whose own tests have short ones."""

import hashlib
import random
import zlib

import pytest
import xxhash

from trackloom.llm.op2 import op2_fingerprints
from trackloom.llm.op4 import op4_simhash_groups
from trackloom.llm.op8 import op8_toxicity
from trackloom.llm.op10 import op10_hilbert_shards
from trackloom.llm.stages import drop_near_copies

N = 120_000


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    words = [f"w{rng.randrange(50_000)}" for _ in range(N)]
    near = list(words)
    for i in range(0, N, 400):
        near[i] = "other"
    far = [f"v{rng.randrange(50_000)}" for _ in range(N)]
    return [" ".join(x) for x in (words, near, far, ["é"] * N)] + ["short text", "", None]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long"))
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (5, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_fingerprints(spark, folder, texts):
    got = {r["doc_id"]: r for r in op2_fingerprints(spark, folder).collect()}
    assert got[0]["near_next"] > 0.9 and got[1]["near_next"] < 0.1 and 0.4 < got[0]["near_edited"] < 0.6
    half = len(texts[0]) // 2
    edited = texts[0][: len(texts[0]) - half] + texts[1][:half]
    assert got[0]["n_chars"] == len(texts[0]) and got[0]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_simhash(spark, folder, texts):
    got = {r["doc_id"]: r for r in op4_simhash_groups(spark, folder).collect()}
    for i in (2, 3):
        words = texts[i].split()
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(N - 3)]
        assert int(got[i]["fingerprint"], 16) == sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert got[1]["component_id"] == got[0]["component_id"] or bin(int(got[0]["fingerprint"], 16) ^ int(got[1]["fingerprint"], 16)).count("1") > 4


def test_toxicity_and_shards(spark, folder, texts):
    assert {r["doc_id"] for r in op8_toxicity(spark, folder).collect() if 0 <= r["score"] <= 1} == set(range(len(texts)))
    for r in op10_hilbert_shards(spark, folder).collect():
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))


def test_near_copies_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(r["doc_id"] for r in drop_near_copies(docs).select("doc_id").collect()) == [0, 2, 3, 4, 5]
