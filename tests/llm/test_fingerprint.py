import hashlib
import re

import pytest
from pyspark.sql import functions as F

from trackloom.llm import fingerprint as fp
from trackloom.llm.op2 import op2_fingerprints


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["", None, "one", "one two three four five", "one two three four five six", "\t one\x0btwo  three\r\nfour five six ", " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1500)), " ".join(f"v{i}" for i in range(3000)), "rep " * 500]


def test_estimates(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select("i", fp.sketch(F.coalesce("t", F.lit(""))).alias("s"))
    pairs = df.crossJoin(df.toDF("j", "u")).select("i", "j", fp.resemblance(F.col("s"), F.col("u")).alias("r"), fp.containment(F.col("s"), F.col("u")).alias("c"), fp.distinct_shingles(F.col("s")).alias("n"), fp.merge(F.col("s"), F.col("u")).alias("m"))
    for r in pairs.collect():
        a, b = shingles(TEXTS[r["i"]]), shingles(TEXTS[r["j"]])
        assert abs(r["r"] - jaccard(TEXTS[r["i"]], TEXTS[r["j"]])) < 0.1
        assert abs(r["n"] - len(a)) <= 0.25 * len(a) if len(a) >= 256 else r["n"] == len(a)
        assert abs(r["c"] - (len(a & b) / len(a) if a else 1)) < 0.25
        assert len(r["m"]) == min(256, len(a | b))


def query(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string, _block string").write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return op2_fingerprints(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("ids", [range(40), [7 * i * i for i in range(40)], [-(10**17) + i for i in range(20)] + [10**17 + i for i in range(20)], [3] * 20 + [4] * 20])
def test_edited_texts_and_neighbours(spark, tmp_path, ids, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 4)
    monkeypatch.setattr(fp.neighbours, "__defaults__", (4,))
    rows = [(i, f"text {k} " + " ".join(f"u{k * j % 97}" for j in range(k * 3)), "x") for k, i in enumerate(ids)]
    out = query(spark, tmp_path, rows)
    assert len(out) == len(rows)
    if len(set(ids)) == len(rows):
        rows.sort()
        want, texts, after = {}, {i: t for i, t, _ in rows}, {i: rows[(k + 1) % len(rows)][1] for k, (i, *_) in enumerate(rows)}
        for k, (i, t, _) in enumerate(rows):
            n, nxt = len(t) // 2, rows[(k + 1) % len(rows)][1]
            edited = t[: len(t) - n] + nxt[:n]
            want[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(t, edited), jaccard(t, nxt))
        for r in out:
            w = want[r["doc_id"]]
            assert (r["n_chars"], r["edited_sha256"]) == w[:2]
            assert abs(r["near_edited"] - w[2]) < 0.01 and abs(r["near_next"] - w[3]) < 0.01
            own, following = shingles(texts[r["doc_id"]]), shingles(after[r["doc_id"]])
            assert (r["shingles"], r["shingles_of_both"]) == (len(own), len(own | following)) and abs(r["within_next"] - len(own & following) / len(own)) < 1e-9  # exact under k


def test_edges(spark, tmp_path):
    assert query(spark, tmp_path, []) == []
    (one,) = query(spark, tmp_path, [(5, "abcd", None)])
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    rows = [(None, "n1", ""), (None, "n2", ""), (1, None, ""), (2, "", ""), (3, "🙂é" * 7, ""), (3, "🙂é" * 7, "")]
    out = query(spark, tmp_path, rows)
    assert len(out) == 6
    by = {r["doc_id"]: r for r in out}
    assert by[1]["n_chars"] == 0 and by[1]["near_next"] == 1.0 and by[3]["n_chars"] == 14
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == ""
