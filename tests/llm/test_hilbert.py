import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from trackloom.llm.hilbert import curve_order, curve_tables, cut_runs, hilbert_index
from trackloom.llm.op10 import op10_hilbert_shards, shard_documents


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_in_unit_steps(dims, bits):
    digits, follow, _ = curve_tables(dims)
    at = {}
    for cell in itertools.product(range(1 << bits), repeat=dims):
        state = index = 0
        for bit in range(bits - 1, -1, -1):
            k = (state << dims) + sum((cell[j] >> bit & 1) << j for j in range(dims))
            index, state = (index << dims) + digits[k], follow[k]
        at[index] = cell
    assert sorted(at) == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(len(at) - 1))


def test_column_form_agrees_with_the_tables(spark):
    rows = spark.range(256).select((F.col("id") % 16).cast("int").alias("x"), (F.col("id") / 16).cast("int").alias("y"))
    got = [r["h"] for r in rows.select("x", "y", hilbert_index([F.col("x"), F.col("y")], 4).alias("h")).orderBy("h").collect()]
    assert got == list(range(256))


@pytest.mark.parametrize("n", [0, 1, 5, 100])
def test_rows_law(spark, n):
    rows = spark.range(n).select(F.lit(1).alias("h"), "id", F.lit(10).alias("size"))
    out = cut_runs(rows, ["h", "id"], 24).collect()
    assert sorted(r["id"] for r in out) == list(range(n))
    by = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(24)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_bytes_law_evens_sizes(spark):
    rows = spark.range(2000).select("id", (F.col("id") % 7 * 13 + 1).alias("size"))
    out = cut_runs(rows, ["id"], 8, law="bytes").groupBy("shard").agg(F.sum("size").alias("s"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    total = sum(r["s"] for r in out)
    assert len(out) == 8 and all(abs(r["s"] - total / 8) <= 2 * 79 and r["m"] + 1 == r["n"] for r in out)


def test_documents_with_nulls_repeats_and_clashing_columns(docs):
    rows = [(1, "a"), (1, "a"), (2, None), (None, "x" * 5000), (3, "a"), (4, "")] + [(100 + i, "same text") for i in range(40)]
    out = shard_documents(docs(rows, "'z' as hilbert_index"), 4).collect()
    assert len(out) == len(rows)
    assert {r["size"] for r in out if r["doc_id"] == 2} == {8} and {r["text_crc32"] for r in out if r["doc_id"] in (2, 4)} == {0}
    counts = [sum(r["shard"] == s for r in out) for s in range(4)]
    assert max(counts) - min(counts) <= 1


def test_empty_documents(docs):
    assert shard_documents(docs([])).count() == 0


def test_equal_rows_are_cut_too(spark):
    rows = spark.range(3000).select(F.lit(None).cast("string").alias("h"), F.lit("old").alias("slot"))
    out = cut_runs(rows, ["h"], 6).collect()
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(500)) for s in range(6))


def brute_level(values, value, bits):
    below, mine = sum((v or "") < (value or "") for v in values), sum(v == value for v in values)
    return min(int((below + mine / 2) * (1 << bits) / len(values)), (1 << bits) - 1)


def test_levels_share_rows_whatever_the_outliers(spark):
    rows = [(i if i else 10**15, "abcde"[i % 5] if i % 7 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "n bigint, c string")
    out = curve_order(df, ["c"], ["n"], bits=4).select("n", "c", "hilbert_index").collect()
    curve = {r["hilbert_index"]: r for r in spark.range(256).select("id", hilbert_index([F.col("id") % 16, F.floor(F.col("id") / 16)], 4).alias("hilbert_index")).collect()}
    n_levels, c_levels = {}, {}
    for r in out:
        cell = curve[r["hilbert_index"]]["id"]
        n_levels.setdefault(cell % 16, []).append(r["n"])
        c_levels.setdefault(r["c"], set()).add(cell // 16)
    assert len(n_levels) == 16 and max(map(len, n_levels.values())) <= 80  # an outlier leaves the others their levels
    assert c_levels == {c: {brute_level([x for _, x in rows], c, 4)} for c in (None, *"abcde")}


def test_the_query_against_brute_force_and_files_are_pruned(spark, tmp_path):
    rng = random.Random(8)
    texts = ["same" if i % 10 == 0 else None if i % 97 == 5 else "ü" * rng.randint(0, 400) for i in range(2400)]
    rows = [(i, t, rng.choice(["en", "de"]), rng.choice("abcd"), 0, i) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int").write.parquet(f"{tmp_path}/documents.parquet")
    out = op10_hilbert_shards(spark, str(tmp_path)).collect()
    want = {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in out} == want and len(out) == len(rows)
    assert {(r["law"], r["grown_shard"]) for r in out} == {("rows", None)}
    by = [[r for r in out if r["shard"] == s] for s in range(24)]
    assert all(sorted(r["slot"] for r in x) == list(range(100)) for x in by)
    boxes = [[(min(r[c] for r in x), max(r[c] for r in x)) for c in ("lang", "source", "size", "doc_id")] for x in by]
    spans = lambda k, v: sum(b[k][0] <= v <= b[k][1] for b in boxes) / 24
    # a filter on any one dimension skips files; in a random order it skips none
    assert spans(0, "de") < 0.8 and spans(1, "a") < 0.8 and spans(2, 300) < 0.8 and spans(3, 1200) < 0.8
