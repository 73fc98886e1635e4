"""The stages of the pipeline one after the other, each held against brute force on its own input."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from test_mixing import brute_targets
from test_pii import brute as personal
from test_simhash import resemblance
from test_toxicity import corpus

from trackloom.llm import toxicity as tox

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic ones, copies, near copies, personal data, nulls and empty texts."""
    path = tmp_path_factory.mktemp("pipeline")
    rng = random.Random(11)
    rows, labels = corpus(500)
    texts = dict(rows)
    clean = [i for i, _, bad in labels if not bad]
    for k in range(60):
        words = texts[clean[k]].split()
        if k % 3 == 1:  # a near copy or something further away
            words = words[: len(words) - rng.randint(1, len(words) // 3)]
        texts[1000 + k] = " ".join(words)
    for k in range(20):
        texts[2000 + k] = texts[clean[100 + k]] + f" write to user{k}@mail{k}.example.com or call +1 (017) 555-77{k:02}"
    texts |= {3000: None, 3001: "", 3002: "one", 3003: "1.2.3.4"}
    full = [(i, t, "en", "hot" if i % 3 else f"s{i % 5}", None if t is None else len(t)) for i, t in texts.items()]
    spark.createDataFrame(full, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def check_toxicity(spark, folder, before, after):
    model = tox.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    matcher, (bias, a, b) = tox.Matcher(model["weights"], frozenset(model["phrases"])), model["logistic"]
    fine = [r for r in before if bias + a * tox.features(matcher, r["text"])[0] + b * tox.features(matcher, r["text"])[1] < 0]
    assert sorted(map(repr, after)) == sorted(map(repr, fine)) and len(fine) < len(before)


def check_near_duplicates(spark, folder, before, after):
    parts = [[w.lower() for w in words(r["text"])] for r in before]
    label = list(range(len(before)))
    for i, a in enumerate(parts):
        for j in range(i):
            if label[i] != label[j] and (a == parts[j] or (a and parts[j] and resemblance(a, parts[j]) >= 0.8)):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    kept = {min((r["doc_id"] for r, x in zip(before, label, strict=True) if x == k)) for k in set(label)}
    assert {r["doc_id"] for r in after} == kept and len(after) == len(kept) < len(before)
    assert {repr(r) for r in after} <= {repr(r) for r in before}


def check_personal_data(spark, folder, before, after):
    old = {r["doc_id"]: r for r in before}
    assert len(after) == len(before)
    for r in after:
        was = old[r["doc_id"]]
        assert (r["lang"], r["source"], r["n_chars"]) == (was["lang"], was["source"], len(r["text"] or ""))
        spans = personal(was["text"] or "")
        assert not personal(r["text"] or "") and (r["text"] != was["text"]) == bool(spans)
        assert sum((r["text"] or "").count(f"[{k}]") for k in ("EMAIL", "IP", "CARD", "PHONE")) <= len(spans) or not spans


def check_mixing(spark, folder, before, after):
    total, taken = Counter(), Counter()
    for r in before:
        total[r["source"]] += len(words(r["text"]))
    for r in after:
        taken[r["source"]] += len(words(r["text"]))
    want = brute_targets(dict(total))
    longest = max(len(words(r["text"])) for r in before)
    assert all(abs(taken[s] - want[s]) <= max(0.01 * want[s], longest) for s in total)
    assert set(map(repr, after)) <= set(map(repr, before)) and max(Counter(map(repr, after)).values()) <= 3


def check_packing(spark, folder, before, after):
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} and sum(r["piece"] == 0 for r in after) == len(before)
    bins = defaultdict(list)
    for r in after:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 1024


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert out.dtypes == docs.dtypes
        globals()[f"check_{name}"](spark, folder, docs.collect(), out.collect())
        docs = out


def test_run_is_the_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    bins = defaultdict(int)
    for r in out:
        bins[r["sequence_id"]] += r["length"]
    assert out and max(bins.values()) <= 1024 and not {r["doc_id"] for r in out} & set(range(1000, 1060, 3))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, folder, name):
    docs = spark.createDataFrame([], COLUMNS)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, folder).count() == 0


def test_many_near_copies_are_not_broadcast(spark, monkeypatch):
    """The keys of documents that go are a share of the documents: beyond FEW_ROWS they meet by a shuffle, with the same rows."""
    from pyspark.sql import functions as F

    from trackloom.llm import simhash, stages

    gone, key = 100_001, F.col("key.b")
    docs = spark.range(2 * gone).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    pairs = lambda rows, _: rows.select("key", F.when(key % 2 == 0, F.col("key")).otherwise(F.col("key").withField("b", key - 1)).alias("component_id"))
    monkeypatch.setattr(simhash, "near_copies", pairs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = stages.drop_near_copies(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Broadcast" not in plan
        assert kept.agg(F.count("*"), F.count_if(F.col("doc_id") % 2 == 1)).first()[:] == (gone, 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
