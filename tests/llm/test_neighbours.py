import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import neighbours as nb
from trackloom.llm.op11 import op11_quality_votes

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    vocabulary = {lang: [f"{lang}{i}" for i in range(200)] for lang in ("wa", "lö", "цы")}
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary[rng.choice(list(vocabulary))], k=rng.randint(15, 150))
        good = rng.random() > 0.25
        if not good:
            kind = rng.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + rng.choice(["###", "%%"]) for w in words] if kind == 1 else [w for w in words[:6] for _ in range(20)]
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(good), 0))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_defined_cases(spark, docs):
    rows, labels = corpus()
    df, lab = docs(rows), spark.createDataFrame(labels, LABELS)
    model = nb.train(df, lab)
    again = nb.train(df.repartition(5), lab)
    assert set(model) == set(again) and all(np.allclose(model[k], again[k]) for k in model)
    extra = [(5000, None), (5001, ""), (5002, "wa1 wa2 wa3 " * 40_000), (None, "wa3 wa4"), (5003, rows[0][1]), (5004, "\x00\n\r\t")]
    out = nb.score(docs(rows + extra, "'x' as score"), model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    assert len(got) == len(rows) + len(extra) and all(0 <= s <= 1 for s in got.values())
    right = [(got[i] >= 0.5) == labels[i][1] for i, _ in rows if held(i)]
    assert sum(right) / len(right) > 0.97
    assert got[5000] == got[5001] and got[5003] == got[0]


def test_held_out_rows_are_never_learnt(spark, docs):
    rows, labels = corpus(300)
    flipped = [(i, 1 - q if held(i) else q, t) for i, q, t in labels]
    a, b = (nb.train(docs(rows), spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_copies_vote_once_and_the_fit_is_bounded(spark, docs, monkeypatch):
    monkeypatch.setattr(nb, "FIT_ROWS", 50)
    rows, labels = corpus(400)
    rows = [(i, rows[0][1] if i % 2 else t) for i, t in rows]
    model = nb.train(docs(rows), spark.createDataFrame(labels, LABELS))
    assert len(model["labels"]) <= 50
    assert (np.linalg.norm(model["voters"][:, None] - model["voters"][None, :], axis=2) < 1e-6).sum() < 2 * len(model["labels"])


def test_without_labels_of_both_kinds(spark, docs):
    one, two, three = [i for i in range(20) if not held(i)][:3]
    few = docs([(one, "a"), (two, "b"), (three, "c"), (None, "d")])
    for labels, want in (([], 0.5), ([(i, 1, 0) for i in (one, two, three)], 1.0), ([(two, 0, 0), (None, 1, 0), (three, None, 0), (one, 7, 0)], 0.0)):
        model = nb.train(few, spark.createDataFrame(labels, LABELS))
        assert {r["score"] for r in nb.score(few, model).collect()} == {want}
    assert nb.score(docs([]), nb.train(docs([]), spark.createDataFrame([], LABELS))).count() == 0


def test_votes_against_every_cosine_in_turn():
    rng = np.random.default_rng(3)
    x = rng.poisson(0.05, (120, nb.DIMENSIONS)).astype(np.float32)
    y = (rng.random(120) > 0.3).astype(float)
    model = nb.fit(x, y)
    got = nb.votes(model, x[:20])
    for row, score in zip(x[:20], got):
        latent = nb.weighted(row[None], model["idf"])[0].astype(float) @ model["axes"].astype(float)
        cosine = [float(latent @ v) / np.linalg.norm(latent) / np.linalg.norm(v) for v in model["voters"].astype(float)]
        near = sorted(range(120), key=lambda i: -cosine[i])[: nb.K]
        weight = [(max(cosine[i], 0) ** nb.POWER + 1e-9) * (0.5 / (y.mean() if y[i] else 1 - y.mean())) ** 0.5 for i in near]
        assert abs(sum(w * y[i] for w, i in zip(weight, near)) / sum(weight) - score) < 1e-4


@pytest.mark.parametrize("stretch", [3, 10, 1 << 16])
def test_stretches_make_whole_texts(monkeypatch, stretch):
    text = ("Ab1 c\nß!! " * 30).encode()
    whole = nb.triples(text)
    monkeypatch.setattr(nb, "STRETCH", stretch)
    assert (nb.triples(text) == whole).all() and whole.sum() == len(text) - 2


def test_the_query_against_its_model(spark, tmp_path):
    rows, labels = corpus(500)
    rows += [(9000, None), (9001, ""), (None, "wa1"), (3, rows[3][1])]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    out = op11_quality_votes(spark, str(tmp_path)).collect()
    model = nb.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    texts = dict(rows)
    assert len(out) == len(rows)
    for r in out:
        text = texts[r["doc_id"]]
        want = nb.votes(model, nb.matrix([None if text is None else text.encode()]))[0]
        assert abs(r["score"] - want) < 1e-4 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"]))
    assert spark.range(1).select(F.lit(None).cast("bigint").alias("doc_id")).select(nb.held_out().alias("h")).first()["h"] is False
