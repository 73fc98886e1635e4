import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from trackloom.llm import toxicity as tox
from trackloom.llm.op8 import op8_toxicity
from trackloom.llm.stages import drop_toxic


@pytest.mark.parametrize("text,want", [("", " "), (None, " "), ("Idiot!", " idiot "), ("1d10t", " idiot "), ("ІDІОТ", " idiot "), ("i.d.i.o.t", " idiot "), ("id​iot", " idiot "), ("ｉｄｉｏｔ", " idiot "), ("!diot", " idiot "), ("you, idiot", " you idiot "), ("loser", " ioser "), ("1oser l0ser", " ioser ioser "), ("p@th3tic", " pathetic "), ("ｋｉｌｌ", " kiii "), ("ｋ１ｌｌ", " kiii "), ("you！idiot。idiot", " you idiot idiot "), ("𝐢𝐝𝐢𝐨𝐭", " idiot "), ("𝓘𝓓𝓘𝓞𝓣🙂idiot", " idiot idiot "), ("ïdíöt", " idiot "), ("Größe", " größe".replace("ö", "o") + " "), ("東京、idiot", " 東京 idiot ")])
def test_folding(text, want):
    assert tox.fold(text or "") == want


def test_matching_spares_phrases_and_counts_words_once():
    m = tox.Matcher({" idiot ": 2.0, " idio": 1.0, " ciown ": 3.0}, frozenset([" ciown fish "]))
    assert sorted(w for _, w in m.hits(tox.fold("idiot idiot idiots clown clown fish"))) == [1.0, 2.0, 2.0, 3.0]
    assert tox.Matcher({}).hits(" a ") == []


def corpus(n=900):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "stupid", "lowei" + rng.choice(["ung", "heit", "er"])]))
        elif rng.random() < 0.05:
            words.insert(3, "clown fish")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_obfuscation_and_stage(spark, docs):
    rows, labels = corpus()
    df, lab = docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = tox.train(df, lab)
    assert model == tox.train(df.repartition(5), lab)
    extra = [(5000, "w1 w2 1d10t w4 5tup1d w9 you ІDІОТ"), (5001, None), (5002, ""), (5003, "w1 w2 " * 9000), (None, "w3 w4"), (5004, "the idiot " * 40)]
    got = {r["doc_id"]: r["score"] for r in tox.score(docs(rows + extra), model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i] >= 0.5) == labels[i][2] for i in held)
    assert right / len(held) > 0.97
    assert got[5000] >= 0.5 and got[5004] >= 0.5 and max(got[5001], got[5002], got[5003], got[None]) < 0.5
    kept = drop_toxic(docs(rows + extra, "'x' as score"), df, lab)
    assert kept.columns[-1] == "score" and {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_held_out_rows_are_never_learnt(spark, docs):
    rows, labels = corpus(300)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    a, b = (tox.train(docs(rows), spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")) for x in (labels, flipped))
    assert a == b


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (None, 0, 1), (2, 1, None)], "doc_id bigint, quality int, toxic int")
    for labels in (none, one):
        model = tox.train(docs([(1, "a"), (2, "b")]), labels)
        assert all(r["score"] < 1e-6 for r in tox.score(docs([(1, "a"), (None, None)]), model).collect())
    assert tox.score(docs([]), model).count() == 0


def test_held_out_column(spark):
    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", tox.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert spark.range(1).select(F.lit(None).cast("bigint").alias("doc_id")).select(tox.held_out().alias("h")).first()["h"] is False


def test_the_query_against_its_model(spark, tmp_path):
    rows, labels = corpus(600)
    rows += [(9000, None), (9001, ""), (None, "you idiot"), (3, rows[3][1])]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = op8_toxicity(spark, str(tmp_path)).collect()
    model = tox.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    matcher, (bias, a, b) = tox.Matcher(model["weights"], frozenset(model["phrases"])), model["logistic"]
    texts = {(i, t) for i, t in rows}
    want = {}
    for i, t in texts:
        s, d = tox.features(matcher, t)
        want[i] = 1 / (1 + math.exp(-max(-30, min(30, bias + a * s + b * d))))
    assert len(out) == len(rows)
    for r in out:
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-9 and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    right = [r["predicted"] == labels[r["doc_id"]][2] for r in out if r["held_out"] and r["doc_id"] < 600]
    assert sum(right) / len(right) > 0.97
