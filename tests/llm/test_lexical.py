import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trackloom.llm import lexical
from trackloom.llm.op13 import op13_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    tfs = [(i, Counter(words(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in tfs), sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked[i] = max(asked.get(i, ""), t or "")
    out = set()
    for item, text in asked.items():
        found = []
        for i, c in tfs:
            score = 0
            for t in words(text):
                if t in c:
                    m = 100 - 75 + (75 * c.total() * n_docs) // length
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0 and i is not None:
                found.append((-score, i))
        out |= {(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])}
    return out


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "ünder", "ñA", "東京", "x1", "İ", "ß"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, rng.choice(["", " ", "-", "\x00"]) + rng.choice([" ", ",", "\n", "_"]).join(rng.choices(vocabulary, weights, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "... --"), (None, "w1 w2 ünder"), (5, docs[5][1]), (2003, "w3 " * 100_000 + "X1"), (2004, "KELVIN K K")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(40)] + [(50, None), (51, ""), (52, "nowhere"), (53, "w1 W1 w1 w1 w1 x1"), (None, "w1"), (3, "w9"), (54, "K k")]
    return docs, items


@pytest.mark.parametrize("block,batch,chunk", [(8192, 256, 16 << 20), (50, 7, 16 << 20), (64, 256, 1500)])
def test_against_brute_force(spark, monkeypatch, block, batch, chunk):
    for name, value in (("BLOCK", block), ("BATCH", batch), ("CHUNK_BYTES", chunk), ("SENT", 300)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = corpus()
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, score int").repartition(3)
    asked = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, term string")
    rows = [tuple(r) for r in lexical.search(df, asked, "item_id", 7).collect()]
    assert set(rows) == brute(docs, items, 7) and len(rows) == len(set(rows))


def test_the_query_against_brute_force(spark, tmp_path):
    docs, items = corpus(600, 5)
    spark.createDataFrame([(*r, "e") for r in docs], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = op13_lexical_search(spark, str(tmp_path))
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in out.collect()} == brute(docs, items)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a"), (2, "b")], [(1, None)]), ([(1, "a")], [(1, "a")])])
def test_few_and_none(spark, docs, items):
    made = [spark.createDataFrame(x, f"{c} bigint, text string") for x, c in ((docs, "doc_id"), (items, "item_id"))]
    assert {tuple(r) for r in lexical.search(*made, "item_id").collect()} == brute(docs, items)


def test_bitmaps_add_and_rank_like_integers():
    rng = np.random.default_rng(2)
    sums, want = np.zeros((lexical.BITS, 3, 10), np.uint8), np.zeros((3, 80), np.int64)
    for shift in (0, 1, 3, 0):
        places = np.sort(rng.choice(80, 30, replace=False))
        values = rng.integers(0, 1 << 36, 30)
        lexical.add(sums, np.array([0, 2]), *lexical.sliced(places, values), shift)
        want[np.ix_([0, 2], places)] += values << shift
    query, place = np.divmod(np.arange(240), 80)
    assert (lexical.values_at(sums, query, place) == want.ravel()).all()
    for k in (1, 5, 79):
        sure, tied = (np.unpackbits(x, axis=1) for x in lexical.best_places(sums, k))
        for q in range(3):
            top = sorted(want[q][want[q] > 0])[-k:]
            both = want[q][(sure[q] | tied[q]) > 0]
            assert sorted(both)[-k:] == top and sure[q].sum() <= k


def test_terms():
    for text in ("", "a_b", "ÄB cK", "1a-2", "x\x00y\x7fz", "日本 K"):
        assert [t.decode() for t in lexical.terms(text.encode())] == words(text)
