import random
import re
from collections import Counter

import pytest

from trackloom.llm import rollup
from trackloom.llm.op1 import default_tokenizer
from trackloom.llm.op5 import maintain, op5_token_rollup, tokenizers


def counted(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, tokenizer_version string, tokens bigint")


def read(spark, store):
    return {(r["source"], r["lang"], r["tokenizer_version"]): (r["documents"], r["tokens"]) for r in rollup.totals(spark, store).collect()}


def test_random_batches_add_up_and_repeats_change_nothing(spark, tmp_path):
    rng = random.Random(1)
    store, live = str(tmp_path / "s"), {}
    for batch in range(6):
        row = lambda i: (i, rng.choice(["hot", "hot", "b", None]), rng.choice(["en", None]), f"v{rng.randint(1, 2)}", rng.randint(0, 50))
        fresh = {i: row(i) for i in range(batch * 20, batch * 20 + 20)}
        gone = [i for i in live if rng.random() < 0.2]
        changed = [i for i in live if i not in gone and rng.random() < 0.3]
        after = {i: row(i) for i in changed}
        signed = rollup.inserts(counted(spark, list(fresh.values())))
        if gone:
            signed = signed.union(rollup.deletes(counted(spark, [live[i] for i in gone])))
        if changed:
            signed = signed.union(rollup.revisions(counted(spark, [live[i] for i in changed]), counted(spark, list(after.values()))))
        assert rollup.commit(store, f"b{batch}", signed) is True
        assert rollup.commit(store, f"b{batch}", signed) is False
        live = {i: r for i, r in (live | fresh | after).items() if i not in gone}
        want_n, want_t = Counter(), Counter()
        for _, source, lang, version, tokens in live.values():
            want_n[source, lang, version] += 1
            want_t[source, lang, version] += tokens
        assert read(spark, store) == {k: (n, want_t[k]) for k, n in want_n.items()}


def test_broken_batches_do_not_count_and_one_writer_wins(spark, tmp_path):
    store = str(tmp_path / "s")
    one = rollup.inserts(counted(spark, [(1, "a", "en", "v", 5)]))
    one.write.parquet(f"{store}/_made-broken")  # a writer that broke off before its rename
    assert rollup.committed(spark, store) == [] and read(spark, store) == {}
    assert rollup.commit(store, "x", one) and read(spark, store) == {("a", "en", "v"): (1, 5)}
    one.write.parquet(f"{store}/_made-late")  # a second writer that didn't see the first
    assert rollup._publish(spark, f"{store}/_made-late", f"{store}/batch=x") is False
    assert read(spark, store) == {("a", "en", "v"): (1, 5)} and not (tmp_path / "s" / "_made-late").exists()
    with pytest.raises(ValueError):
        rollup.commit(store, "../x", one)


def test_compaction_keeps_totals_and_ids(spark, tmp_path):
    store = str(tmp_path / "s")
    for i in range(4):
        rollup.commit(store, f"b{i}", rollup.inserts(counted(spark, [(i, "a", "en", "v", 5 + i)])))
        if i % 2:
            rollup.compact(spark, store)
    rollup.commit(store, "after", rollup.deletes(counted(spark, [(0, "a", "en", "v", 5)])))
    want = {("a", "en", "v"): (3, 21)}
    assert read(spark, store) == want
    rollup.prune(spark, store)
    assert read(spark, store) == want and rollup.committed(spark, store) == ["after", "b0", "b1", "b2", "b3"]
    assert sorted(p.name.split("=")[0] for p in (tmp_path / "s").iterdir() if not p.name.startswith(("_", "."))) == ["base", "batch"]
    assert rollup.commit(store, "b1", rollup.inserts(counted(spark, [(9, "a", "en", "v", 9)]))) is False and read(spark, store) == want


def test_everything_taken_back_leaves_nothing(spark, tmp_path):
    rows = counted(spark, [(1, "a", "en", "v", 5), (1, "a", "en", "v", 5)])
    rollup.commit(str(tmp_path / "s"), "1", rollup.inserts(rows))
    rollup.commit(str(tmp_path / "s"), "2", rollup.deletes(rows))
    rollup.commit(str(tmp_path / "s"), "3", rollup.inserts(rows.limit(0)))
    assert read(spark, str(tmp_path / "s")) == {} and rollup.committed(spark, str(tmp_path / "s")) == ["1", "2", "3"]


def test_counts(spark, docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(default_tokenizer())
    texts = [None, "", "It's a naïve test", "東京 🙂", "w " * 30000]
    df = docs(list(enumerate(texts)), "7 as tokens")
    bpe = {r["doc_id"]: r["tokens"] for r in rollup.count_tokens(df, {"b": default_tokenizer()}).collect()}
    plain = {r["doc_id"]: r["tokens"] for r in rollup.count_tokens(df, {"w": None}).collect()}
    for i, t in enumerate(texts):
        assert bpe[i] == len(exact.encode(t or "", add_special_tokens=False).ids)
        assert plain[i] == len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert rollup.count_tokens(docs([]), {"w": None, "b": default_tokenizer()}).count() == 0


def test_the_query_against_brute_force(spark, tmp_path):
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(tokenizers()["byte_bpe_50k"])
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizers()["byte_bpe_multi_50k"], "rb"))}
    multi = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    count = {"byte_bpe_50k": lambda t: len(exact.encode(t, add_special_tokens=False).ids), "byte_bpe_multi_50k": lambda t: len(multi.encode_ordinary(t))}
    rng = random.Random(2)
    texts = [None, "", "\n\n", "a\nb\na", "同じ\n同じ\nline"] + ["\n".join(rng.choice(["one line", "d\u00e9j\u00e0 vu", "x"]) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    rows = [(i if i % 9 else None, t, "en" if i % 2 else None, "hot" if i % 3 else f"s{i % 4}", 0) for i, t in enumerate(texts)] + [(5, "again", "de", "hot", 0), (5, "again", "de", "hot", 0)]
    labels = [(i, int(i % 4 != 1), 0) for i in range(0, 60, 2)] + [(5, 0, 0), (5, 1, 0), (None, 0, 0), (7, None, 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    low = {i for i, q, _ in labels if q == 0 and i is not None}
    n, tokens = Counter(), Counter()
    for i, t, lang, source, _ in rows:
        if i not in low:
            final = "\n".join(dict.fromkeys((t or "").split("\n")))
            for version, f in count.items():
                n[source, lang, version] += 1
                tokens[source, lang, version] += f(final)
    got = {(r["source"], r["lang"], r["tokenizer_version"]): (r["documents"], r["tokens"]) for r in op5_token_rollup(spark, str(tmp_path)).collect()}
    assert got == {k: (c, tokens[k]) for k, c in n.items()}
    docs, marks = spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")
    assert maintain(docs, marks, str(tmp_path / "store"), {"w": None}) == [True, True, False, True]
    assert maintain(docs, marks, str(tmp_path / "store"), {"w": None}) == [False] * 4
    assert maintain(docs.limit(0), marks.limit(0), str(tmp_path / "none"), {"w": None}) == [True, True, False, True] and rollup.totals(spark, str(tmp_path / "none")).count() == 0
