"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding: compatibility forms (full-width, mathematical and other styled letters and signs) become plain ones and
marks on letters go; lower case; letters that look like Latin ones become those; digits and signs that stand for
letters inside words become those letters; i and l become one letter, as 1 stands for both; marks that join or
hide (zero-width characters, soft hyphens) vanish; a word spelt with a sign after each letter is joined. What is
left splits at characters that are no letters, numbers or marks, of any script. So `1d10t` and `idiot` fold alike.

The lexicon has whole words and word beginnings, learnt from labelled rows: a beginning enters if toxic
documents hold it more often than chance allows, and stands for all words that begin with it. Its weight is
its smoothed log-odds. Phrases of a lexicon word and a neighbour that occur in clean documents but hardly in
toxic ones are exceptions; a match inside one doesn't count. The sum of weights, and the sum per thousand
words, go through a logistic function fitted on the same rows.

The fit sees at most FIT_ROWS labelled documents, chosen by a hash of their ids and rid of copies; scoring
covers all documents and whole texts. Nulls: a null text is empty; an empty text scores as a text without
matches. A null doc_id is never a training row. Repeated rows get equal scores. Without any labelled row the
score is nearly 0 for all.
"""

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import cut, prepare

#: Labelled documents that the fit sees at most.
FIT_ROWS = 16_000
#: Terms that the lexicon has at most, and exception phrases.
MOST_TERMS, MOST_PHRASES = 4000, 2000
#: Chance of a term as one-sided as a lexicon term's counts, at most.
CHANCE = 1e-6
BEGINNINGS = (3, 4, 5, 6, 7)

#: Letters of other scripts that look like Latin ones, pairs of look-alike and Latin letter.
LOOKALIKES = "аa вb сc еe нh іi јj кk мm оo рp ѕs тt уy хx ԁd ԛq ԝw һh αa βb εe ηn ιi κk νv οo ρp τt υu χx ϲc ɑa ɡg ɩi ıi"
#: Digits and signs that stand for letters inside words.
STAND_INS = "0o 1i 3e 4a 5s 7t 8b 9g @a $s !i |i €e"
#: Characters that join or hide: soft hyphen, zero-width space and joiners, word joiner, byte-order mark.
HIDDEN = "­​‌‍⁠﻿"

_sign_in_word = re.compile(r"(?<![^\W])[@$!|€](?=\w)|(?<=\w)[@$!|€](?=\w)")
_spelt = re.compile(r"(?<!\w)\w(?:[.\-_*]\w){2,}(?!\w)")


class Folding(dict):
    """For str.translate: letters fold, what isn't part of a word splits, the marks that NFKD sets apart go; filled as characters come."""

    def __missing__(self, code: int) -> str | int | None:
        kind = unicodedata.category(chr(code))
        self[code] = found = None if kind == "Mn" else code if kind[0] in "LNM" else " "
        return found


@cache
def folding() -> Folding:
    table = Folding({ord(pair[0]): pair[1] for pair in [*LOOKALIKES.split(), *STAND_INS.split()]})
    return Folding(table | {ord(ch): " " for ch in "@$!|€_"} | {ord(ch): None for ch in HIDDEN} | {ord("l"): "i"})


@cache
def ascii_folding() -> dict[int, str]:
    return {code: x if isinstance(x := folding()[code], str) else chr(x) for code in range(128)}


_hidden = re.compile(f"[{HIDDEN}]")
#: Full-width signs end words in the scripts that use them, so they split and stand for no letter.
_wide_sign = re.compile("[\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_signs = {pair[0]: pair[1] for pair in STAND_INS.split()}


def fold(text: str) -> str:
    """Folded words between single spaces, with a space at either end; none: one space."""
    if not text.isascii():
        text = _hidden.sub("", unicodedata.normalize("NFKD", _wide_sign.sub(" ", text)))
    text = text.lower()
    if _sign_in_word.search(text):
        text = _sign_in_word.sub(lambda m: _signs[m[0]], text)
    text = _spelt.sub(lambda m: re.sub(r"[.\-_*]", "", m[0]), text)
    words = text.translate(ascii_folding() if text.isascii() else folding()).split()
    return f" {' '.join(words)} " if words else " "


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def terms(folded: str) -> set[str]:
    """Whole words as ` word `, beginnings as ` begin`."""
    out = set()
    for w in set(folded.split()):
        if len(w) <= 40:
            out.add(f" {w} ")
            out.update(f" {w[:k]}" for k in BEGINNINGS if len(w) >= k)
    return out


def tail(n: int, k: int, p: float) -> float:
    """P(at least k of n) for a chance p each; 0 below 1e-300."""
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    top = max(log)
    return math.exp(min(0.0, top + math.log(sum(math.exp(x - top) for x in log))))


def choose_terms(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """The lexicon: weights of terms, given (term, toxic documents, clean documents)."""
    base = n_toxic / max(n_toxic + n_clean, 1)
    by = {t: (a, b) for t, a, b in counts if a * n_clean > 4 * b * n_toxic and tail(min(a + b, 60), min(a, 60 - min(b, 59)), base) <= CHANCE}
    weight = lambda t: math.log((by[t][0] + 0.5) / (n_toxic + 1)) - math.log((by[t][1] + 0.5) / (n_clean + 1))
    ordered = sorted(by)
    longer = lambda t: ordered[bisect_right(ordered, t) : bisect_right(ordered, t + chr(0x10FFFF))]
    chosen: dict[str, float] = {}
    for t in sorted(by, key=lambda t: (len(t.rstrip()), not t.endswith(" "), t)):
        if any(t.startswith(c) for c in (t.rstrip()[:k] for k in range(4, len(t.rstrip()) + 1)) if c in chosen and c != t):
            continue  # a beginning of it is in, and stands for it
        longest = t  # the longest term that nearly all of its documents hold
        while True:
            more = [u for u in longer(longest) if by[u][0] >= 0.97 * by[t][0]]
            if not more or longest.endswith(" "):
                break
            longest = max(more, key=lambda u: (by[u][0], u.endswith(" "), -len(u)))
        chosen[longest] = weight(longest)
    return dict(sorted(chosen.items(), key=lambda x: (-by[x[0]][0] * x[1], x[0]))[:MOST_TERMS])


class Matcher:
    """Aho-Corasick over the terms and the exception phrases of a lexicon."""

    def __init__(self, weights: dict[str, float], phrases: frozenset[str] = frozenset()):
        self.automaton = ahocorasick.Automaton()
        for t, w in weights.items():
            self.automaton.add_word(t, (len(t), w))
        for p in phrases:
            self.automaton.add_word(p, (len(p), None))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of each word that the lexicon holds, one a word, but those within an exception phrase."""
        if self.empty:
            return []
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, w) in self.automaton.iter(folded):
            start = end - n + 1
            if w is None:
                spared.append((start, end))
            else:
                found[start] = max(w, found.get(start, -math.inf))
        if spared:
            return [(s, w) for s, w in found.items() if not any(a <= s < b for a, b in spared)]
        return list(found.items())


def features(matcher: Matcher, text: str | None) -> tuple[float, float]:
    """The sum of weights, and per thousand words, by logarithm."""
    folded = fold(text or "")
    total = sum(w for _, w in matcher.hits(folded))
    return math.log1p(max(total, 0.0)), math.log1p(1000 * max(total, 0.0) / max(folded.count(" ") - 1, 20))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> list[float]:
    """Bias and weights by Newton's method with a ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (p - y) + penalty @ b
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + penalty, grad)
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b.tolist()


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict:
    """A model from the documents labelled 0 or 1 that aren't held out."""
    prepare(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    usable = cut(usable)
    n = usable.count()
    share = min(1.0, FIT_ROWS / max(n, 1))
    sample = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) < int(share * 0.97 * (1 << 30)) if share < 1 else F.lit(True)).limit(FIT_ROWS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Folded texts with the least hash of their word triples, which copies share."""
        for batch in batches:
            folded = [fold(t or "") for t in batch.column(0).to_pylist()]
            words = [f.split() for f in folded]
            least = [min((xxhash.xxh64_intdigest(" ".join(w[i : i + 3])) >> 1 for i in range(max(1, len(w) - 2))), default=0) for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(least, pa.int64()), pa.array(folded), batch.column(1)], names=["least", "folded", "y"])

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "y").mapInArrow(sketch, "least bigint, folded string, y int")
    rows = cut(rows.groupBy("least").agg(F.min(F.struct("folded", "y")).alias("r")).select("r.*"))
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    model = {"weights": {}, "phrases": [], "logistic": None}
    if not n_toxic or not n_clean:
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = list(set(seen[0]) | set(seen[1]))
            batch = pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "a": pa.array([seen[1][t] for t in names], pa.int64()), "b": pa.array([seen[0][t] for t in names], pa.int64())})
            seen[0].clear(), seen[1].clear()
            return batch

        for batch in batches:
            for folded, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(terms(folded))
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield out()
        yield out()

    counted = rows.mapInArrow(count, "term string, a bigint, b bigint").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    strong = counted.where((F.col("a") >= 3) & (F.col("a") * n_clean > F.col("b") * (4 * n_toxic))).orderBy((F.col("a") * F.log((F.col("a") + 0.5) * n_clean / ((F.col("b") + 0.5) * n_toxic))).desc(), "term").limit(5 * MOST_TERMS)
    model["weights"] = choose_terms([(r["term"], r["a"], r["b"]) for r in strong.collect()], n_toxic, n_clean)
    weights = model["weights"]

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights)
        for batch in batches:
            out: list[tuple[str, int]] = []
            for folded, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set()
                for s, _ in matcher.hits(folded):
                    e = folded.index(" ", s + 1)
                    before, after = folded.rfind(" ", 0, s), folded.find(" ", e + 1)
                    found |= ({folded[before : e + 1]} if before >= 0 else set()) | ({folded[s : after + 1]} if after >= 0 else set())
                out += [(f, y) for f in found]
            yield pa.RecordBatch.from_pydict({"phrase": pa.array([p for p, _ in out], pa.string()), "y": pa.array([y for _, y in out], pa.int32())})

    phrases = rows.mapInArrow(neighbours, "phrase string, y int").groupBy("phrase").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    spared = phrases.where((F.col("b") >= 3) & (F.col("b") * n_toxic > F.col("a") * (4 * n_clean))).orderBy(F.col("b").desc(), "phrase").limit(MOST_PHRASES).collect()
    model["phrases"] = [r["phrase"] for r in spared]
    phrase_set = frozenset(model["phrases"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights, phrase_set)
        for batch in batches:
            found = [features(matcher, f) for f in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"s": pa.array([a for a, _ in found], pa.float64()), "d": pa.array([b for _, b in found], pa.float64()), "y": batch.column(1)})

    seen = rows.mapInArrow(measure, "s double, d double, y int").toArrow()  # FIT_ROWS rows at most
    order = np.lexsort((seen["y"].to_numpy(), seen["d"].to_numpy(), seen["s"].to_numpy()))
    model["logistic"] = fit_logistic(np.column_stack([seen["s"].to_numpy(), seen["d"].to_numpy()])[order], seen["y"].to_numpy()[order].astype(float))
    return model


def score(docs: DataFrame, model: dict) -> DataFrame:
    """`docs` with a column score, in the stead of one of that name; other columns pass through."""
    prepare(docs.sparkSession)
    weights, phrases, logistic = model["weights"], frozenset(model["phrases"]), model["logistic"]

    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(weights, phrases)
        for batch in texts:
            found = np.array([features(matcher, t) for t in batch]).reshape(-1, 2)
            z = np.full(len(found), -30.0) if logistic is None else np.clip(logistic[0] + found @ np.array(logistic[1:]), -30, 30)
            yield pd.Series(1 / (1 + np.exp(-z)))

    return docs.withColumn("score", F.pandas_udf(rate, "double")("text"))
