"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A document becomes counts over DIMENSIONS hashed features: its words; triples of neighbouring character kinds (letters
of either case, digits, white space and each sign are kinds of their own, so layout, case and junk show in any
language); and, by logarithmic steps, how often it repeats its words and lines and how long these are. Counts
are dampened by logarithm and weighted by inverse document frequency; the truncated singular value decomposition of the labelled
rows' matrix gives DEPTH latent dimensions. The labelled rows' latent vectors, of unit length, are
broadcast (FIT_ROWS of them at most, 1 MB), and each block of documents is multiplied with all of them, so every cosine is
computed. The K nearest vote with their labels, weighted by a power of their cosines and by the rarity of the label.

The fit sees at most FIT_ROWS labelled rows, chosen by a hash of their ids, each text once; that bound is a
parameter. Scores cover all documents and whole texts. Defined cases: a null text is empty; an empty text has features
of its own (no words, no lines), so it is scored like any other; a null doc_id never votes and isn't held out; repeated
rows get equal scores; of a text with several labels the majority's counts, ties to 0. Without labelled rows of both
kinds the score is that of the only kind there is, or 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import cut, prepare

#: Labelled documents that vote at most, hashed features, latent dimensions, voters a document.
FIT_ROWS, DIMENSIONS, DEPTH, K = 4096, 1024, 64, 15
#: Cosines count by this power, so that near voters outweigh far ones.
POWER = 4
#: Documents in a block of cosines, bytes in a stretch of a text.
BLOCK, STRETCH = 512, 1 << 16

_words, _kinds, _shape = range(3)
#: Hashed features that words, triples of kinds and the shape of a text share out.
_shares = (448, 448, 128)

#: Bytes by kind: letters of ASCII by case, digits, space, line ends, further bytes of letters beyond ASCII; signs stand alone.
_kind = np.arange(256, dtype=np.uint32)
_kind[ord("a") : ord("z") + 1], _kind[ord("A") : ord("Z") + 1], _kind[ord("0") : ord("9") + 1] = 1, 2, 3
_kind[128:] = 1
_kind[[9, 32]], _kind[[10, 11, 12, 13]] = 4, 5
_folded = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_line = re.compile(rb"[\n-\r]+")


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def triples(text: bytes) -> np.ndarray:
    """Counts of triples of neighbouring kinds, in cells by multiplication with an odd constant (2**32 over the golden ratio)."""
    out = np.zeros(_shares[_kinds])
    for at in range(0, len(text), STRETCH):  # stretches overlap by two
        k = _kind[np.frombuffer(text[at : at + STRETCH + 2], np.uint8)]
        if len(k) > 2:
            mixed = ((k[:-2] << 16) | (k[1:-1] << 8) | k[2:]) * np.uint32(0x9E3779B9)
            out += np.bincount((mixed >> np.uint32(16)) * np.uint32(_shares[_kinds]) >> np.uint32(16), minlength=_shares[_kinds])
    return out


def _step(x: float) -> int:
    """Half powers of two, 0 to 15."""
    return int(np.clip(round(2 * np.log2(max(x, 1e-9))) + 8, 0, 15))


def shape(words: Counter, n_words: int, lines: list[bytes], size: int) -> list[int]:
    """Cells for how a text repeats itself and how long its words and lines are: eight figures, a cell of 16 each."""
    n_lines = max(len(lines), 1)
    most = max(words.values(), default=0)
    figures = (len(words) / max(n_words, 1) * 16, most / max(n_words, 1) * 16, len(set(lines)) / n_lines * 16, n_words / n_lines / 16, size / max(n_words, 1) / 4, sum(n > 2 for n in words.values()) / max(len(words), 1) * 16, n_words / 64, n_lines / 2)
    return [16 * i + _step(x) for i, x in enumerate(figures)]


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells and counts of a text in UTF-8."""
    text = text or b""
    counted = Counter(text.translate(_folded).split())
    cells = np.fromiter((xxhash.xxh32_intdigest(w) % _shares[_words] for w in counted), np.int64, len(counted))
    counts = np.fromiter(counted.values(), np.float64, len(counted))
    lines = [x for x in _line.split(text) if x.strip()]
    own = shape(counted, int(counts.sum()), lines, len(text))
    kinds = triples(text)
    at = np.flatnonzero(kinds)
    cells = np.concatenate([cells, _shares[_words] + at, np.array(own) + _shares[_words] + _shares[_kinds]])
    return cells, np.concatenate([counts, kinds[at], np.ones(len(own))])


def matrix(texts: list[bytes | None]) -> np.ndarray:
    """Dampened counts of texts, a row each."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, text in enumerate(texts):
        cells, counts = features(text)
        out[row] = np.bincount(cells, counts, DIMENSIONS)
    return np.log1p(out, out)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf, each kind of features of equal length in all."""
    x = x * idf
    edges = np.cumsum([0, *_shares])
    return unit(np.concatenate([unit(x[:, a:z]) for a, z in zip(edges, edges[1:], strict=False)], axis=1))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The latent space of labelled rows `x` (of matrix()) and their vectors in it."""
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.1
    w = weighted(x, idf)
    values, vectors = np.linalg.eigh((w.T @ w).astype(np.float64))
    top = np.argsort(values)[::-1][:DEPTH]
    axes = vectors[:, top]
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1, 1)  # signs by rule
    axes = axes.astype(np.float32)
    share = float(y.mean())
    return {"idf": idf, "axes": axes, "voters": unit(w @ axes).astype(np.float32), "labels": y.astype(np.float32), "share": share}


def votes(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of rows of matrix(): the nearest voters' labels by powers of their cosines, both labels weighing alike in all."""
    if "axes" not in model:
        return np.full(len(x), model["share"])
    cosines = unit(weighted(x, model["idf"]) @ model["axes"]) @ model["voters"].T
    k = min(K, cosines.shape[1])
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** POWER + 1e-9
    label = model["labels"][near]
    weight = weight * np.where(label > 0, 0.5 / max(model["share"], 1e-9), 0.5 / max(1 - model["share"], 1e-9)) ** 0.5
    return np.clip((weight * label).sum(axis=1) / weight.sum(axis=1), 0, 1)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict:
    """A model from documents labelled 0 or 1 that aren't held out: of 4 * FIT_ROWS of them, FIT_ROWS different texts."""
    prepare(docs.sparkSession)
    usable = cut(labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.avg(F.col(label).cast("int")).alias("y")).withColumn("lot", F.xxhash64("doc_id", F.lit("voters"))))
    share = min(1.0, 5 * FIT_ROWS / max(usable.count(), 1))
    drawn = usable.where(F.shiftrightunsigned("lot", 33) < int(share * (1 << 31))).orderBy("lot", "doc_id").limit(4 * FIT_ROWS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for at in range(0, len(texts), BLOCK):
                x = pa.array([r.tobytes() for r in matrix(texts[at : at + BLOCK])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, BLOCK), batch.column(1).slice(at, BLOCK), x], names=["key", "y", "x"])

    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).withColumn("key", F.sha2("text", 256))
    once = texts.join(F.broadcast(drawn), "doc_id").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.avg("y").alias("y"))
    once = cut(once.where(F.col("y") != 0.5).orderBy("key").limit(FIT_ROWS).select("key", "doc_id", (F.col("y") > 0.5).cast("int").alias("y")))
    rows = texts.join(F.broadcast(once), ["doc_id", "key"]).select("key", "y", "text").mapInArrow(measure, "key string, y int, x binary").toArrow()  # FIT_ROWS texts at most
    found = {k: (y, x) for k, y, x in zip(*(rows[c].to_pylist() for c in ("key", "y", "x")), strict=True)}
    y = np.array([found[k][0] for k in sorted(found)], np.float64)
    if not len(y) or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.5}
    x = np.frombuffer(b"".join(found[k][1] for k in sorted(found)), np.float32).reshape(len(y), DIMENSIONS)
    return fit(x, y)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """`docs` with a column score, in the stead of one of that name; other columns pass through."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            blocks = [votes(sent.value, matrix(batch.iloc[at : at + BLOCK].tolist())) for at in range(0, len(batch), BLOCK)]
            yield pd.Series(np.concatenate(blocks) if blocks else np.empty(0))

    return docs.withColumn("score", F.pandas_udf(rate, "double")(F.col("text").cast("binary")))
