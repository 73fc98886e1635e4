"""Token counts as delta-maintained rollups.

Counts come as signed rows: +1 for a document counted, -1 for one taken back. A revision is the old count taken
back and the new one added, whatever changed: text, source, language or tokenizer version. Totals are sums of
sign and of sign times tokens, so batches add up in any order and no old row is read again.

A batch is committed under its id, as the sums by source, language and tokenizer version. Its files are written
to a folder of their own, which one rename then makes the batch: a rename that doesn't replace, so of two writers
of an id one wins, and a writer that breaks off leaves nothing that is read. Repeating a commit changes nothing.
Totals read the committed batches alone. compact() sums them up to a base that lists their ids, made by a rename too;
readers take the base of most batches and the batches beside it, and prune() removes what a base holds.

Nulls: a null text is empty, with no tokens; a null source or language is a group of its own. Repeated rows
count each. Empty batches are committed and add nothing. Groups whose counts cancel out have no row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import n_words, prepare

GROUP = ("source", "lang", "tokenizer_version")
BATCH = "source string, lang string, tokenizer_version string, documents bigint, tokens bigint"


def count_tokens(docs: DataFrame, versions: dict[str, str | None]) -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, tokens): a row for each document and version, texts read once.

    A version is the path of a tokenizer file, or None for words between ASCII white space.
    """
    prepare(docs.sparkSession)
    paths = {v: p for v, p in versions.items() if p is not None}
    words = [v for v, p in versions.items() if p is None]
    plain = docs.select("doc_id", "source", "lang", F.explode(F.array(*map(F.lit, words)).cast("array<string>")).alias("tokenizer_version"), n_words(F.col("text")).alias("tokens"))
    if not paths:
        return plain

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from trackloom.llm.op1 import tokenizer

        encoders = [(v, tokenizer(p)) for v, p in paths.items()]
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(3)]
            for version, encode in encoders:
                tokens = [len(encode(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * len(texts), pa.string()), pa.array(tokens, pa.int64())], names=["doc_id", "source", "lang", "tokenizer_version", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "source", "lang", "text").mapInArrow(count, f"doc_id {kind}, source string, lang string, tokenizer_version string, tokens bigint")
    return counted.union(plain) if words else counted


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*GROUP, "tokens", F.lit(1).alias("sign"))


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select(*GROUP, "tokens", F.lit(-1).alias("sign"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).union(inserts(new))


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _names(spark: SparkSession, store: str, kind: str) -> list[str]:
    """What `kind`=<name> folders the store has."""
    place = _path(spark, store)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = (x.getPath().getName() for x in files.listStatus(place) if x.isDirectory())
    return sorted(n.removeprefix(f"{kind}=") for n in found if n.startswith(f"{kind}="))


def _publish(spark: SparkSession, made: str, target: str) -> bool:
    """Renames a folder, as one step; False, and the folder is removed, if the target is there."""
    source, place = _path(spark, made), _path(spark, target)
    conf = spark._jsc.hadoopConfiguration()
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.getFileSystem(conf).getUri(), conf).rename(source, place, plain)
    except Exception:
        files = source.getFileSystem(conf)
        files.delete(source, True)
        if files.exists(place):
            return False
        raise
    return True


def _base(spark: SparkSession, store: str) -> tuple[str | None, set[str]]:
    """The base that holds the most batches, and their ids."""
    best: tuple[str | None, set[str]] = (None, set())
    for name in _names(spark, store, "base"):
        ids = {r["id"] for r in spark.read.schema("id string").parquet(f"{store}/base={name}/ids").collect()}  # a row for each batch
        if best[0] is None or len(ids) > len(best[1]):
            best = name, ids
    return best


def committed(spark: SparkSession, store: str) -> list[str]:
    """Ids of the committed batches."""
    return sorted({*_names(spark, store, "batch"), *_base(spark, store)[1]})


def commit(store: str, batch_id: str, signed: DataFrame) -> bool:
    """Commits a batch of signed rows; False if it was there. Rows are summed before the shuffle, so a hot source costs a row a task."""
    if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, '-', '_' and '.' only")
    spark = signed.sparkSession
    if batch_id in committed(spark, store):
        return False
    made = f"{store}/_made-{uuid.uuid4().hex}"
    sums = signed.groupBy(*GROUP).agg(F.sum("sign").cast("bigint").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).cast("bigint").alias("tokens"))
    sums.write.parquet(made)
    return _publish(spark, made, f"{store}/batch={batch_id}")


def _rows(spark: SparkSession, store: str) -> tuple[DataFrame, set[str]]:
    """The sums of all committed batches, and their ids."""
    base, ids = _base(spark, store)
    batches = {*_names(spark, store, "batch")} - ids
    paths = [f"{store}/batch={b}" for b in sorted(batches)] + ([f"{store}/base={base}/sums"] if base else [])
    return (spark.read.schema(BATCH).parquet(*paths) if paths else spark.createDataFrame([], BATCH)), ids | batches


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 or tokens <> 0")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer version over all committed batches."""
    return _summed(_rows(spark, store)[0])


def compact(spark: SparkSession, store: str) -> None:
    """Sums the committed batches up to a base, so that later totals read one table and the batches since."""
    rows, ids = _rows(spark, store)
    made = f"{store}/_made-{uuid.uuid4().hex}"
    _summed(rows).write.parquet(f"{made}/sums")
    spark.createDataFrame([(i,) for i in sorted(ids)], "id string").coalesce(1).write.parquet(f"{made}/ids")
    _publish(spark, made, f"{store}/base={uuid.uuid4().hex}")


def prune(spark: SparkSession, store: str) -> None:
    """Removes the batches that the best base holds, and lesser bases; for a time when no reader is under way."""
    base, ids = _base(spark, store)
    place = _path(spark, store)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [f"batch={b}" for b in _names(spark, store, "batch") if b in ids] + [f"base={b}" for b in _names(spark, store, "base") if b != base]
    for name in gone:
        files.delete(_path(spark, f"{store}/{name}"), True)
