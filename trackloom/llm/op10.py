"""op10: all documents into 24 shards along a Hilbert curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import table, text_of
from trackloom.llm.hilbert import curve_order, cut_runs

SHARDS = 24


def shard_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Documents with hilbert_index, shard and slot, the texts replaced by size and crc32.

    Dimensions: language, source, size and doc_id, each in 64 levels of about equal shares. A null text has size 8 and the crc32 of
    an empty one. Documents of one cell are ordered by a hash of the text, so equal texts stay together,
    then by doc_id.
    """
    text = text_of()
    rows = docs.select("doc_id", "lang", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    ordered = curve_order(rows, ["lang", "source"], ["size", "doc_id"])
    return cut_runs(ordered, ["hilbert_index", "text_hash", "doc_id"], n_shards)


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert_index", "lang", "source"
    )
