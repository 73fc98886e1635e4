"""op9: a mix of all documents by the weights of their sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import cut, n_words, table
from trackloom.llm.mixing import mix


def doc_key():
    """A hash of a document's row: equal for repeated rows alone."""
    return F.xxhash64("doc_id", "source", "text")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's shards, one for each time it is taken, and its seeded places in their local order."""
    rows = cut(table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"), doc_key().alias("doc_key")))
    return mix(rows, rows.select("source", "doc_key", "size")).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.size("draws") * F.col("size")).cast("long").alias("taken"), "source", F.transform("draws", lambda d: d["shard"]).alias("shards"), F.transform("draws", lambda d: d["order"]).alias("orders")
    )
