"""op11: every document's quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import neighbours
from trackloom.llm.common import table


def op11_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = neighbours.train(docs, table(spark, sf_dir, "labels"))
    scored = neighbours.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", neighbours.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
