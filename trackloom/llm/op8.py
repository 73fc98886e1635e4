"""op8: every document's toxicity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import toxicity
from trackloom.llm.common import table


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
