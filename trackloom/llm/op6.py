"""op6: personal data in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import table
from trackloom.llm.pii import KINDS, listed, with_spans


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
