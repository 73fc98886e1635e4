"""op4: near-duplicate groups of documents by SimHash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import cut, table
from trackloom.llm.simhash import fingerprints, group


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = group(cut(fingerprints(table(spark, sf_dir, "documents"))))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
