"""op2: fingerprints of every document and of its text with the end replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import table, text_of
from trackloom.llm.fingerprint import containment, distinct_shingles, encode, merge, neighbours, resemblance, sketch


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the contract's columns: the estimated numbers of distinct shingles, of the text and of it with the next, and the share of its shingles that the next has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    seated, ring = neighbours(docs, "doc_id", F.xxhash64("text"))
    read = seated.withColumn("next", F.lead("text").over(ring)).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    own = read.select("doc_id", "n_chars", "_block", "_guest", "_tie", F.when(~F.col("_guest"), edited).alias("edited"), sketch(F.col("text")).alias("sketch"))
    both = own.withColumn("next_sketch", F.lead("sketch").over(ring)).where(~F.col("_guest"))
    made = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch", sketch(F.col("edited")).alias("edited_sketch"))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", encode(F.col("sketch")).alias("fingerprint"), encode(F.col("edited_sketch")).alias("edited_fingerprint"), resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("shingles"), containment(F.col("sketch"), F.col("next_sketch")).alias("within_next"), distinct_shingles(merge(F.col("sketch"), F.col("next_sketch"))).alias("shingles_of_both"),
    )
