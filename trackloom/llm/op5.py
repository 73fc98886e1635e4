"""op5: tokens of all documents by source, language and tokenizer version, from committed batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import rollup
from trackloom.llm.common import beside, cut, shared_dir, table


def tokenizers() -> dict[str, str]:
    """Two tokenizer versions by their files."""
    import public_tokenizers

    return {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.json"), "byte_bpe_multi_50k": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}


def maintain(docs: DataFrame, labels: DataFrame, store: str, versions: dict[str, str | None]) -> list[bool]:
    """A store's history: all documents, those of low quality withdrawn, texts with repeated lines revised to each line once. Tells which commits were new.

    The withdrawal comes twice, as after a lost answer; the second changes nothing. A null doc_id is never withdrawn.
    """
    spark = docs.sparkSession
    counted = cut(rollup.count_tokens(docs, versions))
    low = beside(cut(labels.where("quality = 0 and doc_id is not null").select("doc_id").distinct()))
    withdrawn = counted.join(low, "doc_id", "left_semi")
    new = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    # few texts change, so only these are counted again, before and after
    changed = docs.select("doc_id", "source", "lang", "text", new.alias("new")).where("text <> new").join(low, "doc_id", "left_anti")
    after = changed.select("doc_id", "source", "lang", F.col("new").alias("text"))
    done = [rollup.commit(store, "load", rollup.inserts(counted))]
    done += [rollup.commit(store, "withdraw", rollup.deletes(withdrawn)) for _ in range(2)]
    done.append(rollup.commit(store, "revise", rollup.revisions(rollup.count_tokens(changed, versions), rollup.count_tokens(after, versions))))
    rollup.compact(spark, store)
    return done


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}"
    maintain(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), store, tokenizers())
    return rollup.totals(spark, store)
