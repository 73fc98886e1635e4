"""op13: for each benchmark item, the ten documents that match its terms best."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm.common import table
from trackloom.llm.lexical import search


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "item_id", 10)
    return found.withColumnRenamed("query_id", "item_id")


#: All but the logarithm is 64-bit integer arithmetic in both engines.
ORACLE = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
lengths as (select doc_id, count(*)::bigint as n from words group by all),
corpus as (select count(*)::bigint as docs, sum(n)::bigint as len from lengths),
tfs as (select doc_id, term, count(*)::bigint as tf from words group by all),
weights as (
  select term, floor(1000 * ln((2.0::double * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
  from tfs, corpus group by term),
asked as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // len))))::bigint as score
  from asked join weights using (term) join tfs using (term) join lengths using (doc_id), corpus
  group by all),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as r from scores where score > 0)
select item_id, r::int as "rank", doc_id, score from ranked where r <= 10
"""
