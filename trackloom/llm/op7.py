"""op7: for each vector whose id is divisible by 100, the ten best of all others by inner product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm.common import table
from trackloom.llm.topk import top_k


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


#: Integer products are exact in both engines.
ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) r from s)
select query_id, r::int as "rank", vec_id, score from r where r <= 10
"""
