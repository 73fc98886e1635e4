"""op12: a Merkle manifest of all documents, by source, with a proof for each and a check of altered ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import table
from trackloom.llm.merkle import fold, leaf_of, manifest, siblings_digest

VALUES = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*VALUES)
    altered = leaf_of(*(F.col(c) for c in VALUES[:-1]), F.translate("text", "\n", ""))
    touched = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, altered)
    proven = manifest(docs, "source", ["doc_id"], VALUES, {"touched": touched})
    folded = proven.withColumn("folded_root", fold(F.coalesce("touched", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", siblings_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: The trees by recursion, level by level; crc32 bit by bit. doc_id is unique in the tables this is for.
ORACLE = r"""
with recursive docs as (
  select *, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::bigint)), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))) & 1 as last_bit
  from documents),
parts as (
  select doc_id, source, text, last_bit,
    concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head
  from docs),
leaves as (
  select doc_id, coalesce('1' || source, '0') as grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) as altered, last_bit = 0 as kept,
    row_number() over (partition by source order by doc_id nulls first) - 1 as idx, count(*) over (partition by source) as n
  from parts),
nodes as (
  select 0 as level, grp, idx, leaf as digest, n as width from leaves
  union all
  select level + 1, grp, idx // 3, sha256(string_agg(digest, '' order by idx)), (width + 2) // 3 from nodes where width > 1 group by level, grp, idx // 3, width),
subroots as (select grp, level as height, digest as subroot, row_number() over (order by grp) - 1 as place, count(*) over () as n from nodes where width = 1),
tops as (
  select 0 as level, place as idx, subroot as digest, n as width from subroots
  union all
  select level + 1, idx // 3, sha256(string_agg(digest, '' order by idx)), (width + 2) // 3 from tops where width > 1 group by level, idx // 3, width),
steps as (
  select l.doc_id, s.level, string_agg(case when s.idx < l.idx // (3 ** s.level)::bigint then s.digest end, '' order by s.idx) as before, string_agg(case when s.idx > l.idx // (3 ** s.level)::bigint then s.digest end, '' order by s.idx) as after
  from leaves l join nodes s on s.grp = l.grp and s.width > 1 and s.idx // 3 = l.idx // (3 ** (s.level + 1))::bigint group by all
  union all
  select l.doc_id, r.height + t.level, string_agg(case when t.idx < r.place // (3 ** t.level)::bigint then t.digest end, '' order by t.idx), string_agg(case when t.idx > r.place // (3 ** t.level)::bigint then t.digest end, '' order by t.idx)
  from leaves l join subroots r using (grp) join tops t on t.width > 1 and t.idx // 3 = r.place // (3 ** (t.level + 1))::bigint group by all),
proofs as (select doc_id, list(coalesce(before, '') || '|' || coalesce(after, '') order by level) as proof from steps group by doc_id),
folded as (
  select l.doc_id, leaf, subroot, (select digest from tops where width = 1) as root, sha256(replace(array_to_string(coalesce(proof, []), ''), '|', '')) as proof_sha256,
    list_reduce(list_prepend(case when kept then leaf else altered end, coalesce(proof, [])), lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2))) as folded_root
  from leaves l join subroots using (grp) left join proofs using (doc_id))
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from folded
"""
