"""op1: all documents as token ids packed into sequences."""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.common import cut, prepare, table
from trackloom.llm.packing import CAPACITY, pack

END_ID = 2
#: Texts of these characters alone, without the special token's string, have the same ids in both libraries.
_plain = re.compile(r"[^\x00-ɏ‐-‧€]")
_special = "<|endoftext|>"


@cache
def tokenizer(path: str):
    """text -> ids of the tokenizer or rank file at `path`; a tokenizer file's by the faster reader of the same vocabulary where one lies beside it."""
    ranks = Path(path).with_suffix(".tiktoken")
    if ranks.exists():
        import public_tokenizers
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.read_bytes().splitlines())}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        if ranks == Path(path):
            return fast
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    slow = lambda t: exact.encode(t, add_special_tokens=False).ids
    return (lambda t: slow(t) if _special in t or _plain.search(t) else fast(t)) if ranks.exists() else slow


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32. A document of more ids than `capacity` is cut into full pieces, the first taking what is left over."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ("piece", "start", "length", "ids_crc32")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in batches:
            rows, row_of = [], []
            for k, text in enumerate(batch.column(1)):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(END_ID)
                start, end = 0, len(ids) % capacity or capacity
                piece = 0
                while start < len(ids):
                    rows.append((piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    row_of.append(k)
                    piece, start, end = piece + 1, end, end + capacity
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row_of, pa.int64())), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(cut_up, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """pieces() with sequence_id and offset.

    Full pieces are sequences of their own; the others are packed. A null text is empty: its end id alone.
    Repeated rows are packed each for itself. A null doc_id stays null.
    """
    found = cut(pieces(docs, path or default_tokenizer(), capacity)).withColumn("uid", F.monotonically_increasing_id())
    full = found.where(F.col("length") == capacity).select("*", F.col("uid").bitwiseOR(F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = found.where(F.col("length") < capacity)
    packed = rest.join(pack(rest.select("uid", "length"), capacity), "uid")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(columns).union(packed.select(columns))


def op1_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
