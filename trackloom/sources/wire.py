"""Realtime snapshots written in the feed's wire format, and recorded ones decoded, both partition by partition.

A snapshot is a header and an entity for each trip. Entities are encoded from Arrow batches and put together by the
aggregate that groups a snapshot, so the largest value is a snapshot, as on the wire. Fields that are null aren't written:
absent and 0 stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.session import ship
from trackloom.sources import feed

SNAPSHOT = ("snapshot_timestamp", "fetched_at")
TRIP = ("trip_id", "start_date", "route_id", "trip_schedule_relationship", "is_trip_level_only")
STOP = ("stop_sequence", "stop_id", "arrival_delay", "arrival_time", "departure_delay", "departure_time", "schedule_relationship")
_trip_code = {name: code for code, name in feed.TRIP_RELATIONSHIPS.items()}
_stop_code = {name: code for code, name in feed.STOP_RELATIONSHIPS.items()}


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def number(field: int, value: int | None) -> bytes:
    """A field of wire type 0; null: nothing."""
    return b"" if value is None else varint(field << 3) + varint(value)


def nested(field: int, value: bytes | str | None) -> bytes:
    """A field of wire type 2; null: nothing."""
    data = value.encode() if isinstance(value, str) else value
    return b"" if data is None else varint(field << 3 | 2) + varint(len(data)) + data


def stop_update(stop: dict) -> bytes:
    def event(kind: str) -> bytes | None:
        delay, moment = stop[f"{kind}_delay"], stop[f"{kind}_time"]
        return None if delay is None and moment is None else number(feed.EVENT_DELAY, delay) + number(feed.EVENT_TIME, moment)

    relation = _stop_code.get(stop["schedule_relationship"])
    return number(feed.STOP_SEQUENCE, stop["stop_sequence"]) + nested(feed.ARRIVAL, event("arrival")) + nested(feed.DEPARTURE, event("departure")) + nested(feed.STOP_ID, stop["stop_id"]) + number(feed.STOP_RELATIONSHIP, relation or None)


def entity(identifier: str, trip: dict, stops: list[dict], unknown: bytes = b"") -> bytes:
    """A trip update as an entity of a snapshot; `unknown` is put between its fields, as later schemas may."""
    head = nested(feed.TRIP_ID, trip["trip_id"]) + unknown + nested(feed.START_DATE, trip["start_date"]) + number(feed.TRIP_RELATIONSHIP, _trip_code[trip["trip_schedule_relationship"]] or None) + nested(feed.ROUTE_ID, trip["route_id"])
    update = nested(feed.UPDATE_TRIP, head) + b"".join(nested(feed.UPDATE_STOP, stop_update(s)) for s in stops) + unknown
    return nested(feed.ENTITY, nested(1, identifier) + unknown + nested(feed.TRIP_UPDATE, update))


def header(snapshot_timestamp: int) -> bytes:
    return nested(feed.HEADER, nested(1, "2.0") + number(feed.HEADER_TIMESTAMP, snapshot_timestamp))


def snapshots(rows: DataFrame, unknown: bytes = b"", header_last=None) -> DataFrame:
    """(snapshot_timestamp, fetched_at, content) of raw rows, one for each snapshot and fetch.

    Rows of one trip become one entity; of rows about a trip alone, one is enough. `header_last` is a condition
    on a snapshot: its header stands behind the entities, as the format allows.
    """
    ship(rows.sparkSession)
    stops = F.collect_list(F.when(~F.col("is_trip_level_only"), F.struct(*STOP)))
    trips = rows.groupBy(*SNAPSHOT, *TRIP).agg(F.sort_array(stops).alias("stops"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [entity(f"e{n}", r, r["stops"], unknown) for n, r in enumerate(batch.to_pylist())]
            heads = [header(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, pa.binary()), pa.array(made, pa.binary())], names=["snapshot_timestamp", "fetched_at", "head", "entity"])

    encoded = trips.select(*SNAPSHOT, *TRIP, "stops").mapInArrow(encode, "snapshot_timestamp bigint, fetched_at bigint, head binary, entity binary")
    body = F.expr("listagg(entity) within group (order by entity)")  # put together at once: appended one by one, a snapshot would be copied for each entity
    whole = encoded.groupBy(*SNAPSHOT).agg(F.first("head").alias("head"), body.alias("body"))
    last = F.lit(False) if header_last is None else header_last
    return whole.select(*SNAPSHOT, F.when(last, F.concat("body", "head")).otherwise(F.concat("head", "body")).alias("content"))


def decoded(recorded: DataFrame, scope: frozenset[str] | None = None) -> DataFrame:
    """SRC-02..04: RAW rows, without a generation, of recorded snapshots (fetched_at, content), decoded where they lie."""
    ship(recorded.sparkSession)
    schema = feed.RAW_SCHEMA.removesuffix(", generation bigint")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]] for c in schema.split(", ")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fetched, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                columns = list(zip(*feed.decode(content, fetched, 0, scope).rows, strict=True)) or [()] * (len(names) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names)

    return recorded.select("fetched_at", "content").mapInArrow(decode, schema)
