"""Realtime feed: protobuf snapshots decoded entity by entity, and a Spark data source that polls them.

Only the fields needed are read, in one pass over the wire format; a nationwide snapshot of 40 MB is never
held as objects. The stream source numbers successful polls; that number, not the clock, is its offset and
the generation for change detection.
"""

from __future__ import annotations

import gzip
import logging
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass, fields
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

log = logging.getLogger(__name__)

#: Field numbers and enumerations of the public GTFS-Realtime schema.
HEADER, ENTITY, HEADER_TIMESTAMP, TRIP_UPDATE = 1, 2, 3, 3
UPDATE_TRIP, UPDATE_STOP = 1, 2
TRIP_ID, START_DATE, TRIP_RELATIONSHIP, ROUTE_ID = 1, 3, 4, 5
STOP_SEQUENCE, ARRIVAL, DEPARTURE, STOP_ID, STOP_RELATIONSHIP = 1, 2, 3, 4, 5
EVENT_DELAY, EVENT_TIME = 1, 2
TRIP_RELATIONSHIPS = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"}
STOP_RELATIONSHIPS = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}

RAW_SCHEMA = (
    "trip_id string, start_date string, route_id string, trip_schedule_relationship string, stop_sequence bigint, stop_id string, arrival_delay int, arrival_time bigint, "
    "departure_delay int, departure_time bigint, schedule_relationship string, is_trip_level_only boolean, snapshot_timestamp bigint, fetched_at bigint, generation bigint"
)


@dataclass
class StopReport:
    """One update of a stop, or of a trip without stops. None is a field that wasn't delivered; 0 is on time."""

    trip_id: str = ""
    start_date: str = ""
    route_id: str = ""
    trip_schedule_relationship: str = "SCHEDULED"
    stop_sequence: int | None = None
    stop_id: str = ""
    arrival_delay: int | None = None
    arrival_time: int | None = None
    departure_delay: int | None = None
    departure_time: int | None = None
    schedule_relationship: str = ""
    is_trip_level_only: bool = False


class DecodeError(ValueError):
    pass


def wire_fields(data: memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(number, value) of each field of a message: an int, or the bytes of a nested one."""
    at, end = 0, len(data)

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            if at >= end or shift > 63:
                raise DecodeError("a number runs over the message's end")
            b = data[at]
            value |= (b & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if b < 0x80:
                return value, at

    while at < end:
        tag, at = varint(at)
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            value, at = varint(at)
            yield number, value
            continue
        if kind == 2:
            size, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
        else:
            raise DecodeError(f"wire type {kind}")
        if at + size > end:
            raise DecodeError("a field runs over the message's end")
        if kind == 2:
            yield number, data[at : at + size]
        at += size


def _signed(value: int, bits: int) -> int:
    value &= (1 << 64) - 1
    value = value - (1 << 64) if value >> 63 else value
    return ((value + (1 << (bits - 1))) % (1 << bits)) - (1 << (bits - 1))


def _text(value) -> str:
    return bytes(value).decode("utf-8", "replace")


def _event(data: memoryview) -> tuple[int | None, int | None]:
    delay = moment = None
    for n, v in wire_fields(data):
        if n == EVENT_DELAY:
            delay = _signed(v, 32)
        elif n == EVENT_TIME:
            moment = _signed(v, 64)
    return delay, moment


def trip_reports(update: memoryview) -> list[StopReport]:
    """SRC-04: a report for each stop of a trip update; one of the trip alone where it has none."""
    trip, stops = StopReport(), []
    for n, v in wire_fields(update):
        if n == UPDATE_TRIP:
            for m, w in wire_fields(v):
                if m == TRIP_ID:
                    trip.trip_id = _text(w)
                elif m == START_DATE:
                    trip.start_date = _text(w)
                elif m == ROUTE_ID:
                    trip.route_id = _text(w)
                elif m == TRIP_RELATIONSHIP:
                    trip.trip_schedule_relationship = TRIP_RELATIONSHIPS.get(w, str(w))
        elif n == UPDATE_STOP:
            stops.append(v)
    head = (trip.trip_id, trip.start_date, trip.route_id, trip.trip_schedule_relationship)
    if not stops:
        return [StopReport(*head, is_trip_level_only=True)]
    out = []
    for stop in stops:
        r = StopReport(*head, schedule_relationship="SCHEDULED")
        for n, v in wire_fields(stop):
            if n == STOP_SEQUENCE:
                r.stop_sequence = v & 0xFFFFFFFF
            elif n == STOP_ID:
                r.stop_id = _text(v)
            elif n == ARRIVAL:
                r.arrival_delay, r.arrival_time = _event(v)
            elif n == DEPARTURE:
                r.departure_delay, r.departure_time = _event(v)
            elif n == STOP_RELATIONSHIP:
                r.schedule_relationship = STOP_RELATIONSHIPS.get(v, str(v))
        out.append(r)
    return out


def snapshot_timestamp(raw: bytes) -> int:
    """SRC-03: the header's timestamp, wherever the header stands; 0 if it has none."""
    for n, v in wire_fields(memoryview(raw)):
        if n == HEADER:
            return next((w for m, w in wire_fields(v) if m == HEADER_TIMESTAMP), 0)
    raise DecodeError("no header")


def walk(raw: bytes) -> Iterator[list[StopReport]]:
    """SRC-02: the reports of each trip of a snapshot; vehicle positions and alerts are passed over."""
    for n, v in wire_fields(memoryview(raw)):
        if n == ENTITY:
            for m, w in wire_fields(v):
                if m == TRIP_UPDATE:
                    yield trip_reports(w)


def fetch_http(url: str, attempts: int = 3, timeout: float = 25.0, wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """SRC-01: a GET with retries after 2 and 4 seconds; any status but 200 is an error."""
    for attempt in range(attempts):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as answer:
                if answer.status != 200:
                    raise OSError(f"status {answer.status}")
                return answer.read()
        except OSError:
            if attempt + 1 == attempts:
                raise
            sleep(wait * 2**attempt)
    raise AssertionError


@dataclass
class Poll:
    """What a poll brought: its rows, as of RAW_SCHEMA, and what a heartbeat tells of it."""

    rows: list[tuple]
    feed_timestamp: int = 0
    entity_count: int = 0
    in_scope_count: int = 0


def decode(raw: bytes, fetched_at: int, generation: int, scope: frozenset[str] | None = None) -> Poll:
    """A snapshot's rows. With a scope, trips that call at none of its stops are left out, but for those that name no stop."""
    out = Poll([], snapshot_timestamp(raw))
    for trip in walk(raw):
        out.entity_count += 1
        named = {r.stop_id for r in trip if r.stop_id}
        if scope is None or not named or named & scope:
            out.in_scope_count += 1
            out.rows += [(*astuple(r), out.feed_timestamp, fetched_at, generation) for r in trip]
    return out


def snapshot_rows(raw: bytes, fetched_at: int, generation: int, scope: frozenset[str] | None = None) -> Iterator[tuple]:
    return iter(decode(raw, fetched_at, generation, scope).rows)


def _replayed(folder: str) -> list[Path]:
    return sorted(p for p in Path(folder).iterdir() if p.suffix in (".pb", ".gz"))


def _load(path: Path) -> tuple[bytes, int]:
    raw = gzip.decompress(path.read_bytes()) if path.suffix == ".gz" else path.read_bytes()
    stem = path.name.split(".")[0]
    return raw, int(stem) if stem.isdigit() else int(path.stat().st_mtime)


class FeedSource(DataSource):
    """`spark.readStream.format("gtfs_feed")`: option `url` polls over HTTP, option `path` replays files `<epoch seconds>.pb`; `scope` is a comma-joined list of stops."""

    @classmethod
    def name(cls) -> str:
        return "gtfs_feed"

    def schema(self) -> str:
        return RAW_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ReplayReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return PollReader(self.options)


def _scope(options: dict) -> frozenset[str] | None:
    return frozenset(options["scope"].split(",")) if options.get("scope") else None


class ReplayReader(DataSourceReader):
    """A batch over recorded snapshots, a partition each."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((i, str(p))) for i, p in enumerate(_replayed(self.options["path"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        i, path = partition.value
        raw, fetched = _load(Path(path))
        yield from snapshot_rows(raw, fetched, i, _scope(self.options))


class PollReader(SimpleDataSourceStreamReader):
    """One poll a micro-batch. A failed or undecodable poll yields no rows and doesn't advance the generation.

    The offset carries what the poll found, or its error, so that whoever follows the query's progress learns of it,
    and a failed poll makes a batch of its own, without rows.
    """

    def __init__(self, options: dict):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"generation": 0, "file": 0}

    def _poll(self, start: dict) -> tuple[bytes, int, int] | None:
        if url := self.options.get("url"):
            return fetch_http(url), int(time.time()), start["file"]
        files = _replayed(self.options["path"])
        if start["file"] >= len(files):
            return None
        raw, fetched = _load(files[start["file"]])
        return raw, fetched, start["file"] + 1

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        moved = start["file"] + ("path" in self.options)
        try:
            polled = self._poll(start)
            if polled is None:
                return iter(()), start
            raw, fetched, at = polled
            found = decode(raw, fetched, start["generation"], _scope(self.options))
        except Exception as e:  # one bad poll never ends the stream
            log.warning("poll failed: %s", e)
            return iter(()), {"generation": start["generation"], "file": moved, "polled_at": int(time.time()), "error": str(e) or type(e).__name__}
        told = {"polled_at": fetched, "feed_timestamp": found.feed_timestamp, "entity_count": found.entity_count, "in_scope_count": found.in_scope_count}
        return iter(found.rows), {"generation": start["generation"] + 1, "file": at, **told}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        if "url" in self.options:
            return iter(())  # a past answer can't be fetched again; its batch was committed or is lost with it
        rows: list[tuple] = []
        at = start
        while at["file"] < end["file"]:
            more, at = self.read(at)
            rows.extend(more)
        return iter(rows)


COLUMNS = tuple(f.name for f in fields(StopReport))
