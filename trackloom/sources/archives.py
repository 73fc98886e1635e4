"""Timetables of many versions at once: zips unpacked on the executors, published by rename, derived in one job, read as of a day."""

from __future__ import annotations

import io
import logging
import re
import uuid
import zipfile
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.session import ship
from trackloom.sources.files import folder, listed
from trackloom.sources.timetable import MEMBERS, backfill

#: A zip as a row; a version of a feed may come in several, by `part`.
ZIP = "static_version date, feed string, part int, content binary"
LINES = "v string, feed string, member string, part int, block int, value string"
#: The member of a zip that can't be published; its value says why.
BROKEN = "broken"
#: A version or feed without a usable name.
UNNAMED = "unnamed"
#: Characters of whole lines that a row holds.
BLOCK = 1 << 20
log = logging.getLogger(__name__)


def zip_files(spark: SparkSession, pattern: str) -> DataFrame:
    """ZIP rows of files named v=<date>/<feed>.zip or v=<date>/<feed>/<number>.zip, as a download leaves them."""
    rows, path = spark.read.format("binaryFile").load(pattern), F.col("path")
    part = lambda group: F.regexp_extract(path, r"/v=(\d{4}-\d{2}-\d{2})/([A-Za-z0-9_-]+)(?:/(\d+))?\.zip$", group)
    return rows.select(F.to_date(part(1)).alias("static_version"), part(2).alias("feed"), F.coalesce(F.nullif(part(3), F.lit("")).cast("int"), F.lit(0)).alias("part"), "content")


def _blocks(content: bytes) -> Iterator[tuple[str, int, str]]:
    """(member, block, lines) of a zip's wanted members, by base name alone; a member is never whole in memory."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        found = {i.filename.replace("\\", "/").rpartition("/")[2]: i for i in z.infolist() if not i.is_dir()}
        if missing := [m for m in MEMBERS if m not in found]:
            raise ValueError(f"the archive lacks {', '.join(missing)}")
        for member in MEMBERS:
            with z.open(found[member]) as lines:
                block = 0
                while some := lines.readlines(BLOCK):
                    yield member, block, b"".join(some).decode("utf-8", "replace").rstrip("\r\n")
                    block += 1


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["v", "feed", "member", "part", "block", "value"]
    for batch in batches:
        for v, feed, part, content in batch[["v", "feed", "part", "content"]].itertuples(index=False):
            try:
                if UNNAMED in (v, feed):
                    raise ValueError("a version needs a date and a feed a name")
                for member, block, value in _blocks(content):
                    yield pd.DataFrame([(v, feed, member, part, block, value)], columns=names)
            except Exception as e:  # a broken zip keeps its version from being published, not the others
                yield pd.DataFrame([(v, feed, BROKEN, part, 0, " ".join(f"{type(e).__name__}: {e}".split()))], columns=names)


def publish(spark: SparkSession, zips: DataFrame, base: str, derive: bool = True) -> list[str]:
    """SRC-11/12, SNK-09: the versions of `zips` (rows as ZIP) that `base` lacks, under v=<date>/<feed>/<member>/; returns their folders.

    One job unpacks them, a zip a task, as text, each part of a member in a file with its own header. A version appears by one
    rename, with all its members or not at all, and one that is there is never touched nor read. A zip that can't be read or
    lacks a member keeps back its version of its feed alone; an error tells of them after the others are published.
    Derived files that can't be made are logged and can be made later. Rows without version, feed or content are errors as well.
    """
    ship(spark)
    named = zips.select(F.col("static_version").cast("string").alias("v"), "feed", F.coalesce("part", F.lit(0)).alias("part"), "content")
    known = [re.search(r"/v=([^/]+/[^/]+)$", p)[1] for p in listed(spark, f"{base}/v=*/*")]
    fresh = named.where(~F.concat_ws("/", "v", "feed").isin(known)) if known else named
    fresh = fresh.withColumns({"feed": F.when(F.col("feed").rlike("^[A-Za-z0-9_-]+$"), F.col("feed")).otherwise(UNNAMED), "v": F.coalesce("v", F.lit(UNNAMED))})
    aside = f"{base}/_made-{uuid.uuid4().hex}"
    files, made = folder(spark, aside)
    try:
        # rows of a part are one task's already; the order by folder is what the writer asks for, and blocks keep theirs in it
        lines = fresh.mapInPandas(_unpack, LINES).sortWithinPartitions("v", "feed", "member", "part", "block")
        lines.select("v", "feed", "member", "part", "value").write.partitionBy("v", "feed", "member", "part").text(aside)
        broken = {p.rpartition("/")[0] for p in listed(spark, f"{aside}/v=*/feed=*/member={BROKEN}")}
        good = []
        for place in listed(spark, f"{aside}/v=*/feed=*"):
            if place in broken:
                continue
            for member in MEMBERS:
                _rename(spark, f"{place}/member={member}", f"{place}/{member}")
            good.append(place.replace("/feed=", "/"))
            _rename(spark, place, good[-1])
        if derive and good:
            try:
                backfill(spark, aside)
            except Exception:
                log.exception("derived files of %d timetables are missing", len(good))
        published = []
        for place in good:
            target = f"{base}/{'/'.join(place.split('/')[-2:])}"
            if files.exists(folder(spark, target)[1]):  # published by another meanwhile; some file systems would move this one into it
                continue
            files.mkdirs(folder(spark, target)[1].getParent())
            _rename(spark, place, target)
            published.append(target)
        if broken:
            why = spark.read.text([f"{p}/member={BROKEN}" for p in sorted(broken)], recursiveFileLookup=True).first()["value"]
            raise ValueError(f"not published: {', '.join(sorted(p.partition('/v=')[2] for p in broken))} ({why})")
        return published
    finally:
        files.delete(made, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, place = folder(spark, target)
    if not files.rename(folder(spark, source)[1], place):
        raise OSError(f"{target} can't be made")


def valid_on(spark: SparkSession, base: str, day: date) -> list[str]:
    """The folder of each feed's latest version up to a day, from folder names alone; none for a feed that begins later."""
    latest: dict[str, tuple[str, str]] = {}
    for place in listed(spark, f"{base}/v=*/*"):
        found = re.search(r"/v=(\d{4}-\d{2}-\d{2})/([^/]+)$", place)
        if found and found[1] <= str(day):
            latest[found[2]] = max(latest.get(found[2], ("", "")), (found[1], place))
    return sorted(place for _, place in latest.values())


def zipped(lines: DataFrame, headers: dict[str, dict[str, str]]) -> DataFrame:
    """The way back: lines (static_version, feed, part, member, line) as ZIP rows; `headers` holds each member's first line by feed.

    The lines of a part are brought together and written to its zip as they come, so a task holds one compressed part.
    """
    ship(lines.sparkSession)
    key = ["static_version", "feed", "part"]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = data = z = out = None

        def closed():
            out.close()
            z.close()
            return pd.DataFrame([(*at[:3], data.getvalue())], columns=[*key, "content"])

        for batch in batches:
            for now, some in batch.groupby([*key, "member"], sort=False):
                if at is not None and at[:3] != now[:3]:
                    yield closed()
                    at = None
                if at is None:
                    data = io.BytesIO()
                    z = zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED)
                elif at != now:
                    out.close()
                if at != now:
                    out = z.open(f"timetable/{now[3]}", "w", force_zip64=True)
                    out.write((headers[now[1]][now[3]] + "\n").encode())
                    at = now
                out.write("".join(f"{line}\n" for line in some["line"]).encode())
        if at is not None:
            yield closed()

    return lines.repartition(*key).sortWithinPartitions(*key, "member").mapInPandas(pack, ZIP)
