"""Captured frames of feeds as a data source, for batches and for streams.

A capture is a folder of files that collectors append to, one JSON object a line:
feed, received_ms and frame (the text as it came). Spark's own file sources take a
file as finished when they see it; this one follows growing files: an offset is
how many bytes of each file are taken, always up to a line break, so a line that
is still being written waits for the next batch. Files are listed by the driver
and read by tasks, in ranges of bytes, from any file system that Arrow reaches.

A frame gives ticks, or a fault, or nothing (keep-alives, acknowledgements,
frames of other channels). What is a fault: a line that is no capture line, a
feed that is not known, text that is no JSON, and JSON of a shape that the feed's
frames never have. A frame with a fault gives no ticks at all.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.functions.columns import iso_ms, let, parse_whole
from tidemark.streaming.frames import BY_NAME, FEEDS, TICK, FrameFeed, value_of

SCHEMA = "feed string, received_ms long, frame string, shape string, file string, at long"
#: Bytes of a file that one task reads, lines of one Arrow batch, bytes of the tail that is searched for a line break at a time.
SPLIT, LINES, TAIL = 64 << 20, 4096, 1 << 16


@dataclass
class Stretch(InputPartition):
    """Lines of a file that begin in [start, end)."""

    path: str
    start: int
    end: int


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _sizes(path: str) -> dict[str, int]:
    system, root = _at(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True))
    return {f.base_name: f.size for f in sorted(found, key=lambda f: f.base_name) if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))}


def _whole(path: str, name: str, known: int, size: int) -> int:
    """Up to where a file has whole lines: behind its last line break, looked for from the end."""
    system, root = _at(path)
    with system.open_input_file(f"{root}/{name}") as f:
        end = size
        while end > known:
            start = max(known, end - TAIL)
            found = f.read_at(end - start, start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            end = start
    return known


def _split(path: str, name: str, start: int, end: int) -> list[Stretch]:
    return [Stretch(f"{path}/{name}", a, min(a + SPLIT, end)) for a in range(start, end, SPLIT)]


def _lines(part: Stretch) -> Iterator[tuple[int, bytes]]:
    """Lines that begin in the stretch; the last one may end behind it."""
    system, path = _at(part.path)
    with io.BufferedReader(system.open_input_file(path), 1 << 20) as f:
        at = max(part.start - 1, 0)
        f.seek(at)
        if part.start > 0:
            at += len(f.readline())
        while at < part.end:
            line = f.readline()
            if not line:
                return
            yield at, line.rstrip(b"\r\n")
            at += len(line)


def _told(line: bytes) -> tuple:
    """feed, received_ms, frame and the shape of its JSON (object, array, other, or null if it is none); a line that is no capture line has no feed."""
    try:
        said = json.loads(line)
        feed, received, frame = said["feed"], said["received_ms"], said["frame"]
        if not (isinstance(feed, str) and isinstance(received, int) and isinstance(frame, str)):
            raise TypeError
    except (ValueError, KeyError, TypeError):
        return None, None, line.decode("utf-8", "replace"), None
    try:
        found = json.loads(frame)
        shape = "object" if isinstance(found, dict) else "array" if isinstance(found, list) else "other"
    except ValueError:
        shape = None
    return feed, received, frame, shape


def _read(part: Stretch) -> Iterator[pa.RecordBatch]:
    name, rows = part.path.rsplit("/", 1)[-1], []

    def batch() -> pa.RecordBatch:
        feed, received, frame, shape, at = zip(*rows)
        made = [pa.array(feed, pa.string()), pa.array(received, pa.int64()), pa.array(frame, pa.string()), pa.array(shape, pa.string()), pa.array([name] * len(rows), pa.string()), pa.array(at, pa.int64())]
        return pa.RecordBatch.from_arrays(made, names=["feed", "received_ms", "frame", "shape", "file", "at"])

    for at, line in _lines(part):
        if line:
            rows.append((*_told(line), at))
        if len(rows) >= LINES:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


class _Batch(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Stretch]:
        return [s for name, size in _sizes(self.path).items() for s in _split(self.path, name, 0, size)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path, self.known = path, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for name, size in _sizes(self.path).items():
            if size > self.known.get(name, 0):
                self.known[name] = _whole(self.path, name, self.known.get(name, 0), size)
        return {name: at for name, at in self.known.items() if at}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return [s for name, to in end.items() for s in _split(self.path, name, start.get(name, 0), to)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        """Offsets are kept by Spark's checkpoint; there is nothing to let go."""


class FrameCapture(DataSource):
    """format("frame_capture"), option path: the folder."""

    @classmethod
    def name(cls) -> str:
        return "frame_capture"

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("frame_capture needs the option path")
        return self.options["path"].removeprefix("file:").rstrip("/")

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self._path())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self._path())


def captured(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    spark.dataSource.register(FrameCapture)
    return (spark.readStream if stream else spark.read).format("frame_capture").option("path", path).load()


def _texts(feed: FrameFeed) -> Column:
    """A feed's rows as JSON texts: an array's elements, or the one object."""
    text = F.get_json_object("frame", feed.rows)
    return F.when(text.startswith("["), F.from_json(text, "array<string>")).when(text.startswith("{"), F.array(text))


def _meant(feed: FrameFeed) -> Column:
    """Whether a frame is of the feed's channel."""
    ok = F.col("shape") == ("array" if feed.listed and feed.rows == "$" else "object")
    for path, want in feed.tests.items():
        found = F.get_json_object("frame", path)
        ok = ok & (found.startswith(want[:-1]) if want.endswith("*") else found == want)
    return F.coalesce(ok, F.lit(False))


def _fault(feed: FrameFeed) -> Column:
    text = F.get_json_object("frame", feed.rows)
    odd = F.exists(_texts(feed), lambda row: ~row.startswith("{")) if feed.listed else F.lit(False)
    out = F.when(F.col("frame").isin(*feed.silent), F.lit(None)) if feed.silent else F.when(F.lit(False), F.lit(None))
    out = out.when(F.col("shape").isNull(), "not_json")
    if not (feed.listed and feed.rows == "$"):  # all but the feed whose frames are arrays look into an object
        out = out.when(F.col("shape") != "object", "not_an_object")
    if feed.holder:  # what holds the rows must be an object if it is there
        held = F.get_json_object("frame", feed.holder)
        out = out.when(_meant(feed) & held.isNotNull() & ~held.startswith("{"), "holder_not_an_object")
    if feed.iterated:  # rows are gone through whatever they are
        out = out.when(_meant(feed) & text.isNotNull() & ~text.startswith("["), "rows_not_a_list")
    return out.when(_meant(feed) & F.coalesce(odd, F.lit(False)), "row_not_an_object")


def faults(frames: DataFrame) -> DataFrame:
    """Captured frames that are faulty, and why."""
    return _judged(frames).filter("fault is not null").select("feed", "received_ms", "file", "at", "fault", "frame")


def _judged(frames: DataFrame) -> DataFrame:
    known = F.when(F.col("feed").isNull(), "no_capture_line").when(~F.col("feed").isin(*BY_NAME), "unknown_feed")
    for feed in FEEDS:
        known = known.when(F.col("feed") == feed.name, _fault(feed))
    return frames.withColumn("fault", known)


def _tick(feed: FrameFeed):
    """What a row of a feed (JSON text) becomes."""
    event = None if feed.event is None or feed.event_in_row else F.get_json_object("frame", feed.event)

    def made(row: Column) -> Column:
        at = F.element_at(row, feed.event) if event is None else event
        told = [value_of(feed, name, row).alias(name) for name in TICK]
        return F.struct(F.lit(feed.venue).alias("venue"), F.lit(feed.kind).alias("kind"), F.element_at(row, feed.symbol).alias("symbol"), (iso_ms(at) if feed.event_iso else parse_whole(at)).alias("event_ms"), *told)

    return lambda text: let(F.from_json(text, "map<string,string>"), made)  # else the text is parsed for each value


def ticks(frames: DataFrame) -> DataFrame:
    """Ticks of all feeds in one pass over captured frames: feed, venue, kind, symbol, received_ms, event_ms and all values."""
    rows = F.lit(None)
    for feed in FEEDS:
        rows = F.when((F.col("feed") == feed.name) & _meant(feed), F.transform(_texts(feed), _tick(feed))).otherwise(rows)
    sound = _judged(frames).filter("fault is null")
    return sound.select("feed", "received_ms", F.explode(rows).alias("tick")).select("feed", "received_ms", "tick.*").filter("symbol is not null")


def replies(frames: DataFrame) -> DataFrame:
    """What must be sent back: answers to heartbeats of feeds that ask for them. feed, received_ms, reply."""
    asked = _judged(frames).filter("fault is null and feed = 'cryptocom'").filter(F.get_json_object("frame", "$.method") == "public/heartbeat")
    reply = F.concat(F.lit('{"id": '), F.coalesce(F.get_json_object("frame", "$.id"), F.lit("null")), F.lit(', "method": "public/respond-heartbeat"}'))
    return asked.select("feed", "received_ms", reply.alias("reply"))
