"""The packed binary form of observations: 16 bytes each, little-endian: key, then dt and cc as sign and millionths.

Where event or station numbers have no room in the key, the bits above it (``merge.split_numbers``) stand in a record of their
own just before: bit 63 of the key is set and tells it from others, the bits below are the events', dt holds the station's, cc
is 0. Where all have room the form has no such records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RECORD = np.dtype([("key", "<u8"), ("dt", "<u4"), ("cc", "<u4")])
SIGN = np.uint32(1 << 31)
OVER = np.uint64(1 << 63)
#: Records read at a time.
STEP = 1 << 16


def _stored(x: np.ndarray) -> np.ndarray:
    wide = x.astype(np.int64)
    return np.abs(wide).astype(np.uint32) | np.where(wide < 0, SIGN, np.uint32(0))


def _read(x: np.ndarray) -> np.ndarray:
    size = (x & ~SIGN).astype(np.int32)
    return np.where(x & SIGN, -size, size)


def pack(observations: DataFrame) -> DataFrame:
    """content: the records of ``observations`` (key, dt_u6, cc_u6), one binary value per Arrow batch; concatenated in any
    order they make a file of the form. A null in any of the three is an error; an empty input gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(batch.column(c).null_count for c in ("key", "dt_u6", "cc_u6")):
                raise ValueError("an observation without key, dt or cc")
            out = np.empty(batch.num_rows, RECORD)
            out["key"] = batch.column("key").to_numpy().astype(np.uint64)
            out["dt"], out["cc"] = (_stored(batch.column(c).to_numpy()) for c in ("dt_u6", "cc_u6"))
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["content"])

    return observations.select("key", "dt_u6", "cc_u6").mapInArrow(run, "content binary")


def pack_split(observations: DataFrame) -> DataFrame:
    """content, as ``pack``, of observations with numbers of any size: key, over_events, over_station (see
    ``merge.split_numbers``), dt_u6, cc_u6. A null in any of them is an error."""
    names = ["key", "over_events", "over_station", "dt_u6", "cc_u6"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(batch.column(c).null_count for c in names):
                raise ValueError("an observation without key, dt or cc")
            key, events, station, dt, cc = (batch.column(c).to_numpy() for c in names)
            wide = (events != 0) | (station != 0)
            at = np.arange(len(key)) + np.cumsum(wide)
            out = np.zeros(len(key) + wide.sum(), RECORD)
            out["key"][at] = key.astype(np.uint64)
            out["dt"][at], out["cc"][at] = _stored(dt), _stored(cc)
            out["key"][at[wide] - 1] = events[wide].astype(np.uint64) | OVER
            out["dt"][at[wide] - 1] = station[wide].astype(np.uint32)
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["content"])

    return observations.select(*names).mapInArrow(run, "content binary")


def _records(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The records of the batch's contents, some at a time; a record of upper bits and the one it belongs to come together."""
    for content in batch.column("content"):
        data = content.as_buffer() if content.is_valid else b""
        if len(data) % RECORD.itemsize:
            raise ValueError("packed observations whose size is no multiple of 16")
        records, at = np.frombuffer(data, RECORD), 0
        while at < len(records):
            end = min(at + STEP, len(records))
            end += bool(records["key"][end - 1] & OVER)
            yield records[at:end]
            at = end


def unpack_split(contents: DataFrame) -> DataFrame:
    """key, over_events, over_station, dt_u6, cc_u6 of the records in ``contents.content``, as ``pack_split`` writes them; a
    record of upper bits that none follows is an error, as is what ``unpack`` refuses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (x for batch in batches for x in _records(batch)):
            wide = some["key"] >= OVER
            before = np.concatenate([[False], wide[:-1]])
            if wide[-1] or (wide & before).any():
                raise ValueError("upper bits without an observation")
            main = np.flatnonzero(~wide)
            over = some[np.maximum(main - 1, 0)]
            events, station = (np.where(before[main], x, 0).astype(kind) for x, kind in ((over["key"] & ~OVER, np.int64), (over["dt"], np.int32)))
            rest = some[main]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rest["key"].astype(np.int64), events, station, _read(rest["dt"]), _read(rest["cc"]))], ["key", "over_events", "over_station", "dt_u6", "cc_u6"])

    return contents.select("content").mapInArrow(run, "key long, over_events long, over_station int, dt_u6 int, cc_u6 int")


def unpack(contents: DataFrame) -> DataFrame:
    """key, dt_u6, cc_u6 of the records in ``contents.content``; null and empty contents hold none, a content whose size is
    no multiple of 16 is an error, as are numbers that have no room in the key (``unpack_split`` reads them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (x for batch in batches for x in _records(batch)):
            if (some["key"] >= OVER).any():
                raise ValueError("packed observations whose numbers have no room in the key")
            yield pa.RecordBatch.from_arrays([pa.array(some["key"].astype(np.int64)), pa.array(_read(some["dt"])), pa.array(_read(some["cc"]))], ["key", "dt_u6", "cc_u6"])

    return contents.select("content").mapInArrow(run, "key long, dt_u6 int, cc_u6 int")


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """The records of all files under ``path``. A file is one row of a task, so large sets come in files of up to 2 GB."""
    return unpack(spark.read.format("binaryFile").load(path))
