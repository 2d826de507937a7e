"""miniSEED records as rows."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.operators.waveforms import station_days
from wavetide.sources.catalog import list_waveforms

RECORD = "path string, no int, station string, channel string, start_us long, rate double, samples array<float>"
#: Data encodings by their number in the format: plain samples as NumPy types, and the two Steim compressions.
PLAIN = {1: "i2", 3: "i4", 4: "f4", 5: "f8"}
STEIM_1, STEIM_2 = 10, 11
#: How Steim 2 packs a word: code and first two bits give (differences, bits each).
STEIM_2_PACKING = {(2, 1): (1, 30), (2, 2): (2, 15), (2, 3): (3, 10), (3, 0): (5, 6), (3, 1): (6, 5), (3, 2): (7, 4)}


def steim(body: bytes, n: int, kind: int, order: str) -> np.ndarray:
    """Samples of a Steim-compressed record: frames of 16 words, of which the first holds a 2-bit code for each."""
    words = np.frombuffer(body[: len(body) // 64 * 64], f"{order}u4").astype(np.int64).reshape(-1, 16)
    codes = (words[:, :1] >> (30 - 2 * np.arange(16))) & 3
    first, last = words[0, 1], words[0, 2]
    signed = lambda x, bits: (x ^ (1 << (bits - 1))) - (1 << (bits - 1))
    steps = []
    for code, word in zip(codes.ravel().tolist(), words.ravel().tolist()):
        if code == 0:
            continue
        if code == 1:
            count, bits = 4, 8
        elif kind == STEIM_1:
            count, bits = (2, 16) if code == 2 else (1, 32)
        else:
            count, bits = STEIM_2_PACKING[code, word >> 30]
        steps += [signed((word >> (bits * k)) & ((1 << bits) - 1), bits) for k in range(count - 1, -1, -1)]
    out = np.array(steps[:n], np.int64)
    if len(out) < n:
        raise ValueError("a compressed record ends early")
    if n:
        out[0] = signed(int(first), 32)
        out = np.cumsum(out)
        if out[-1] != signed(int(last), 32):
            raise ValueError("a compressed record does not end in its last sample")
    return out


def records(data: bytes) -> Iterator[tuple[str, str, int, float, np.ndarray]]:
    """station (NET.STA), channel, start in microseconds, rate and samples of each record of a file."""
    at = 0
    while at + 48 <= len(data):
        head = data[at : at + 48]
        order = ">" if 1900 <= int.from_bytes(head[20:22], "big") <= 2500 else "<"
        number = lambda a, kind, head=head, order=order: int(np.frombuffer(head, f"{order}{kind}", 1, a)[0])
        n, factor, multiplier = number(30, "u2"), number(32, "i2"), number(34, "i2")
        begin, blockette = number(44, "u2"), number(46, "u2")
        encoding, size, seen = 1, 0, 0
        while blockette and at + blockette + 8 <= len(data) and seen < 64:
            kind, following = np.frombuffer(data, f"{order}u2", 2, at + blockette)
            if kind == 1000:
                encoding, word_order, size = data[at + blockette + 4], data[at + blockette + 5], 1 << data[at + blockette + 6]
                order_of_data = ">" if word_order else "<"
            blockette, seen = int(following), seen + 1
        if not size:
            raise ValueError("a record without blockette 1000")
        rate = float(factor) if factor > 0 else -1.0 / factor if factor else 0.0
        rate *= multiplier if multiplier > 0 else -1.0 / multiplier if multiplier else 1.0
        day = datetime.datetime(number(20, "u2"), 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(days=number(22, "u2") - 1)
        us = int(day.timestamp()) * 1_000_000 + (head[24] * 3600 + head[25] * 60 + head[26]) * 1_000_000 + number(28, "u2") * 100
        body = data[at + begin : at + size]
        samples = steim(body, n, encoding, order_of_data) if encoding in (STEIM_1, STEIM_2) else np.frombuffer(body, order_of_data + PLAIN[encoding], n)
        text = lambda a, b, head=head: head[a:b].decode("ascii").strip()
        if n and rate > 0:
            yield f"{text(18, 20)}.{text(8, 13)}", text(15, 18), us, rate, samples.astype(np.float32)
        at += size


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files under ``path``; a file that cannot be read gives no rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for file, content in zip(pdf["path"], pdf["content"]):
                try:
                    got = list(records(content))
                except (ValueError, KeyError, IndexError, UnicodeDecodeError):
                    continue
                yield pd.DataFrame([(file, k, *r) for k, r in enumerate(got)], columns=["path", "no", "station", "channel", "start_us", "rate", "samples"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, RECORD)


def traces(records: DataFrame) -> DataFrame:
    """path, station, channel, start_us, rate, data: records of one file and channel that follow one another, put together.

    A record follows if it starts within half a sample of the end of the one before, at the same rate; a gap or an overlap begins a new trace.
    """
    along = W.partitionBy("path", "station", "channel").orderBy("start_us", "no")
    end = F.col("start_us") + F.size("samples") / F.col("rate") * 1e6
    apart = F.abs(F.col("start_us") - F.lag(end).over(along)) > 5e5 / F.col("rate")
    new = F.when(F.coalesce(apart | (F.lag("rate").over(along) != F.col("rate")), F.lit(True)), 1).otherwise(0)
    runs = records.withColumn("_new", new).withColumn("_run", F.sum("_new").over(along))
    parts = F.array_sort(F.collect_list(F.struct("start_us", "no", "samples")))
    return runs.groupBy("path", "station", "channel", "_run").agg(F.min("start_us").alias("start_us"), F.first("rate").alias("rate"), F.flatten(F.transform(parts, lambda r: r["samples"])).alias("data")).drop("_run")


def station_day_traces(spark: SparkSession, root: str, suffix: str = "mseed") -> DataFrame:
    """station, day, channel, trace_id, start_us, rate, data of the waveform folders under ``root`` (``list_waveforms``): the
    three files of each station and day, cut to their common stretch (``waveforms.station_days``). A day whose files hold more
    than three traces, so one with gaps, is left out.
    """
    files = list_waveforms(spark, root, suffix).select("day", F.posexplode("paths").alias("k", "path"))
    told = traces(read_records(spark, f"{root}/[0-9]*")).join(files, "path")
    return station_days(told.select("station", "day", "channel", F.col("k").cast("long").alias("trace_id"), "start_us", "rate", "data"))
