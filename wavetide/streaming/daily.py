"""Incremental runs: new waveform days are cut as they arrive, days that are done are not cut again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def pending(requests: DataFrame, done: DataFrame) -> DataFrame:
    """Requests (station, day, ...) whose station and day is not in ``done`` (station, day) yet."""
    return requests.join(done.select("station", "day").distinct(), ["station", "day"], "left_anti")


def mark_done(requests: DataFrame, path: str) -> None:
    """Adds the stations and days of ``requests`` to the marks under ``path``, those that gave no window too; read back as Parquet
    they are the ``done`` of ``pending``."""
    requests.select("station", "day").distinct().write.mode("append").parquet(path)


def cut_new_traces(spark: SparkSession, source: str, schema: StructType, cut: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs ``cut`` over the trace files that appear under ``source`` and adds its rows under ``target``, one folder per batch.

    The stream's checkpoint remembers which files are done; a batch that is run again after a failure overwrites its own
    folder, so every file counts once. ``once`` ends when the files present are done.
    """

    def write(batch: DataFrame, number: int) -> None:
        cut(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream.trigger(processingTime="1 minute")).start()


def arrivals(traces: DataFrame, late: str = "2 days") -> DataFrame:
    """Streaming or not: station, channel, date, window, n_traces, n_samples by hour of arrival; traces that arrive more than
    ``late`` behind the newest are left out of a stream. Rows without station or arrival are left out."""
    usable = traces.filter("station is not null and received is not null").withWatermark("received", late)
    per_hour = usable.groupBy("station", "channel", "date", F.window("received", "1 hour"))
    return per_hour.agg(F.count(F.lit(1)).alias("n_traces"), F.sum(F.coalesce(F.size("data"), F.lit(0))).alias("n_samples"))
