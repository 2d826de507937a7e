"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_windows(windows: DataFrame, path: str, only_new: bool = False) -> None:
    """Parquet by station. With ``only_new`` a run replaces the stations that it holds and leaves the others."""
    mode = "dynamic" if only_new else "static"
    windows.repartition("station", F.pmod(F.xxhash64("evid"), F.lit(16))).write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd").partitionBy("station").parquet(path)


def write_tasks(tasks: DataFrame, path: str) -> None:
    """Stored tasks (station, row_a, row_b, ...) as Parquet by station, in the order of their rows; a station's tasks are cut
    into 16 files by row_a, so that one with very many is not one task's work."""
    parts = tasks.repartition("station", F.pmod(F.xxhash64("row_a"), F.lit(16))).sortWithinPartitions("station", "row_a", "row_b")
    parts.write.mode("overwrite").option("compression", "zstd").partitionBy("station").parquet(path)


def write_dt_text(blocks: DataFrame, path: str) -> None:
    """Text blocks (evid_a, evid_b, block) in the order of their numeric evids, in as many files as the sort has ranges;
    the files' names sort as their contents."""
    blocks.select(F.col("evid_a").cast("long").alias("a"), F.col("evid_b").cast("long").alias("b"), "block").orderBy("a", "b").select("block").write.mode("overwrite").text(path)


def run_meta(parameters: dict, inputs: DataFrame) -> DataFrame:
    """One row: the parameters as JSON, the number and size of the input files (path, length) and a fingerprint of both."""
    import json

    text = json.dumps(parameters, sort_keys=True, default=str)
    files = inputs.select(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"), F.coalesce(F.bit_xor(F.xxhash64("path", "length")), F.lit(0).cast("long")).alias("_files"))
    return files.select("n_files", "n_bytes", F.lit(text).alias("parameters"), F.sha2(F.concat_ws("|", F.lit(text), F.col("_files").cast("string"), F.col("n_files").cast("string")), 256).alias("fingerprint"))
