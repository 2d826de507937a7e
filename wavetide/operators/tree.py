"""Results per key where a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States that one merging task may meet of one key in one round.
FAN_IN = 16


def tree_aggregate(
    df: DataFrame, keys: list[str], states: dict[str, tuple[Column, Callable[[str], Column]]], chunks: int | None = None, fan_in: int = FAN_IN
) -> DataFrame:
    """Aggregate ``df`` by ``keys`` through rounds that each merge at most ``fan_in`` states of a key.

    ``states`` names each state's aggregate over rows and the aggregate that merges states, for example
    ``{"n": (F.count(F.lit(1)), F.sum)}``. Every input partition (a chunk of fixed size, ``spark.sql.files.maxPartitionBytes``)
    is combined where it lies, before anything is shuffled; ceil(log_fan_in(chunks)) rounds follow. So no reducer meets
    one state of a hot key from every chunk. Null keys form groups of their own. An empty ``df`` gives no rows.
    """
    chunks = chunks or max(1, df.rdd.getNumPartitions())
    aggs = [first.alias(name) for name, (first, _) in states.items()]
    merges = [merge(name).alias(name) for name, (_, merge) in states.items()]
    if chunks <= fan_in:
        return df.groupBy(*keys).agg(*aggs)
    level = df.withColumn("_node", F.floor(F.spark_partition_id() / F.lit(fan_in)).cast("int")).groupBy(*keys, "_node").agg(*aggs)
    nodes = -(-chunks // fan_in)
    while nodes > fan_in:
        nodes = -(-nodes // fan_in)
        level = level.withColumn("_node", F.floor(F.col("_node") / F.lit(fan_in)).cast("int")).groupBy(*keys, "_node").agg(*merges)
    return level.groupBy(*keys).agg(*merges)


def roll_up(
    level: DataFrame, keys: list[str], spread: str, merges: dict[str, Callable[[str], Column]], rounds: int = 2, fan_in: int = FAN_IN
) -> DataFrame:
    """Merge states of finer keys into ``keys`` in ``rounds`` rounds: the states of one key are first spread over
    fan_in ** rounds nodes by a hash of ``spread``, so that the last reducer meets at most ``fan_in`` states of a key."""
    level = level.withColumn("_node", F.pmod(F.xxhash64(F.col(spread)), F.lit(fan_in**rounds)))
    for _ in range(rounds):
        level = level.groupBy(*keys, "_node").agg(*[merge(name).alias(name) for name, merge in merges.items()])
        level = level.withColumn("_node", F.floor(F.col("_node") / F.lit(fan_in)))
    return level.groupBy(*keys).agg(*[merge(name).alias(name) for name, merge in merges.items()])


def window_counts(tasks: DataFrame) -> DataFrame:
    """station, row_a, n, n_rows_b: rows of each stored window. Station codes come untidied out of the table."""
    return tree_aggregate(tasks.select("station", "row_a", "row_b"), ["station", "row_a"], {"n": (F.count(F.lit(1)), F.sum), "row_b_min": (F.min("row_b"), F.min), "row_b_max": (F.max("row_b"), F.max)})


def heavy_windows(windows: DataFrame, stations: DataFrame, total: int, station_percent: int = 4, window_permille: int = 5) -> DataFrame:
    """field, station, row_a of the stations with station_percent % and the windows with window_permille ‰ of ``total`` rows at least."""
    of_station = stations.filter("station is not null").filter(F.col("n") * 100 >= total * station_percent).select(F.lit("station").alias("field"), "station", F.lit(-1).alias("row_a"))
    # one condition on the count: a filter on row_a alone would go down to the scan and keep Spark from sharing the rounds
    named = F.when(F.col("row_a").isNotNull(), F.col("n"))
    of_window = windows.filter("station is not null").filter(named * 1000 >= total * window_permille).select(F.lit("row_a").alias("field"), "station", "row_a")
    return of_station.unionByName(of_window)
