"""Overlapping and gapped time intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def sweep(intervals: DataFrame, entity: list[str], join_us: int, slice_us: int = DAY_US) -> DataFrame:
    """entity..., start_us, end_us, next_us: the continuous periods of each entity's intervals (start_us, end_us).

    Sweep line: each interval is a plus event at its start and a minus event at its end + ``join_us``, equal events are
    summed before the shuffle, and a running count that returns to zero ends a period. Intervals belong together when the
    next starts at most ``join_us`` after the latest end so far; ``next_us`` is the start of the entity's next period.

    No task sees a whole entity: events are counted within slices of ``slice_us``, and only one row per slice (its net
    change and its first period start) runs through the window over the entity's slices.

    Rows with a null or a reversed bound are left out; an entity column may be null (a group of its own); repeated
    and empty intervals (start = end) count as they stand; an empty table gives no rows; other columns are dropped.
    """
    keys = [F.col(c) for c in entity]
    events = intervals.filter("start_us is not null and end_us is not null and end_us >= start_us").select(
        *keys, F.explode(F.array(F.struct(F.col("start_us").alias("at"), F.lit(1).alias("d")), F.struct((F.col("end_us") + join_us).alias("at"), F.lit(-1).alias("d")))).alias("e")
    )
    events = events.groupBy(*keys, F.floor(F.col("e.at") / F.lit(slice_us)).alias("_slice"), F.col("e.at").alias("at"), F.col("e.d").alias("d")).agg(F.sum("e.d").cast("long").alias("net"))

    # what is open when a slice begins
    by_slice = W.partitionBy(*entity).orderBy("_slice")
    carried = (
        events.groupBy(*keys, "_slice")
        .agg(F.sum("net").alias("_net"))
        .select(*keys, "_slice", F.coalesce(F.sum("_net").over(by_slice.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_open"))
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*entity, "_slice"]]
    on = same[0]
    for s in same[1:]:
        on = on & s
    inside = W.partitionBy(*entity, "_slice").orderBy("at", F.desc("d"))  # at one instant starts go before ends
    counted = (
        events.alias("l").join(carried.alias("r"), on).select("l.*", "r._open")
        .withColumn("_n", F.col("_open") + F.sum("net").over(inside.rowsBetween(W.unboundedPreceding, 0)))
        .filter((F.col("_n") == 0) | ((F.col("d") == 1) & (F.col("_n") == F.col("net"))))  # only ends and starts of periods go on
    )
    # each end meets its own start and the next one: within the slice, or else in the nearest slice that has one
    edges = counted.withColumn("_s", F.when(F.col("d") == 1, F.col("at")))
    summary = edges.groupBy(*keys, "_slice").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
    summary = summary.select(
        *keys,
        "_slice",
        F.last("_last", True).over(by_slice.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", True).over(by_slice.rowsBetween(1, W.unboundedFollowing)).alias("_after"),
    )
    ends = edges.alias("l").join(summary.alias("r"), on).select("l.*", "r._before", "r._after")
    ends = ends.withColumn("_from", F.coalesce(F.last("_s", True).over(inside.rowsBetween(W.unboundedPreceding, 0)), "_before"))
    ends = ends.withColumn("next_us", F.coalesce(F.first("_s", True).over(inside.rowsBetween(1, W.unboundedFollowing)), "_after"))
    return ends.filter("d = -1").select(*entity, F.col("_from").alias("start_us"), (F.col("at") - join_us).alias("end_us"), "next_us")


def periods_and_gaps(intervals: DataFrame, entity: list[str], join_us: int, longest_gap_us: int, slice_us: int = DAY_US) -> DataFrame:
    """entity..., kind, start_us, end_us: the periods of ``sweep`` and the gaps of at most ``longest_gap_us`` between them."""
    both = sweep(intervals, entity, join_us, slice_us).withColumn(
        "_x",
        F.array(
            F.struct(F.lit("period").alias("kind"), F.col("start_us").alias("a"), F.col("end_us").alias("b")),
            F.struct(F.lit("gap").alias("kind"), F.col("end_us").alias("a"), F.col("next_us").alias("b")),
        ),
    )
    return both.select(*entity, F.explode("_x").alias("x")).select(*entity, "x.kind", F.col("x.a").alias("start_us"), F.col("x.b").alias("end_us")).filter(
        (F.col("kind") == "period") | (F.col("end_us") - F.col("start_us") <= longest_gap_us)
    )
