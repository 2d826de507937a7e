"""Observations of differential times: fixed point, last of each, thresholds and the text form."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICRO = 1_000_000
#: Bits of the packed key: both events, station, phase.
EVENT_BITS, STATION_BITS = 20, 10
#: Bits that event a, event b and station may have at most for their joined key to be a long.
LONG_BITS = 32, 52, 31
#: Bits of event b above its EVENT_BITS.
OVER_BITS = LONG_BITS[1] - EVENT_BITS


def micro_units(x: Column) -> Column:
    """Millionths as int, half to even. What is not finite or does not fit is an error."""
    fits = F.coalesce(F.abs(x) <= F.lit(2147.483647), F.lit(False)) & ~F.isnan(x)
    return F.when(fits, F.rint(x * F.lit(float(MICRO))).cast("int")).otherwise(F.raise_error(F.concat(F.lit("no fixed-point value: "), x.cast("string"))).cast("int"))


def _held(x: Column, bits: int) -> Column:
    return F.when(x.isNull() | x.between(0, (1 << bits) - 1), x.cast("long")).otherwise(F.raise_error(F.concat(F.lit("no room in the key: "), x.cast("string"))).cast("long"))


def _joined(a: Column, b: Column, station: Column, phase: Column) -> Column:
    return F.shiftleft(F.shiftleft(a, EVENT_BITS).bitwiseOR(b), STATION_BITS + 1).bitwiseOR(F.shiftleft(station, 1).bitwiseOR(F.when(phase == "S", F.lit(1)).otherwise(F.lit(0)).cast("long")))


def packed(a: Column, b: Column, station: Column, phase: Column) -> Column:
    """One long of event a, event b, station number and phase (P 0, S 1). A number that has no room is an error."""
    return _joined(_held(a, EVENT_BITS), _held(b, EVENT_BITS), _held(station, STATION_BITS), phase)


def long_key(a: Column, b: Column, station: Column, phase: Column) -> Column:
    """The long of ``packed``, joined the same way of larger numbers too. Where they exceed their bits they run into each
    other: such keys can be equal and cannot be taken apart, so the numbers must stand beside them. Negative numbers and
    those whose key is no long are an error."""
    return _joined(*[_held(x, bits) for x, bits in zip((a, b, station), LONG_BITS)], phase)


def unpacked(key: Column) -> list[Column]:
    """event a, event b, station number, phase of a packed key."""
    cut = lambda shift, bits: F.shiftright(key, shift).bitwiseAND(F.lit((1 << bits) - 1))
    return [
        cut(STATION_BITS + 1 + EVENT_BITS, EVENT_BITS).alias("event_a"),
        cut(STATION_BITS + 1, EVENT_BITS).alias("event_b"),
        cut(1, STATION_BITS).alias("station_no"),
        F.when(cut(0, 1) == 1, "S").otherwise("P").alias("phase"),
    ]


def split_numbers(a: Column, b: Column, station: Column, phase: Column) -> list[Column]:
    """key, over_events, over_station: the packed key of the numbers' lower bits, and their bits above it (0 if there is room)."""
    a, b, station = (_held(x, bits) for x, bits in zip((a, b, station), LONG_BITS))
    low = lambda x, bits: x.bitwiseAND(F.lit((1 << bits) - 1))
    over = F.shiftleft(F.shiftright(a, EVENT_BITS), OVER_BITS).bitwiseOR(F.shiftright(b, EVENT_BITS))
    key = _joined(low(a, EVENT_BITS), low(b, EVENT_BITS), low(station, STATION_BITS), phase)
    return [key.alias("key"), over.alias("over_events"), F.shiftright(station, STATION_BITS).cast("int").alias("over_station")]


def whole_numbers(key: Column, over_events: Column, over_station: Column) -> list[Column]:
    """event a, event b, station number, phase of what ``split_numbers`` gives."""
    a, b, station, phase = unpacked(key)
    over_b = over_events.bitwiseAND(F.lit((1 << OVER_BITS) - 1))
    return [
        F.shiftleft(F.shiftright(over_events, OVER_BITS), EVENT_BITS).bitwiseOR(a).alias("event_a"),
        F.shiftleft(over_b, EVENT_BITS).bitwiseOR(b).alias("event_b"),
        F.shiftleft(over_station.cast("long"), STATION_BITS).bitwiseOR(station).alias("station_no"),
        phase,
    ]


def last_observations(obs: DataFrame) -> DataFrame:
    """evid_a, evid_b, station, phase, dt_u6, cc_u6: the observation with the largest ``ordinal`` of each."""
    return (
        obs.groupBy("evid_a", "evid_b", "station", "phase").agg(F.max_by(F.struct("dt_u6", "cc_u6"), "ordinal").alias("o")).select("evid_a", "evid_b", "station", "phase", "o.*")
    )


def well_observed(obs: DataFrame, num_sta: int) -> DataFrame:
    """Observations of pairs that are seen at ``num_sta`` stations at least, whatever the phase. A pair has two of each station
    at most, so its rows are counted where they stand."""
    stations = F.size(F.collect_set("station").over(W.partitionBy("evid_a", "evid_b")))
    return obs.withColumn("_n_sta", stations).filter(F.col("_n_sta") >= num_sta).drop("_n_sta")


def numbered(obs: DataFrame, numbers: DataFrame) -> DataFrame:
    """``obs`` with station_no (``numbers``: station, station_no). An observation of a station without number is an error."""
    met = obs.join(numbers.select("station", F.col("station_no").alias("_no")), "station", "left")
    miss = F.raise_error(F.concat(F.lit("no such station: "), F.coalesce("station", F.lit("null")))).cast("int")
    return met.withColumn("station_no", F.when(F.col("_no").isNotNull(), F.col("_no")).otherwise(miss)).drop("_no")


@F.pandas_udf(T.StringType())
def _dt_line(code: pd.Series, dt: pd.Series, cc: pd.Series, phase: pd.Series) -> pd.Series:
    # rounding as C's printf does it, on the exact binary value
    return pd.Series(["%-7s %8.5f %.4f %s" % (c, d / MICRO, x / MICRO, p) for c, d, x, p in zip(code, dt, cc, phase)], dtype="object")


def dt_lines(obs: DataFrame) -> DataFrame:
    """evid_a, evid_b, block: the text block of each pair: a head line, then a line per station and phase.

    The station is written without its network; two stations of a pair with one such code are an error. Evids must be numbers.
    """
    code = F.element_at(F.split("station", r"\."), -1)
    lines = obs.select("evid_a", "evid_b", "station", "phase", code.alias("code"), _dt_line(code, "dt_u6", "cc_u6", "phase").alias("line"))
    blocks = lines.groupBy("evid_a", "evid_b").agg(F.array_sort(F.collect_list(F.struct("station", "phase", "line"))).alias("l"), F.count_distinct("station").alias("n"), F.count_distinct("code").alias("m"))
    head = F.concat(F.lit("# "), F.lpad(F.col("evid_a").cast("long").cast("string"), 9, " "), F.lit(" "), F.lpad(F.col("evid_b").cast("long").cast("string"), 9, " "), F.lit(" 0.0\n"))
    text = F.concat(head, F.array_join("l.line", "\n"))
    return blocks.select("evid_a", "evid_b", F.when(F.col("n") == F.col("m"), text).otherwise(F.raise_error(F.lit("two stations with one code"))).alias("block"))


def catalogue_observations(pairs: DataFrame, picks: DataFrame, origins: DataFrame, limits: tuple[float, float]) -> DataFrame:
    """evid_a, evid_b, station, phase, dt_u6, cc_u6, ordinal: differences of travel times of pairs at common stations.

    ``pairs`` (evid_a, evid_b, ordinal) may repeat; dt is travel time of a minus travel time of b, kept up to ``limits``
    (P, S) in seconds; its weight, in place of a correlation, falls from 1 to 0 at the limit.
    """
    rel = picks.join(origins, "evid").select("evid", "station", (F.col("tp_us") - F.col("ot_us")).alias("p"), (F.col("ts_us") - F.col("ot_us")).alias("s"))
    side = lambda k: rel.select(F.col("evid").alias(f"evid_{k}"), F.col("station").alias("station"), F.col("p").alias(f"p_{k}"), F.col("s").alias(f"s_{k}"))
    both = pairs.join(side("a"), "evid_a").join(side("b"), ["evid_b", "station"])
    one = lambda phase, k, limit: F.struct(F.lit(phase).alias("phase"), (F.col(f"{k}_a") - F.col(f"{k}_b")).alias("dt"), F.lit(int(limit * MICRO)).alias("limit"))
    obs = both.select("evid_a", "evid_b", "station", "ordinal", F.explode(F.array(one("P", "p", limits[0]), one("S", "s", limits[1]))).alias("o")).filter(F.abs("o.dt") <= F.col("o.limit"))
    weight = F.lit(1.0) - F.abs("o.dt") / F.col("o.limit")
    return obs.select("evid_a", "evid_b", "station", F.col("o.phase").alias("phase"), F.col("o.dt").cast("int").alias("dt_u6"), micro_units(weight).alias("cc_u6"), "ordinal")
