"""Events with their picks and stored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetide.config import Config
from wavetide.functions.columns import centisecond_id, day_key, finite, micros, station_code


def last_picks(picks: DataFrame) -> DataFrame:
    """evid, station, tp_us, ts_us: of several lines of one event and station the one with the largest line_no counts as
    a whole, missing times included. Lines without evid or station are left out."""
    return (
        picks.select("evid", station_code(F.col("net_sta")).alias("station"), micros(F.col("tp")).alias("tp_us"), micros(F.col("ts")).alias("ts_us"), "line_no")
        .filter("evid is not null and station is not null")
        .groupBy("evid", "station")
        .agg(F.max_by(F.struct("tp_us", "ts_us"), "line_no").alias("p"))
        .select("evid", "station", "p.tp_us", "p.ts_us")
    )


def event_ids(quakes: DataFrame) -> DataFrame:
    """evid, ord, waveform_name (origin time to the hundredth, cut off), day, ot_s of every row with an origin time."""
    us = micros(F.col("ot"))
    return quakes.filter("ot is not null").select("evid", "ord", centisecond_id(us).alias("waveform_name"), day_key(us).alias("day"), (us / 1e6).alias("ot_s"))


def travel_times(picks: DataFrame, quakes: DataFrame) -> DataFrame:
    """evid, station, tp_rel, ts_rel: pick times after the origin as 32-bit floats, -1 where there is no pick.

    ``picks`` as of ``last_picks``; ``quakes`` one row per evid with ot. Events without origin time drop out.
    """
    origin = quakes.filter("ot is not null").select("evid", micros(F.col("ot")).alias("ot_us"))
    rel = lambda t: F.coalesce(((t - F.col("ot_us")) / 1e6).cast("float"), F.lit(-1.0).cast("float"))
    return picks.join(origin, "evid").select("evid", "station", rel(F.col("tp_us")).alias("tp_rel"), rel(F.col("ts_us")).alias("ts_rel"))


def cut_requests(picks: DataFrame, quakes: DataFrame, days: DataFrame) -> DataFrame:
    """station, day, requests: the picks to cut from each station and day that has waveforms (``days``: station, day).

    A pick looks up the UTC day of its event's origin, also if it lies after midnight. Requests are sorted by P travel
    time, those without P last, then by evid.
    """
    origin = quakes.filter("ot is not null").select("evid", micros(F.col("ot")).alias("ot_us"), day_key(micros(F.col("ot"))).alias("day"))
    wanted = picks.join(origin, "evid").join(days.select("station", "day").distinct(), ["station", "day"], "left_semi")
    request = F.struct(F.coalesce((F.col("tp_us") - F.col("ot_us")) / 1e6, F.lit(1e12)).alias("travel"), "evid", "ot_us", "tp_us", "ts_us")
    return wanted.groupBy("station", "day").agg(F.array_sort(F.collect_list(request)).alias("requests"))


def event_records(quakes: DataFrame, picks: DataFrame, config: Config, stored: DataFrame | None = None) -> DataFrame:
    """evid, ot_us, lat, lon, dep, mag, stations, is_temp of events with ``num_sta`` stations at least.

    ``stored`` (evid, station), where given, names the windows that exist; only those stations count. A template has
    magnitude ``temp_mag`` and ``temp_sta`` stations at least; a null or NaN magnitude is none. Events without origin
    time or with a coordinate or depth missing are left out.
    """
    seen = picks.select("evid", "station").distinct()
    if stored is not None:
        seen = seen.join(stored.select("evid", "station").distinct(), ["evid", "station"], "left_semi")
    per_event = seen.groupBy("evid").agg(F.array_sort(F.collect_list("station")).alias("stations")).filter(F.size("stations") >= config.num_sta)
    big = F.coalesce(~F.isnan("mag") & (F.col("mag") >= config.temp_mag), F.lit(False))
    known = quakes.filter("ot is not null").filter(finite(F.col("lat")) & finite(F.col("lon")) & finite(F.col("dep")))
    return known.join(per_event, "evid").select(
        "evid", micros(F.col("ot")).alias("ot_us"), "lat", "lon", "dep", "mag", "stations", (big & (F.size("stations") >= config.temp_sta)).alias("is_temp")
    )
