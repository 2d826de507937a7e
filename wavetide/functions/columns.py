"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
KM_PER_DEGREE = 111.0


def station_code(code: Column) -> Column:
    """Code without blanks and tabs at its ends, in upper case; null if nothing is left."""
    bare = F.upper(F.btrim(code, F.lit(" \t")))
    return F.when(F.length(bare) > 0, bare)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 UTC, whatever the session's time zone."""
    return F.unix_micros(ts)


def day_of(us: Column) -> Column:
    """UTC day 'YYYY-MM-DD' of microseconds since 1970."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(us / F.lit(DAY_US)).cast("int")).cast("string")


def day_key(us: Column) -> Column:
    """UTC day 'YYYYMMDD' of microseconds since 1970."""
    return F.replace(day_of(us), F.lit("-"), F.lit(""))


def centisecond_id(us: Column) -> Column:
    """Name of an event by its origin time, YYYYMMDDhhmmss.cc; the hundredths are cut off, not rounded."""
    day = F.floor(us / F.lit(DAY_US))
    hundredths = F.floor((us - day * DAY_US) / F.lit(10_000))
    second = F.floor(hundredths / F.lit(100))
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(
        day_key(us), pad(F.floor(second / F.lit(3600))), pad(F.floor(second / F.lit(60)) % 60), pad(second % 60), F.lit("."), pad(hundredths % 100)
    )


def has_place(lat: Column, lon: Column) -> Column:
    """True if both are numbers, lat within 90 and lon within 180 degrees of zero (never null)."""
    inside = lambda x, most: F.coalesce(~F.isnan(x) & (F.abs(x) <= most), F.lit(False))
    return inside(lat, 90.0) & inside(lon, 180.0)


def ground_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, wrap: bool = True) -> Column:
    """Flat-earth distance with the cosine of the mean latitude; with ``wrap`` longitudes are taken the short way round."""
    dlon = F.abs(lon_a - lon_b)
    if wrap:
        dlon = F.when(dlon > 180.0, 360.0 - dlon).otherwise(dlon)
    east = F.cos(F.radians((lat_a + lat_b) / 2.0)) * dlon
    north = lat_a - lat_b
    return KM_PER_DEGREE * F.sqrt(east * east + north * north)


def finite(x: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
