"""The project's tables and the views of them that most queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetide.functions.columns import has_place, micros, station_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest_quakes(quakes: DataFrame) -> DataFrame:
    """One row per evid: the row with the largest ``ord``. Rows without evid are left out. Repeats of one ord keep one."""
    cols = [c for c in quakes.columns if c != "evid"]
    return (
        quakes.filter(F.col("evid").isNotNull())
        .groupBy("evid")
        .agg(F.max_by(F.struct(*cols), "ord").alias("_q"))
        .select("evid", *[F.col(f"_q.{c}").alias(c) for c in cols])
    )


def quake_places(quakes: DataFrame) -> DataFrame:
    """``latest_quakes`` that have a place."""
    return latest_quakes(quakes.select("evid", "ot", "lat", "lon", "dep", "ord")).filter(has_place(F.col("lat"), F.col("lon")))


def station_places(stations: DataFrame) -> DataFrame:
    """station, lat, lon, ele: of several rows of one code the one with the largest line_no, if it has a place."""
    return (
        stations.withColumn("station", station_code(F.col("net_sta")))
        .filter("station is not null")
        .groupBy("station")
        .agg(F.max_by(F.struct("lat", "lon", "ele"), "line_no").alias("_s"))
        .select("station", "_s.lat", "_s.lon", "_s.ele")
        .filter(has_place(F.col("lat"), F.col("lon")))
    )


def station_terms(stations: DataFrame) -> DataFrame:
    """key, from_us, to_us: every term of service in the station file; a null end is open."""
    return (
        stations.select(station_code(F.col("net_sta")).alias("key"), micros(F.col("opened")).alias("from_us"), micros(F.col("closed")).alias("to_us"))
        .filter("key is not null")
        .distinct()
    )
