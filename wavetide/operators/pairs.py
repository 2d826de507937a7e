"""Candidate pairs of nearby events and the stations they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavetide.config import Config
from wavetide.functions.columns import DAY_US, KM_PER_DEGREE, ground_km


def band_cells(lat: Column, lon: Column, half_km: float) -> tuple[Column, Column]:
    """Row and column of a point in a grid whose rows are ``half_km`` high; columns are that wide at the rows' far edge."""
    row = F.floor(lat / band_height(half_km))
    return row, F.floor(lon / band_width(row, half_km))


def band_height(half_km: float) -> float:
    """Height of a row in degrees."""
    return half_km / KM_PER_DEGREE * (1 + 1e-9)


def band_width(row: Column, half_km: float) -> Column:
    """Width of a column in degrees: a fixed function of the row, never narrower than the band at the row itself."""
    height = band_height(half_km)
    edge = F.least(F.greatest(F.abs(row * height), F.abs((row + 1) * height)), F.lit(89.0))
    return F.lit(height) / F.cos(F.radians(edge))


def candidate_edges(records: DataFrame, config: Config) -> DataFrame:
    """ref, cand, dist: for every reference event the events (itself too, if a template) in its box, in its rank.

    Latitude and longitude (with the cosine of the reference's latitude) and depth are strictly within their limits, time
    within its own inclusive; one of both is a template; both share ``num_sta`` stations. Of these the nearest in three
    dimensions are kept up to place ``max_nbr`` + 1, ties included. Longitudes are not wrapped.

    The band join is an equi-join on cells of place, depth and time, each twice as wide as the limit (time: four times): a
    reference is copied to the cells its box meets, about twelve, a candidate stays in its one cell, and the exact box
    follows as a filter, cheap conditions before the sets of stations. So events of other depths or years do not meet.
    """
    half = config.loc_dev
    depth, time = 2 * config.dep_dev, int(4 * config.cal_win_days * DAY_US)
    row, col = band_cells(F.col("lat"), F.col("lon"), 2 * half)
    names = ["evid", "ot_us", "lat", "lon", "dep", "stations", "is_temp"]
    cell = lambda x, size: F.floor(x / F.lit(float(size)))
    cand = records.select(*[F.col(c).alias(f"c_{c}") for c in names], row.alias("row"), col.alias("col"), cell(F.col("dep"), depth).alias("band"), cell(F.col("ot_us"), time).alias("slice"))
    reach = F.lit(half / KM_PER_DEGREE) / F.greatest(F.cos(F.radians("lat")), F.lit(1e-6)) * (1 + 1e-9)
    reach = F.least(reach, F.lit(360.0))
    north_reach = half / KM_PER_DEGREE * (1 + 1e-9)
    span = lambda x, d, size: F.explode(F.sequence(cell(x - d, size), cell(x + d, size)))
    ref = records.select(*names, span(F.col("lat"), north_reach, band_height(2 * half)).alias("row")).withColumn("width", band_width(F.col("row"), 2 * half))
    ref = ref.withColumn("col", F.explode(F.sequence(F.floor((F.col("lon") - reach) / F.col("width")), F.floor((F.col("lon") + reach) / F.col("width"))))).drop("width")
    ref = ref.withColumn("band", span(F.col("dep"), config.dep_dev, depth))
    ref = ref.withColumn("slice", span(F.col("ot_us"), int(config.cal_win_days * DAY_US), time))
    cos = F.cos(F.col("lat") * F.lit(3.141592653589793) / 180.0)
    north, east = KM_PER_DEGREE * F.abs(F.col("c_lat") - F.col("lat")), KM_PER_DEGREE * F.abs(F.col("c_lon") - F.col("lon")) * cos
    deep = F.abs(F.col("c_dep") - F.col("dep"))
    near = ref.join(cand, ["row", "col", "band", "slice"]).filter(
        (north < half) & (east < half) & (deep < config.dep_dev) & (F.abs(F.col("c_ot_us") - F.col("ot_us")) <= config.cal_win_days * DAY_US) & (F.col("is_temp") | F.col("c_is_temp"))
    )
    near = near.filter(F.size(F.array_intersect("stations", "c_stations")) >= config.num_sta)
    near = near.select(F.col("evid").alias("ref"), F.col("c_evid").alias("cand"), F.sqrt(north * north + east * east + deep * deep).alias("dist"))
    return near.withColumn("place", F.rank().over(W.partitionBy("ref").orderBy("dist"))).filter(F.col("place") <= config.max_nbr + 1)


def candidate_pairs(records: DataFrame, config: Config) -> DataFrame:
    """evid_a < evid_b: pairs that one of both events admits as a reference, each once."""
    edges = candidate_edges(records, config).filter("ref <> cand")
    return edges.select(F.least("ref", "cand").alias("evid_a"), F.greatest("ref", "cand").alias("evid_b")).distinct()


def station_pairs(pairs: DataFrame, records: DataFrame, stations: DataFrame, config: Config) -> DataFrame:
    """evid_a, evid_b, station, dist_a, dist_b: common stations of each pair that lie near either event and not too near
    both, of pairs that keep ``num_sta`` of them. A common station missing in ``stations`` is an error."""
    a = records.select(F.col("evid").alias("evid_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), F.col("stations").alias("st_a"))
    b = records.select(F.col("evid").alias("evid_b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), F.col("stations").alias("st_b"))
    common = pairs.join(a, "evid_a").join(b, "evid_b").withColumn("station", F.explode(F.array_intersect("st_a", "st_b"))).drop("st_a", "st_b")
    placed = common.join(stations.select("station", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon")), "station", "left")
    must = F.when(F.col("s_lat").isNotNull(), F.col("s_lat")).otherwise(F.raise_error(F.concat(F.lit("no such station: "), F.col("station"))).cast("double"))
    placed = placed.withColumn("s_lat", must)
    far = lambda k: ground_km(F.col("s_lat"), F.col("s_lon"), F.col(f"lat_{k}"), F.col(f"lon_{k}"), wrap=False)
    kept = placed.withColumns({"dist_a": far("a"), "dist_b": far("b")}).filter(
        (F.least("dist_a", "dist_b") <= config.dist_thres) & (F.greatest("dist_a", "dist_b") >= config.min_dist)
    )
    kept = kept.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("evid_a", "evid_b"))).filter(F.col("_n") >= config.num_sta)
    return kept.select("evid_a", "evid_b", "station", "dist_a", "dist_b")


def task_events(tasks: DataFrame, templates: DataFrame, quakes: DataFrame) -> DataFrame:
    """station, row_a, row_b, evid_a, evid_b of stored tasks: an index below 100 is a template's idx, else a quake's ord."""
    named = templates.select(F.col("idx").cast("long").alias("k"), "evid").unionByName(quakes.filter("ord >= 100").select(F.col("ord").alias("k"), "evid"))
    side = lambda s: named.select(F.col("k").alias(f"event_idx_{s}"), F.col("evid").alias(f"evid_{s}"))
    return tasks.join(side("a"), "event_idx_a").join(side("b"), "event_idx_b").select("station", "row_a", "row_b", "evid_a", "evid_b")
