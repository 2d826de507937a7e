"""Points near other points or regions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavetide.functions.cells import ROOM, Cells, band_gap, distances, distances_of
from wavetide.functions.columns import KM_PER_DEGREE, ground_km
from wavetide.session import durable

#: Cover rows that go out as a broadcast at most.
BROADCAST_ROWS = 400_000
#: Centres that are covered at a time within a task.
AT_ONCE = 100


def _counted(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place as often as its count says, and 0, 1, ... within each."""
    who = np.repeat(np.arange(len(count)), count)
    return who, np.arange(len(who)) - (np.cumsum(count) - count)[who]


def cover(cells: Cells, lat: np.ndarray, lon: np.ndarray, radius: float, bands: np.ndarray, band_km: float) -> pd.DataFrame:
    """who (the centre's place), level, row, col, band, inside: cells that cover the balls of ``radius`` km around centres at depth 0.

    Starts from the coarsest cells; a cell wholly within the ball is kept as inside, one on its surface is split in four,
    and at the deepest level kept as a boundary cell.
    """
    side = 180.0 / cells.rows0
    row_at = lambda d, more: np.clip(np.floor((lat + d * radius / KM_PER_DEGREE + 90.0) / side).astype(np.int64) + more, 0, cells.rows0 - 1)
    low = row_at(-1, -1)
    who, i = _counted(row_at(1, 1) - low + 1)
    row = low[who] + i
    lo, hi, _, half = cells.bounds(row, np.zeros_like(row), 0)
    cos = np.maximum(0.0, np.minimum(np.cos(np.radians((lat[who] + lo) / 2)), np.cos(np.radians((lat[who] + hi) / 2))))
    degrees = np.where(cos > 1e-6, radius / KM_PER_DEGREE / np.maximum(cos, 1e-6) + half, 360.0)
    n, m = cells.columns(row, 0), (degrees / (2 * half)).astype(np.int64) + 1
    first = np.where(2 * m + 1 >= n, 0, np.floor((lon[who] + 180.0) * n / 360.0).astype(np.int64) - m)
    of, i = _counted(np.minimum(2 * m + 1, n))
    who, row, col = who[of], row[of], (first[of] + i) % n[of]
    who, row, col, band = (*(np.repeat(x, len(bands)) for x in (who, row, col)), np.tile(bands, len(row)))
    kept = []
    for level in range(cells.levels):
        near, far = distances(lat[who], lat[who], lon[who], 0.0, *cells.bounds(row, col, level))
        up, down = band_gap(0.0, 0.0, band * band_km, (band + 1) * band_km)
        inside = np.hypot(far, down) <= radius * (1 - ROOM)
        edge = ~inside & (np.hypot(near, up) <= radius * (1 + ROOM))
        last = level == cells.deepest
        keep = inside | edge if last else inside
        kept.append(pd.DataFrame({"who": who[keep], "level": level, "row": row[keep], "col": col[keep], "band": band[keep], "inside": inside[keep]}))
        if not last:
            who, row, col, band = (np.repeat(x[edge], 4) for x in (who, row, col, band))
            row, col = 2 * row + np.tile([0, 0, 1, 1], len(row) // 4), 2 * col + np.tile([0, 1, 0, 1], len(col) // 4)
    return pd.concat(kept)


def points_in_balls(points: DataFrame, centres: DataFrame, radius: float, split: int = 4, levels: int = 3) -> DataFrame:
    """key, centre of all points (key, lat, lon, dep) within ``radius`` km, depth included, of a centre (centre, lat, lon).

    Adaptive coverage: each centre's ball is covered by nested cells and bands of depth (``cover``). Points meet the
    cover by an equi-join on cell and band; those in cells wholly inside the ball are taken at once, only those in
    boundary cells are measured. The cover is broadcast if it has at most BROADCAST_ROWS rows.

    Points and centres need a place; rows whose key, centre, lat, lon or dep is null or NaN, or whose lat or lon is
    out of range, match nothing. Repeated rows match each on their own; empty tables give no rows.
    """
    cells, band_km = Cells.of_km(radius, levels), radius / split
    bands = np.arange(-split, split + 1)

    def covers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for k in range(0, len(pdf), AT_ONCE):
                part = pdf.iloc[k : k + AT_ONCE]
                got = cover(cells, part.lat.to_numpy(), part.lon.to_numpy(), radius, bands, band_km)
                told = part.iloc[got.who.to_numpy()]
                yield got.assign(centre=told.centre.to_numpy(), c_lat=told.lat.to_numpy(), c_lon=told.lon.to_numpy())[["centre", "c_lat", "c_lon", "level", "row", "col", "band", "inside"]]

    centres = centres.filter("centre is not null and abs(lat) <= 90 and abs(lon) <= 180").select("centre", "lat", "lon")
    covered = centres.mapInPandas(covers, "centre string, c_lat double, c_lon double, level int, row long, col long, band long, inside boolean")
    covered = durable(covered)
    few = covered.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    row, col = cells.row_col(F.col("lat"), F.col("lon"))
    at = points.filter("key is not null and abs(lat) <= 90 and abs(lon) <= 180").filter(F.abs("dep") <= radius)
    at = at.select("key", "lat", "lon", "dep", row.alias("_row"), col.alias("_col"), F.floor(F.col("dep") / F.lit(band_km)).alias("band"))
    at = at.select(
        "key", "lat", "lon", "dep", "band",
        F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_row", cells.deepest - k).alias("row"), F.shiftright("_col", cells.deepest - k).alias("col")) for k in range(levels)])).alias("c"),
    ).select("key", "lat", "lon", "dep", "band", "c.*")
    near = at.join(F.broadcast(covered) if few else covered, ["level", "row", "col", "band"])
    km = ground_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    return near.filter(F.col("inside") | (F.sqrt(km * km + F.col("dep") * F.col("dep")) <= radius)).select("key", "centre")


def near_pairs(points: DataFrame, radius: float, within_us: int, finer: int = 3) -> DataFrame:
    """key_a, key_b (the smaller first) of all points within ``radius`` km, depth included, and ``within_us`` of each other.

    ``points``: key (unique), lat, lon, dep, t_us. The occupied cells (sides of ``radius`` / 2, bands of depth as high) are
    the regions. Each is listed under the coarse cells, 2 ** ``finer`` cells wide, that its surroundings within ``radius``
    reach ahead (the next rows; in its own row all columns), about three of them, and meets the occupied cells there by an
    equi-join. Pairs of cells are told apart as inside (all points near each other), boundary and far. Only the first two
    are expanded to points, by equi-joins on cell and slice of time; points in inside pairs are taken without measuring,
    those in boundary pairs are measured. A cell meets at most the cells of a few coarse ones, 8 ** ``finer`` each, so what
    is joined grows with the points and with the result. Runs of points in one cell and time are split by AQE's skew join.

    Rows with a null or NaN in any of these columns, or with lat or lon out of range, match nothing. Empty tables give no rows.
    """
    side = radius / 2
    cells = Cells.of_km(side * (1 << finer), finer + 1)
    row, col = cells.row_col(F.col("lat"), F.col("lon"))
    at = points.filter("key is not null and t_us is not null and abs(lat) <= 90 and abs(lon) <= 180 and abs(dep) < 1e9").select(
        "key", "lat", "lon", "dep", "t_us", row.alias("row"), col.alias("col"), F.floor(F.col("dep") / F.lit(side)).alias("band"), F.floor(F.col("t_us") / F.lit(2 * within_us)).alias("slice")
    )
    at = durable(at)  # used three times
    cell, b_cell = ["row", "col", "band"], ["b_row", "b_col", "b_band"]
    _, _, lon, half = cells.bounds_of(F.col("row"), F.col("col"), finer)
    fine = at.select(*cell).distinct().withColumns({"lon": lon, "half": half})
    # coarse rows and bands that lie within reach; the cells' own height is at least ``side``
    steps, rows = int(radius / side) + 1, cells.rows0 << finer
    lat_of = lambda r: r * 180.0 / rows - 90.0
    up_row = F.explode(F.sequence(F.shiftright("row", finer), F.shiftright(F.least(F.col("row") + steps, F.lit(rows - 1)), finer)))
    ahead = fine.withColumn("up_row", up_row)
    # columns of that coarse row: the reach in degrees where the circle of latitude is smallest
    far_lat = F.greatest(F.abs(lat_of(F.col("row"))), F.abs(lat_of(F.col("row") + 1)), F.abs(lat_of(F.col("row") + 1) + radius / KM_PER_DEGREE))
    cos = F.cos(F.radians(F.least(far_lat, F.lit(90.0))))
    degrees = F.least(F.when(cos > 1e-6, F.lit(radius * (1 + ROOM) / KM_PER_DEGREE) / cos).otherwise(180.0), F.lit(180.0)) + F.col("half")
    column = lambda x: F.floor((x + 180.0) * F.col("n") / 360.0)
    ahead = ahead.withColumns({"n": cells.columns_of(F.col("up_row"), 0), "reach": degrees})
    ahead = ahead.withColumns({"west": column(F.col("lon") - F.col("reach")), "east": column(F.col("lon") + F.col("reach"))})
    ahead = ahead.withColumn("up_col", F.explode(F.sequence("west", F.least(F.col("east"), F.col("west") + F.col("n") - 1))))
    ahead = ahead.withColumn("up_col", F.pmod("up_col", "n"))
    ahead = ahead.withColumn("up_band", F.explode(F.sequence(F.shiftright(F.col("band") - steps, finer), F.shiftright(F.col("band") + steps, finer))))
    # few bytes, but much to compare: a number of tasks that AQE leaves as it is
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ahead = ahead.select(*cell, "lon", "half", "up_row", "up_col", "up_band").repartition(parts, "up_row", "up_col", "up_band")
    held = fine.select(*[F.col(c).alias(f"b_{c}") for c in (*cell, "lon", "half")], *[F.shiftright(c, finer).alias(f"up_{c}") for c in cell])
    # each pair of cells once: from the lower row, within a row from the smaller column and band
    ahead_of = (F.col("b_row") > F.col("row")) | ((F.col("b_row") == F.col("row")) & (F.struct("b_col", "b_band") >= F.struct("col", "band")))
    close = (F.col("b_row") - F.col("row") <= steps) & (F.abs(F.col("b_band") - F.col("band")) <= steps) & ahead_of
    met = ahead.join(held, ["up_row", "up_col", "up_band"]).filter(close)
    box = lambda p: (lat_of(F.col(f"{p}row")), lat_of(F.col(f"{p}row") + 1), F.col(f"{p}lon"), F.col(f"{p}half"))
    near, far = distances_of(box(""), box("b_"))
    lo, lo2 = F.col("band") * side, F.col("b_band") * side
    up, down = F.greatest(lo2 - lo - side, lo - lo2 - side, F.lit(0.0)), F.greatest(lo2 + side - lo, lo + side - lo2)
    pairs = met.filter(F.hypot(near, up) <= radius * (1 + ROOM)).select(*cell, *b_cell, (F.hypot(far, down) <= radius * (1 - ROOM)).alias("inside"))

    # slices are twice as long as the time allowed, so each point meets two
    a = at.join(pairs, cell).withColumn("b_slice", F.explode(F.array(*[F.floor((F.col("t_us") + d) / F.lit(2 * within_us)) for d in (-within_us, within_us)])))
    a = a.drop("slice")
    b = at.select(*[F.col(c).alias(f"b_{c}") for c in cell], F.col("slice").alias("b_slice"), *[F.col(c).alias(f"b_{c}") for c in ("key", "lat", "lon", "dep", "t_us")])
    both = a.join(b, [*b_cell, "b_slice"])
    same = (F.col("row") == F.col("b_row")) & (F.col("col") == F.col("b_col")) & (F.col("band") == F.col("b_band"))
    km, apart = ground_km(F.col("lat"), F.col("lon"), F.col("b_lat"), F.col("b_lon")), F.col("dep") - F.col("b_dep")
    both = both.filter(F.abs(F.col("t_us") - F.col("b_t_us")) <= within_us).filter(~same | (F.col("key") < F.col("b_key")))
    both = both.filter(F.col("inside") | (F.sqrt(km * km + apart * apart) <= radius))
    return both.select(F.least("key", "b_key").alias("key_a"), F.greatest("key", "b_key").alias("key_b"))
