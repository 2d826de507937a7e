"""Nested latitude-longitude cells and their distances.

Rows split the latitudes evenly; the number of columns halves from 60 degrees on each time the circles of latitude have
halved, so cells keep their width within a factor of two up to close by the poles. A cell of level l is four of level
l + 1. Only sums, products and comparisons are used, so NumPy and Spark name the same cell for a point.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from wavetide.functions.columns import KM_PER_DEGREE

#: Latitudes at which the circles of latitude have halved once, twice, ...
HALVED_AT = [math.degrees(math.acos(2.0**-j)) for j in range(1, 9)]
#: Relative room for rounding: a cell counts as inside or outside only if it is so by more than this.
ROOM = 1e-9


@dataclass(frozen=True)
class Cells:
    rows0: int
    levels: int = 1

    @staticmethod
    def of_km(side_km: float, levels: int = 1) -> Cells:
        """Cells whose coarsest level has sides of about ``side_km``."""
        return Cells(max(512, int(180.0 * KM_PER_DEGREE / side_km)), levels)

    @property
    def deepest(self) -> int:
        return self.levels - 1

    def columns(self, row, level: int):
        """Columns in ``row`` (NumPy) of a level."""
        row0 = np.asarray(row) >> level
        a, b = row0 * 180.0 / self.rows0 - 90.0, (row0 + 1) * 180.0 / self.rows0 - 90.0
        low = np.where((a < 0) & (b > 0), 0.0, np.minimum(np.abs(a), np.abs(b)))
        halved = sum((low >= t).astype(np.int64) for t in HALVED_AT)
        return ((2 * self.rows0) >> halved) << level

    def row_col(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Row and column at the deepest level of a point with a place."""
        rows = self.rows0 << self.deepest
        row = F.least(F.floor((lat + 90.0) * float(rows) / 180.0), F.lit(rows - 1))
        n = self.columns_of(row, self.deepest)
        return row, F.pmod(F.floor((lon + 180.0) * n / 360.0), n)

    def columns_of(self, row: Column, level: int) -> Column:
        """``columns`` of Spark's rows of a level."""
        row0 = F.shiftright(row, level)
        a, b = row0 * 180.0 / self.rows0 - 90.0, (row0 + 1) * 180.0 / self.rows0 - 90.0
        low = F.when((a < 0) & (b > 0), 0.0).otherwise(F.least(F.abs(a), F.abs(b)))
        halved = sum(((low >= t).cast("int") for t in HALVED_AT), F.lit(0))
        return F.call_function("shiftright", F.lit(2 * self.rows0).cast("long"), halved) * (1 << level)

    def bounds(self, row, col, level: int):
        """lat_lo, lat_hi, lon_mid, half_width of cells, in degrees."""
        rows = self.rows0 << level
        width = 360.0 / self.columns(row, level)
        return row * 180.0 / rows - 90.0, (row + 1) * 180.0 / rows - 90.0, (col + 0.5) * width - 180.0, width / 2

    def bounds_of(self, row: Column, col: Column, level: int) -> tuple[Column, Column, Column, Column]:
        """``bounds`` of Spark's cells."""
        rows = self.rows0 << level
        width = F.lit(360.0) / self.columns_of(row, level)
        return row * 180.0 / rows - 90.0, (row + 1) * 180.0 / rows - 90.0, (col + 0.5) * width - 180.0, width / 2


def distances(lat_lo, lat_hi, lon, half, lat_lo2, lat_hi2, lon2, half2):
    """Least and greatest ground distance in km between points of two boxes (degrees; a point is a box of no size)."""
    gap = np.maximum(np.maximum(lat_lo2 - lat_hi, lat_lo - lat_hi2), 0.0)
    reach = np.maximum(lat_hi2 - lat_lo, lat_hi - lat_lo2)
    apart = np.abs((lon2 - lon + 180.0) % 360.0 - 180.0)
    near, far = np.maximum(apart - half - half2, 0.0), np.minimum(apart + half + half2, 180.0)
    mid_lo, mid_hi = np.radians((lat_lo + lat_lo2) / 2), np.radians((lat_hi + lat_hi2) / 2)
    cos_least = np.maximum(np.minimum(np.cos(mid_lo), np.cos(mid_hi)), 0.0)
    cos_most = np.where((mid_lo < 0) & (mid_hi > 0), 1.0, np.maximum(np.cos(mid_lo), np.cos(mid_hi)))
    return KM_PER_DEGREE * np.hypot(cos_least * near, gap), KM_PER_DEGREE * np.hypot(cos_most * far, reach)


def distances_of(a: tuple[Column, ...], b: tuple[Column, ...]) -> tuple[Column, Column]:
    """``distances`` of Spark's boxes."""
    (lat_lo, lat_hi, lon, half), (lat_lo2, lat_hi2, lon2, half2) = a, b
    gap = F.greatest(lat_lo2 - lat_hi, lat_lo - lat_hi2, F.lit(0.0))
    reach = F.greatest(lat_hi2 - lat_lo, lat_hi - lat_lo2)
    apart = F.abs(F.pmod(lon2 - lon + 180.0, F.lit(360.0)) - 180.0)
    near, far = F.greatest(apart - half - half2, F.lit(0.0)), F.least(apart + half + half2, F.lit(180.0))
    mid_lo, mid_hi = F.radians((lat_lo + lat_lo2) / 2), F.radians((lat_hi + lat_hi2) / 2)
    cos_least = F.greatest(F.least(F.cos(mid_lo), F.cos(mid_hi)), F.lit(0.0))
    cos_most = F.when((mid_lo < 0) & (mid_hi > 0), 1.0).otherwise(F.greatest(F.cos(mid_lo), F.cos(mid_hi)))
    return KM_PER_DEGREE * F.hypot(cos_least * near, gap), KM_PER_DEGREE * F.hypot(cos_most * far, reach)


def band_gap(lo, hi, lo2, hi2):
    """Least and greatest difference between numbers of two ranges."""
    return np.maximum(np.maximum(lo2 - hi, lo - hi2), 0.0), np.maximum(hi2 - lo, hi - lo2)
