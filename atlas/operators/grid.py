"""Equi-join cells for distance predicates.

A grid is sized to one radius: whatever lies within the radius of a point is in the point's own cell
or one of its eight neighbours. Rows have equal height; the width of a column is set per row, so
neighbours are right at every latitude.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

M_PER_DEG_LAT = 110_540.0
M_PER_DEG_LON = 111_320.0
SLACK = 1.001


class Grid:
    def __init__(self, radius_m: float):
        self.height = radius_m * SLACK / M_PER_DEG_LAT
        self.reach = radius_m * SLACK / M_PER_DEG_LON

    def _row(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.height)).cast("bigint")

    def _width(self, row: Column) -> Column:
        poleward = F.least(F.lit(89.5), (F.abs(row) + 2) * F.lit(self.height))
        return F.lit(self.reach) / F.cos(F.radians(poleward))

    def _cell(self, row: Column, lon: Column, step: int = 0) -> Column:
        """Row and column in one number: a cheap join and grouping key."""
        col = F.floor(lon / self._width(row)).cast("bigint") + step
        return row * F.lit(1 << 32) + col

    def cell(self, lat: Column, lon: Column) -> Column:
        return self._cell(self._row(lat), lon)

    def around(self, lat: Column, lon: Column) -> Column:
        """The cell of the point and its neighbours, as an array."""
        row = self._row(lat)
        return F.array(*[self._cell(row + dy, lon, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])

    def corners(self, lat: Column, lon: Column, cells: int) -> list[tuple[Column, Column]]:
        """(lat, lon) of the corners of a box that reaches so many cells to each side of the point."""
        wide = F.lit(float(cells)) * self._width(F.abs(self._row(lat)) + cells)
        return [(lat + dy * cells * self.height, lon + dx * wide) for dy in (-1, 1) for dx in (-1, 1)]
