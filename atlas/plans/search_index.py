"""P1: the search index of a map package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.operators import filters, search
from atlas.operators.groups import dense_ids


def build_search_index(places: DataFrame, detail: DataFrame, bbox: tuple[float, float, float, float] | None,
                       places_zoom: int | None = 10, detail_zoom: int | None = 15) -> DataFrame:
    """Settlements from the overview tiles, streets and points of interest from the detail tiles, cut to
    the box by tile, one row per name and cell, numbered in search order: id, kind, name, …

    Both inputs are decoded tile features ``(layer, attrs, population, lat, lon[, z, x, y])``.
    """
    def cut(tiles: DataFrame, zoom: int | None) -> DataFrame:
        return tiles if bbox is None or zoom is None else filters.tile_window(tiles, bbox, zoom)

    columns = ["layer", "attrs", "population", "lat", "lon"]
    wanted = (cut(places, places_zoom).filter("layer = 'places'").select(*columns)
              .unionByName(cut(detail, detail_zoom).filter(F.col("layer").isin("roads", "pois")).select(*columns)))
    rows = search.place_rows(filters.search_row_filter(wanted))
    return dense_ids(rows, search.search_order(), "id")
