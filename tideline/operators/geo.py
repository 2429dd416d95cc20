"""Locations within a radius: around one point, or around every point of a table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import EARTH_RADIUS_M, great_circle_m
from tideline.operators.skew import MIN_SLICE_ROWS, SLICES_PER_PARTITION, heavy_groups, sliced_join
from tideline.schema import KEY

CELL = ("_band", "_cell")
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180.0
MIN_BLOCK_ROWS = 2_000  # pairs of this many centres and stations are not cut further
CHORD_SLACK = 1e-9  # of the unit sphere, 6 mm: far above what rounding does to a chord


def within_radius(
    stations: DataFrame, lat: float, lon: float, radius_m: float, *, product: str | None = None
) -> DataFrame:
    """Stations at most ``radius_m`` from the point, with ``distance_m``.

    The bounds of latitude and longitude are plain ranges on stored columns and reach the file scan; the exact distance
    decides. There is no bound of longitude where the circle meets a pole or the antimeridian.
    """
    margin = radius_m / METRES_PER_DEGREE * 1.000001 + 1e-9
    longitude = F.col("longitude")
    near = stations.where(F.col("latitude").between(lat - margin, lat + margin) & longitude.isNotNull())
    if abs(lat) + margin < 90.0:
        reach = math.degrees(math.asin(min(1.0, math.sin(math.radians(margin)) / math.cos(math.radians(lat)))))
        west, east = lon - reach * 1.000001 - 1e-9, lon + reach * 1.000001 + 1e-9
        if -180.0 <= west and east <= 180.0:  # longitudes outside the usual range are left to the distance
            near = near.where(longitude.between(west, east) | (longitude < -180.0) | (longitude > 180.0))
    if product is not None:
        near = near.where(F.col("product") == F.lit(product))
    distance = great_circle_m(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon))
    return near.withColumn("distance_m", distance).where(F.col("distance_m") <= F.lit(float(radius_m)))


def nearest(stations: DataFrame, lat: float, lon: float, radius_m: float, *, limit: int = 100) -> DataFrame:
    """The ``limit`` nearest stations within the radius; ties by entity and product."""
    return within_radius(stations, lat, lon, radius_m).orderBy("distance_m", "entity", "product").limit(limit)


class CellGrid:
    """Latitude bands one radius high, each cut into equal longitude cells at least one radius wide.

    The number of cells of a band follows from its widest-reaching latitude, so a circle touches three bands and a few
    cells of each, wherever it lies. Cells are counted around the globe (modulo), which covers the antimeridian; a band
    that reaches a pole is one cell.
    """

    def __init__(self, radius_m: float):
        self.reach_deg = radius_m / METRES_PER_DEGREE * 1.000001 + 1e-9
        self.bands = math.ceil(180.0 / self.reach_deg)

    def band(self, lat: Column) -> Column:
        raw = F.floor((lat + 90.0) / F.lit(self.reach_deg)).cast("int")
        return F.least(raw, F.lit(self.bands - 1))

    def cells_in(self, band: Column) -> Column:
        south = band * F.lit(self.reach_deg) - 90.0
        far = F.least(F.greatest(F.abs(south), F.abs(south + self.reach_deg)), F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(far)) * F.lit(360.0 / self.reach_deg)), F.lit(1)).cast("int")

    def assign(self, points: DataFrame) -> DataFrame:
        """Each point in its one cell: ``_band``, ``_cell``."""
        in_band = points.withColumn("_band", self.band(F.col("latitude")))
        count = self.cells_in(F.col("_band"))
        slot = F.floor((F.col("longitude") + 180.0) / 360.0 * count)
        return in_band.withColumn("_cell", F.pmod(slot, count).cast("int"))

    def cover(self, centres: DataFrame) -> DataFrame:
        """Each centre once per cell its circle can touch: ``_band``, ``_cell``."""
        middle = self.band(F.col("latitude"))
        bands = F.sequence(F.greatest(middle - 1, F.lit(0)), F.least(middle + 1, F.lit(self.bands - 1)))
        spread = centres.withColumn("_band", F.explode(bands)).withColumn("_count", self.cells_in(F.col("_band")))
        # widest longitude the circle reaches; a circle over a pole reaches all of them
        sine = F.lit(math.sin(math.radians(self.reach_deg))) / F.cos(F.radians("latitude"))
        reach = F.when(F.abs("latitude") + F.lit(self.reach_deg) >= 90.0, F.lit(180.0)).otherwise(
            F.degrees(F.asin(F.least(sine, F.lit(1.0)))) * 1.000001 + 1e-9
        )
        west = F.floor((F.col("longitude") - reach + 180.0) / 360.0 * F.col("_count"))
        east = F.floor((F.col("longitude") + reach + 180.0) / 360.0 * F.col("_count"))
        slots = F.sequence(west, F.least(east, west + F.col("_count") - 1))
        return (
            spread.withColumn("_slot", F.explode(slots))
            .withColumn("_cell", F.pmod("_slot", F.col("_count")).cast("int"))
            .drop("_slot", "_count")
        )


def _with_axes(points: DataFrame, lat: str, lon: str, mark: str) -> DataFrame:
    """Add the place on the unit sphere: ``mark`` + x, y, z."""
    phi, lam = F.radians(lat), F.radians(F.pmod(F.col(lon), F.lit(360.0)))
    return points.withColumns(
        {f"{mark}x": F.cos(phi) * F.cos(lam), f"{mark}y": F.cos(phi) * F.sin(lam), f"{mark}z": F.sin(phi)}
    )


def _within(distance: Column, radius_m: float) -> Column:
    """``distance <= radius_m``, decided by the squared chord alone but for a rim a few millimetres wide."""
    chord = 2 * math.sin(min(max(radius_m, 0.0) / EARTH_RADIUS_M / 2, math.pi / 2))
    squares = [(F.col(f"_s{a}") - F.col(f"_c{a}")) * (F.col(f"_s{a}") - F.col(f"_c{a}")) for a in "xyz"]
    squared = squares[0] + squares[1] + squares[2]
    surely, at_all = max(chord - CHORD_SLACK, 0.0) ** 2, (chord + CHORD_SLACK) ** 2
    return (squared <= F.lit(at_all)) & ((squared < F.lit(surely)) | (distance <= F.lit(float(radius_m))))


def _dense_cells(placed: DataFrame, around: DataFrame, tasks: int, min_rows: int) -> DataFrame:
    """Cells in which more pairs meet than a slice should hold: ``_left`` and ``_right``, the parts of each side.

    A slice holds at most one ``SLICES_PER_PARTITION``-th of a task's average pairs, so the list has a few rows per task.
    """
    met = placed.groupBy(*CELL).agg(F.count("*").alias("_stations")).join(
        around.groupBy(*CELL).agg(F.count("*").alias("_centres")), list(CELL)
    )
    met = met.withColumn("_pairs", F.col("_stations").cast("double") * F.col("_centres"))
    share = met.agg(F.sum("_pairs") / F.lit(float(SLICES_PER_PARTITION * tasks))).scalar()
    limited = met.withColumn("_limit", F.greatest(share, F.lit(float(min_rows) ** 2))).where("_pairs > _limit")
    rows = F.greatest(F.sqrt("_limit"), F.col("_limit") / F.col("_centres"))
    left = limited.withColumn("_left", F.ceil(F.col("_stations") / rows).cast("int"))
    return left.withColumn("_right", F.ceil(F.col("_pairs") / F.col("_left") / F.col("_limit")).cast("int"))


def radius_join(
    centres: DataFrame,
    stations: DataFrame,
    radius_m: float,
    *,
    centre_id: str = "code",
    spread_by: Sequence[str] = KEY,
    min_slice: int = MIN_SLICE_ROWS,
) -> DataFrame:
    """Every pair of centre and station at most ``radius_m`` apart: ``centre_id``, station columns, ``distance_m``.

    An equi-join on cells: each station is in one cell, each centre is repeated for the few cells its circle touches, so
    a pair meets exactly once and the candidates are within a small factor of the result. The result is quadratic where
    both sides are dense, so the work is dealt out by pairs, not by bytes: a cell that holds a large share of the stations,
    of the centres or of the pairs (a dense city) is cut into slices, and the slices are spread over at least four tasks a
    core. Candidates are told by their chord; the great circle is computed once per pair that is returned.
    """
    grid = CellGrid(radius_m)
    located = "latitude is not null and longitude is not null"
    placed = grid.assign(stations.where(located))
    around = grid.cover(centres.where(located).select(centre_id, "latitude", "longitude"))
    around = around.withColumnsRenamed({"latitude": "_lat", "longitude": "_lon"})
    spark = stations.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dense = _dense_cells(placed, around, tasks, min(min_slice, MIN_BLOCK_ROWS))

    def crowded(points: DataFrame, parts: str) -> DataFrame:
        by_rows = heavy_groups(points.groupBy(*CELL).agg(F.count("*").alias("_n")), CELL, "_n", min_rows=min_slice)
        by_pairs = dense.where(F.col(parts) > 1).select(*CELL, F.col(parts).alias("_slices"))
        return by_rows.unionByName(by_pairs).groupBy(*CELL).agg(F.max("_slices").alias("_slices"))

    distance = great_circle_m(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    return (
        sliced_join(
            _with_axes(placed, "latitude", "longitude", "_s"), _with_axes(around, "_lat", "_lon", "_c"), CELL,
            heavy_left=crowded(placed, "_left"), spread_left=spread_by,
            heavy_right=crowded(around, "_right"), spread_right=(centre_id,), tasks=tasks,
        )
        .where(_within(distance, radius_m))
        .withColumn("distance_m", distance)
        .drop("_lat", "_lon", *CELL, *[f"{mark}{a}" for mark in ("_s", "_c") for a in "xyz"])
    )
