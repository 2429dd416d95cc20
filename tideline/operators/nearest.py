"""The n nearest stations of every centre of a table.

Locations are points on the unit sphere, so a box needs no care at poles or at the antimeridian, and a straight chord grows
with the distance on the ground. Stations are laid into a tree of cubes: a cube with more than ``LEAF`` stations is cut
again, so leaves are small where stations are dense. Centres go down the tree together, one join a level. Of the cubes a
centre still has, those are let go whose nearest place is farther than the n-th station is at most (the sum of the
counts of the cubes, by their farthest place, tells how far). What is left are a few leaves around each centre, however
dense the place is, and only their stations are measured.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import EARTH_RADIUS_M, great_circle_m
from tideline.operators.skew import MIN_SLICE_ROWS, heavy_groups, sliced_join
from tideline.schema import KEY
from tideline.session import settle

LEAF = 64  # stations of a cube that is not cut again
BITS = 20  # of a coordinate: cubes of the last level are 12 m wide
STEP = 2  # bits from a level to the next
SLACK = 1e-9  # of a chord: 6 mm on the ground, above the millimetre that distances are compared in
AXES = ("_x", "_y", "_z")

#: fixed values: masks that spread 21 bits to every third bit
SPREAD = (
    (32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249),
)


def _on_sphere(points: DataFrame) -> DataFrame:
    """The points with a location, as ``_x, _y, _z`` on the unit sphere."""
    lat, lon = F.radians("latitude"), F.radians("longitude")
    known = "latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude)"
    return points.where(known).withColumns(
        {"_x": F.cos(lat) * F.cos(lon), "_y": F.cos(lat) * F.sin(lon), "_z": F.sin(lat)}
    )


def _cube() -> Column:
    """The number of a point's cube at the last level; shifted right by three bits a level it is the cube above."""
    found = F.lit(0).cast("long")
    for axis, name in enumerate(AXES):
        bits = F.least(F.floor((F.col(name) + 1.0) * (1 << BITS - 1)), F.lit((1 << BITS) - 1)).cast("long")
        for shift, mask in SPREAD:
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
        found = found.bitwiseOR(F.shiftleft(bits, axis))
    return found


def _upto(points: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n of the rows at one and the same point: no centre takes more of them."""
    place = Window.partitionBy("latitude", "longitude").orderBy(*order)
    return points.withColumn("_nth", F.row_number().over(place)).where(F.col("_nth") <= n).drop("_nth")


class _Tree:
    """Cubes per level (``nodes``) and the stations of the leaves (``placed``, by ``_level`` and ``_cell``)."""

    def __init__(self, spots: DataFrame, leaf: int, min_slice: int):
        self.nodes: list[tuple[int, DataFrame]] = []
        placed, left, level = [], spots, 0
        while True:
            cell = F.shiftright("_cube", 3 * (BITS - level))
            opened = left.withColumn("_cell", cell)
            sides = [s for a in AXES for s in (F.min(a).alias(f"{a}_low"), F.max(a).alias(f"{a}_high"))]
            last = level >= BITS
            made = opened.groupBy("_cell").agg(F.count("*").alias("_n"), *sides)
            nodes = settle(made.withColumn("_leaf", (F.col("_n") <= leaf) | F.lit(last)), "cubes")
            self.nodes.append((level, nodes))
            told = nodes.select("_cell", "_n", "_leaf")
            joined = sliced_join(
                opened, told, ["_cell"], heavy_left=heavy_groups(told, ["_cell"], "_n", min_rows=min_slice), spread_left=["_cube", *KEY]
            )
            placed.append(joined.where("_leaf").withColumn("_level", F.lit(level)).drop("_n", "_leaf"))
            if nodes.where("not _leaf").isEmpty():
                break
            left = settle(joined.where("not _leaf").drop("_n", "_leaf", "_cell"), "spots")
            level += STEP
        self.placed = reduce(DataFrame.unionByName, placed)


def _reach(rows: DataFrame) -> DataFrame:
    """Add the chords from a centre to the nearest and to the farthest place of a cube's stations."""
    near, far = F.lit(0.0), F.lit(0.0)
    for axis in AXES:
        at, low, high = F.col(axis), F.col(f"{axis}_low"), F.col(f"{axis}_high")
        near = near + F.pow(F.greatest(low - at, at - high, F.lit(0.0)), F.lit(2.0))
        far = far + F.pow(F.greatest(F.abs(at - low), F.abs(at - high)), F.lit(2.0))
    return rows.withColumns({"_near": F.sqrt(near), "_far": F.sqrt(far)}).drop(*[f"{a}_{s}" for a in AXES for s in ("low", "high")])


def _closed(cubes: DataFrame, n: int, radius: float | None) -> DataFrame:
    """The cubes that can hold one of the n nearest stations of their centre."""
    mine = Window.partitionBy("_spot")
    known = cubes.withColumn("_upto", F.sum("_n").over(mine.orderBy("_far").rangeBetween(Window.unboundedPreceding, 0)))
    ring = F.min(F.when(F.col("_upto") >= n, F.col("_far"))).over(mine)
    kept = known.withColumn("_ring", F.coalesce(ring, F.lit(2.0)))
    if radius is not None:
        kept = kept.withColumn("_ring", F.least("_ring", F.lit(radius)))
    return kept.where(F.col("_near") <= F.col("_ring") + SLACK).drop("_upto", "_ring")


def _descend(points: DataFrame, tree: _Tree, n: int, radius: float | None, min_slice: int) -> DataFrame:
    """(_spot, latitude, longitude, _level, _cell) of the leaves around each centre."""
    found = None
    open_cells = points.select("_spot", *AXES).withColumn("_cell", F.lit(0).cast("long"))
    for depth, (level, nodes) in enumerate(tree.nodes):
        if depth == 0:  # one row: the whole globe
            step = open_cells.join(F.broadcast(nodes), "_cell")
        else:
            heavy = heavy_groups(open_cells.groupBy("_cell").agg(F.count("*").alias("_c")), ["_cell"], "_c", min_rows=min_slice)
            below = nodes.withColumn("_below", F.col("_cell")).withColumn("_cell", F.shiftright("_cell", 3 * STEP))
            step = sliced_join(open_cells, below, ["_cell"], heavy_left=heavy, spread_left=["_spot"])
            step = step.drop("_cell").withColumnRenamed("_below", "_cell")
        step = _reach(step).withColumn("_level", F.lit(level))
        met = step if found is None else found.unionByName(step)
        kept = settle(_closed(met, n, radius), "rings")
        found, open_cells = kept.where("_leaf"), kept.where("not _leaf").select("_spot", *AXES, "_cell")
    return found.join(points.select("_spot", "latitude", "longitude"), "_spot").select(
        "_spot", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), "_level", "_cell"
    )


def nearest_join(
    centres: DataFrame,
    stations: DataFrame,
    n: int,
    *,
    centre_id: str = "code",
    radius_m: float | None = None,
    order: Sequence[str] = KEY,
    leaf: int = LEAF,
    min_slice: int = MIN_SLICE_ROWS,
) -> DataFrame:
    """The ``n`` nearest stations of every centre: ``centre_id``, ``rank`` (from 1), station columns, ``distance_m``.

    Distances are compared in whole millimetres, so rounding decides nothing; ties by ``order``, which should be total. With ``radius_m`` only stations at most that far
    count. A centre has fewer rows if there are fewer stations; centres and stations without a location take no part, a
    centre without any station has no row. Rows of ``centres`` are centres of their own, repeated ids too. The result
    has at most centres x n rows; the rows measured stay within a small multiple of that wherever the stations lie.
    """
    spots = settle(_on_sphere(_upto(stations, order, n)).withColumn("_cube", _cube()), "spots")
    located = _on_sphere(centres.select(F.col(centre_id).alias("_id"), "latitude", "longitude"))
    points = located.groupBy("latitude", "longitude").agg(F.count("*").alias("_many"), *[F.max(a).alias(a) for a in AXES])
    points = settle(points.withColumn("_spot", F.monotonically_increasing_id()), "points")
    tree = _Tree(spots, leaf, min_slice)
    radius = None if radius_m is None else 2 * math.sin(min(radius_m / EARTH_RADIUS_M / 2, math.pi / 2))
    leaves = _descend(points, tree, n, radius, min_slice)

    by = ["_level", "_cell"]
    heavy = heavy_groups(leaves.groupBy(*by).agg(F.count("*").alias("_c")), by, "_c", min_rows=min_slice)
    met = sliced_join(leaves, tree.placed.drop("_cube", *AXES), by, heavy_left=heavy, spread_left=["_spot"]).drop(*by)
    distance = great_circle_m(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    measured = met.withColumn("distance_m", distance).drop("_lat", "_lon")
    if radius_m is not None:
        measured = measured.where(F.col("distance_m") <= F.lit(float(radius_m)))
    millimetres = F.round(F.col("distance_m") * 1000).cast("long")
    rank = F.row_number().over(Window.partitionBy("_spot").orderBy(millimetres, *order))
    best = measured.withColumn("rank", rank).where(F.col("rank") <= n)

    ids = located.select("_id", "latitude", "longitude").join(
        points.select("_spot", "latitude", "longitude", "_many"), ["latitude", "longitude"]
    ).select("_spot", "_id", "_many")
    heavy = heavy_groups(points.select("_spot", "_many"), ["_spot"], "_many", min_rows=min_slice)
    return sliced_join(ids.drop("_many"), best, ["_spot"], heavy_left=heavy, spread_left=["_id"]).select(
        F.col("_id").alias(centre_id), "rank", *stations.columns, "distance_m"
    )
