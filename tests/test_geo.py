"""Radius operators against brute force, edges of the globe and hot cells included."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.functions import great_circle_m
from tideline.operators import geo
from tideline.operators.nearest import nearest_join
from tideline.plans.comparator import UnknownCode, cheapest_around, lookup_code


def metres(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(min(h, 1)))


def globe(n, seed):
    rng = random.Random(seed)
    points = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]
    points += [(90 - rng.random(), rng.uniform(-180, 180)) for _ in range(n // 8)]
    points += [(rng.uniform(-60, 60), rng.choice((-180, 180)) * (1 - rng.random() / 300)) for _ in range(n // 8)]
    return points + [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (45.0, 0.0)]


def tables(spark, centres, stations):
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(centres)], "code int, latitude double, longitude double")
    right = spark.createDataFrame(
        [(str(i), "E10", *p) for i, p in enumerate(stations)],
        "entity string, product string, latitude double, longitude double",
    )
    return left, right


@pytest.mark.parametrize("radius_km", [40, 600, 5000])
def test_join_equals_brute_force(spark, radius_km):
    centres, stations = globe(60, 1), globe(200, 2)
    found = geo.radius_join(*tables(spark, centres, stations), radius_km * 1000.0, min_slice=5)
    pairs = [(r.code, int(r.entity)) for r in found.collect()]
    expected = {
        (i, j) for i, a in enumerate(centres) for j, b in enumerate(stations) if metres(a, b) <= radius_km * 1000
    }
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def test_hot_cell_is_sliced_and_whole(spark):
    """A third of the stations at one point: cut into many slices, no pair lost or doubled."""
    stations = [(45.0, 5.0)] * 300 + globe(600, 3)
    centres = [(45.01, 5.01), (45.0, 5.0), (10.0, 10.0)]
    left, right = tables(spark, centres, stations)
    found = geo.radius_join(left, right, 20_000.0, min_slice=20)
    per_code = {r.code: r.n for r in found.groupBy("code").agg(F.count("*").alias("n")).collect()}
    assert per_code == {0: 300, 1: 300}


def test_hot_cell_on_both_sides(spark):
    """Many centres and many stations in one place: both are sliced, every pair meets once."""
    stations = [(45.0, 5.0)] * 80 + globe(100, 4)
    centres = [(45.0, 5.0)] * 50 + globe(60, 5)
    found = geo.radius_join(*tables(spark, centres, stations), 5_000.0, min_slice=7)
    pairs = [(r.code, r.entity) for r in found.collect()]
    assert len(pairs) == len(set(pairs))
    expected = sum(metres(a, b) <= 5_000 for a in centres for b in stations)
    assert len(pairs) == expected >= 80 * 50


def test_join_work_is_dealt_by_pairs(spark):
    """Few bytes, many pairs: no task of the join puts out more than a small share of them."""
    stations = [(45.0 + i * 1e-5, 5.0) for i in range(400)]
    centres = [(45.0, 5.0 + i * 1e-5) for i in range(300)]
    found = geo.radius_join(*tables(spark, centres, stations), 20_000.0, min_slice=20)
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 300 * 400 and max(per_task) < 0.5 * sum(per_task)


def test_dense_cells_are_cut_on_the_side_that_needs_it(spark):
    def cells(sizes):
        rows = [(0, cell) for cell, n in enumerate(sizes) for _ in range(n)]
        return spark.createDataFrame(rows, "_band int, _cell int")

    dense = geo._dense_cells(cells([300, 1, 900, 5]), cells([300, 900, 1, 5]), 4, 10)
    cut = {r._cell: (r._left, r._right) for r in dense.collect()}
    limit = (300 * 300 + 900 + 900 + 25) / 16
    assert set(cut) == {0} and cut[0][0] > 1 and cut[0][1] > 1
    assert math.ceil(300 / cut[0][0]) * math.ceil(300 / cut[0][1]) <= limit * 1.1
    few = geo._dense_cells(cells([1, 900]), cells([900, 1]), 4, 10)
    assert {r._cell: (r._left, r._right) for r in few.collect()} == {0: (1, 8), 1: (8, 1)}


def test_rim_of_the_radius(spark):
    """Radii a hair's breadth either side of a station's distance, and longitudes counted past the antimeridian."""
    places = globe(40, 6) + [(45.0, 725.0), (10.0, -365.0)]
    left, right = tables(spark, [(45.0, 5.0)], places)
    told = right.select("entity", great_circle_m(F.lit(45.0), F.lit(5.0), F.col("latitude"), F.col("longitude")).alias("m"))
    away = {r.entity: r.m for r in told.collect()}
    for radius in (10.0, sorted(away.values())[5], math.nextafter(sorted(away.values())[20], 0), 3e7):
        found = geo.radius_join(left, right, radius)
        expected = {k: m for k, m in away.items() if m <= radius}
        assert {r.entity: r.distance_m for r in found.collect()} == expected


def test_sliced_join_equals_plain_join(spark):
    from tideline.operators.skew import heavy_groups, sliced_join

    left = spark.range(900).selectExpr("if(id % 3 = 0, null, id % 50) as k", "id as a")
    right = spark.range(300).selectExpr("if(id % 4 = 0, null, id % 70) as k", "id as b")

    def heavy(table):
        return heavy_groups(table.groupBy("k").count(), ["k"], "count", min_rows=5)

    found = sliced_join(
        left, right, ["k"],
        heavy_left=heavy(left), spread_left=["a"], heavy_right=heavy(right), spread_right=["b"],
    )
    same = F.col("l.k").eqNullSafe(F.col("r.k"))
    expected = left.alias("l").join(right.alias("r"), same).select("l.k", "a", "b")
    assert found.select("k", "a", "b").exceptAll(expected).count() == 0
    assert found.count() == expected.count()


def test_heavy_list_is_bounded(spark):
    from tideline.operators.skew import heavy_groups

    counts = spark.range(5000).selectExpr("id as k", "id * id as n")
    heavy = heavy_groups(counts, ["k"], "n", share=0.01, min_rows=1).collect()
    assert len(heavy) <= 100 and sum(r._slices for r in heavy) <= 200


def brute_nearest(centres, stations, n, radius=math.inf):
    rows = set()
    for i, a in enumerate(centres):
        found = sorted((metres(a, b), str(j)) for j, b in enumerate(stations))
        rows |= {(i, rank, entity) for rank, (m, entity) in enumerate(found[:n], 1) if m <= radius}
    return rows


def nearest_rows(spark, centres, stations, n, **how):
    found = nearest_join(*tables(spark, centres, stations), n, **how)
    return found, sorted((r.code, r.rank, r.entity) for r in found.collect())


def apart(points, seed):
    """The points, each moved by some metres, so that no two distances tie by rounding."""
    rng = random.Random(seed)
    return [(max(-90.0, min(90.0, a + rng.uniform(-1e-4, 1e-4))), b + rng.uniform(-1e-4, 1e-4)) for a, b in points]


@pytest.mark.parametrize(("n", "leaf"), [(1, 64), (5, 4), (20, 1), (300, 8)])
def test_nearest_join_equals_brute_force(spark, n, leaf):
    centres, stations = globe(40, 6), apart(globe(150, 7), 8)
    _, rows = nearest_rows(spark, centres, stations, n, leaf=leaf, min_slice=5)
    assert len(rows) == len(set(rows)) and set(rows) == brute_nearest(centres, stations, n)


def test_nearest_join_within_a_radius(spark):
    centres, stations = globe(30, 9), apart(globe(150, 10), 11)
    _, rows = nearest_rows(spark, centres, stations, 4, radius_m=900_000.0, leaf=3)
    assert set(rows) == brute_nearest(centres, stations, 4, 900_000) and len(rows) < 4 * len(centres)


def test_nearest_join_of_a_city_dense_on_both_sides(spark):
    """Thousands of centres and stations in one place: centres x n rows, and few stations measured per centre."""
    rng = random.Random(12)
    stations = [(45 + rng.gauss(0, 0.02), 5 + rng.gauss(0, 0.02)) for _ in range(3000)] + [(45.0, 5.0)] * 500
    centres = [(45 + rng.gauss(0, 0.02), 5 + rng.gauss(0, 0.02)) for _ in range(2000)] + [(45.0, 5.0)] * 700 + [(46.5, 5.0)] * 300
    found, rows = nearest_rows(spark, centres, stations, 3, leaf=16, min_slice=50)
    assert len(rows) == 3 * len(centres) == len(set(rows))
    picked = rng.sample(range(2000), 40) + [2000, 2699, 2700]
    expected = brute_nearest([centres[i] for i in picked], stations, 3)
    mine = {(picked.index(c), rank, e) for c, rank, e in rows if c in picked}
    assert mine == expected
    found.collect()
    most = max(rows_of_plan(found._jdf.queryExecution().executedPlan()))
    assert most < 50 * len(centres) < len(centres) * len(stations) / 50


def rows_of_plan(node):
    """Rows that each operator of an executed plan put out."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return rows_of_plan(node.executedPlan())
    found = []
    if node.metrics().contains("numOutputRows"):
        found.append(node.metrics().apply("numOutputRows").value())
    if hasattr(node, "plan") and name.endswith("QueryStageExec"):
        return found + rows_of_plan(node.plan())
    children = node.children()
    for i in range(children.size()):
        found += rows_of_plan(children.apply(i))
    return found


def test_nearest_join_without_rows_and_locations(spark):
    left, right = tables(spark, [(45.0, 5.0), (None, 5.0)], [(45.1, 5.0), (45.0, None), (float("nan"), 1.0)])
    assert [(r.code, r.entity) for r in nearest_join(left, right, 3).collect()] == [(0, "0")]
    assert nearest_join(left.where("false"), right, 3).count() == 0
    assert nearest_join(left, right.where("false"), 3).count() == 0
    again = nearest_join(left.unionAll(left), right, 3)
    assert [(r.code, r.rank) for r in again.collect()] == [(0, 1), (0, 1)]


def test_distances_at_46_north(spark):
    """T8: 0.13 degrees east and 0.09 degrees north are both about 10 km."""
    points = spark.createDataFrame([(46.0, 2.13), (46.09, 2.0)], "lat double, lon double")
    found = [r[0] for r in points.select(great_circle_m(F.col("lat"), F.col("lon"), F.lit(46.0), F.lit(2.0))).collect()]
    assert found == pytest.approx([metres((46, 2.13), (46, 2)), metres((46.09, 2), (46, 2))])
    assert all(9_900 < x < 10_200 for x in found)


def predictions(spark):
    columns = (
        "entity string, product string, price double, predicted_price double, predicted_delta double, trend string, "
        "latitude double, longitude double, postal_code string, city string, address string"
    )
    def row(entity, product, price, lat, lon):
        return (entity, product, price, price, 0.0, "stable", lat, lon, "69300", "Lyon", "1 rue A")

    return spark.createDataFrame(
        [
            row("a", "E10", 1.8, 45.80, 4.85), row("b", "E10", 1.7, 45.81, 4.85), row("c", "E85", 0.9, 45.80, 4.85),
            row("d", "E10", 1.1, 47.0, 4.85), row("e", "E10", 1.0, None, 4.85),
        ],
        columns,
    )


def communes(spark):
    return spark.createDataFrame(
        [("Sathonay", "69300", 45.82, 4.87), ("Caluire", "69300", 45.79, 4.84), ("Lyon", "69001", 45.76, 4.83)],
        "commune string, code string, latitude double, longitude double",
    )


def test_cheapest_around(spark):
    found = cheapest_around(spark, communes(spark), predictions(spark), code="69300", product="E10", radius_km=10)
    assert [r.entity for r in found.collect()] == ["b", "a"]


def test_lookup_is_total_and_bound(spark):
    """T18, P10: first commune by name; the code is a value, never text of the query."""
    assert lookup_code(spark, communes(spark), "69300").first().commune == "Caluire"
    assert lookup_code(spark, communes(spark), "x' or '1'='1").first() is None
    with pytest.raises(UnknownCode):
        cheapest_around(spark, communes(spark), predictions(spark), code="00000", product="E10", radius_km=10)


def test_nearest_is_ordered_and_limited(spark):
    found = geo.nearest(predictions(spark), 45.80, 4.85, 50_000.0, limit=2)
    assert [r.entity for r in found.collect()] == ["a", "c"]


@pytest.mark.parametrize("code", ["", "6930", "693000", "69300\n", "abcde", "' or 1=1"])
def test_malformed_code(spark, code):
    with pytest.raises(UnknownCode):
        cheapest_around(spark, communes(spark), predictions(spark), code=code, product="E10", radius_km=10)


@pytest.mark.parametrize("lat, lon", [(46.0, 2.0), (0.0, 179.9), (0.0, -179.9), (89.9, 10.0), (-60.0, 179.0), (70.0, -100.0)])
@pytest.mark.parametrize("radius", [500.0, 50_000.0, 400_000.0])
def test_longitude_bound_loses_nothing(spark, lat, lon, radius):
    """Around the centre in rings just inside and outside the radius, longitudes also given a turn further."""
    rows = spark.range(2000).selectExpr(
        "string(id) as entity", "'E10' as product",
        f"greatest(-90D, least(90D, {lat}D + cos(id) * {radius}D / 111195D * (0.5 + id % 11 / 10D))) as latitude",
        f"{lon}D + sin(id) * {radius}D / 111195D / greatest(0.01D, cos(radians({lat}D))) * (0.5 + id % 7 / 6D)"
        " + if(id % 5 = 0, 360, 0) as longitude",
    )
    everywhere = rows.where(great_circle_m(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon)) <= F.lit(radius))
    found = geo.within_radius(rows, lat, lon, radius)
    assert found.count() == everywhere.count() > 0
