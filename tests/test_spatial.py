"""Nearest joins, polygons, rasters, tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.functions import columns as x
from emberline.operators import spatial as s
from emberline.schema import CATEGORIES, HOT_CATEGORIES, M_LON, M_PER_DEG

BOXES = "key long, category string, name string, latitude double, longitude double, min_lat double, min_lon double, max_lat double, max_lon double"


def sites(spark, points):
    return spark.createDataFrame([(i, 0, float(a), float(b)) for i, (a, b) in enumerate(points)], "cell_lat int, cell_lon int, latitude double, longitude double")


def box(key, category, lat, lon, half=0.0):
    return key, category, f"n{key}", lat, lon, lat - half, lon - half, lat + half, lon + half


@pytest.mark.parametrize("most", [1000, 0])
def test_nearest_boxes_against_numpy(spark, most):
    rng = np.random.default_rng(5)
    boxes = [box(i, CATEGORIES[i % 10], float(rng.uniform(20, 24)), float(rng.uniform(75, 79)), float(rng.choice([0, 0.01, 0.6]))) for i in range(200)]
    points = [(float(a), float(b)) for a, b in rng.uniform((20, 75), (24, 79), (40, 2))]
    got = {r.cell_lat: r for r in s.nearest_boxes(sites(spark, points), spark.createDataFrame(boxes, BOXES), most=most).collect()}
    for i, (la, lo) in enumerate(points):
        for c in CATEGORIES:
            own = [b for b in boxes if b[1] == c]
            if not own:
                assert got[i][f"d_{c}"] == float("inf")
                continue
            near = sorted(own, key=lambda b: (np.hypot((la - b[3]) * M_PER_DEG, (lo - b[4]) * M_LON), b[0]))[:8]
            dist = [np.hypot(max(b[5] - la, la - b[7], 0) * M_PER_DEG, max(b[6] - lo, lo - b[8], 0) * M_LON) for b in near]
            assert got[i][f"d_{c}"] == pytest.approx(min(dist), abs=1e-6)
            if c == "mining":
                assert got[i].name_mining == near[int(np.argmin(dist))][2]


@pytest.mark.parametrize("most", [1000, 0])
def test_far_centroid_of_a_big_box_is_not_seen(spark, most):
    """The true nearest box has the ninth centroid: only eight are looked at."""
    boxes = [box(i, "mining", 20.0 + i / 100, 75.0) for i in range(1, 9)] + [box(9, "mining", 21.0, 75.0, 1.0)]
    r = s.nearest_boxes(sites(spark, [(20.0, 75.0)]), spark.createDataFrame(boxes, BOXES), ["mining"], [], most=most).first()
    assert r.d_mining == pytest.approx(0.01 * M_PER_DEG)


def test_buckets_with_many_boxes(spark):
    """Far more boxes than go to the executors, one category with few: exact, and no plan that grows with the rounds."""
    rng = np.random.default_rng(8)
    lat, lon = rng.uniform(10, 30, 50_000), rng.uniform(70, 90, 50_000)
    boxes = [box(i, "mining", float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))] + [box(90_000, "kiln", 29.0, 89.0)]
    points = [(float(a), float(b)) for a, b in rng.uniform((8, 68), (32, 92), (60, 2))]
    got = s.nearest_boxes(sites(spark, points), spark.createDataFrame(boxes, BOXES), ["mining", "kiln"], ["mining"])
    rows = {r.cell_lat: r for r in got.collect()}
    for i, (la, lo) in enumerate(points):
        far = np.hypot((la - lat) * M_PER_DEG, (lo - lon) * M_LON)
        assert rows[i].d_mining == pytest.approx(far.min(), abs=1e-6) and rows[i].name_mining == f"n{far.argmin()}"
        assert rows[i].d_kiln == pytest.approx(np.hypot((la - 29) * M_PER_DEG, (lo - 89) * M_LON), abs=1e-6)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 3


def test_rings_are_rounded_and_small_ones_go(spark):
    ring = lambda size, by=0.0001: [{"lon": a * size + by, "lat": b * size + by} for a, b in ((0, 0), (0.5, 0.00001), (1, 0), (1, 1), (0, 1), (0, 0))]
    df = spark.createDataFrame([([ring(0.001), ring(1.0), ring(2.0)],)], "rings array<array<struct<lon:double,lat:double>>>")
    kept = df.select(x.kept_rings(F.col("rings"), 0.01, 2).alias("r")).first().r
    assert [len(r) for r in kept] == [6, 6] and kept[0][3] == (2.0, 2.0) and kept[1][3] == (1.0, 1.0)
    flat = df.select(x.rounded_ring(F.col("rings")[0], 1).alias("r")).first().r
    assert flat is None


def test_local_time(spark):
    r = spark.sql("SELECT TIMESTAMP '2025-01-01 20:45:00' AS t").select(x.local_time(F.col("t")).cast("string").alias("t")).first()
    assert r.t == "2025-01-02 02:15:00"


def test_box_distance(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (3.0, 4.0)], "a double, b double")
    got = [r.d for r in df.select(x.box_metres("a", "b", F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0)).alias("d")).collect()]
    assert got == pytest.approx([0, 0, M_PER_DEG, np.hypot(M_PER_DEG, 2 * M_LON)])


def test_first_hot_category_wins_ties(spark):
    df = spark.createDataFrame([(5.0, 5.0), (float("inf"), float("inf"))], "d_refinery double, d_kiln double").withColumns({f"d_{c}": F.lit(float("inf")) for c in HOT_CATEGORIES if c not in ("refinery", "kiln")})
    assert [(r.d_industrial_hot, r.nearest_hot_category) for r in s.with_hot(df).collect()] == [(5.0, "refinery"), (float("inf"), "refinery")]


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]


def test_polygon_boundary_is_outside(spark):
    shape = s.edges_of(spark, [("a", [SQUARE, [(1, 1), (2, 1), (2, 2), (1, 2)]])])
    pts = [(3, 3), (0, 0), (0, 2), (4, 4), (5, 1), (1.5, 1.5), (1, 1.5)]
    got = {(r.latitude, r.longitude): r.f for r in s.flag_inside(sites(spark, pts), shape, "f").collect()}
    assert [got[p] for p in [tuple(map(float, p)) for p in pts]] == [True, False, False, False, False, False, False]
    assert s.flag_inside(sites(spark, pts), None, "f").first().f is None


@pytest.mark.parametrize("most", [100, 0])
def test_first_polygon_wins(spark, most):
    shapes = s.edges_of(spark, [("a", [SQUARE]), ("b", [[(2, 2), (6, 2), (6, 6), (2, 6)]])])
    got = s.first_polygon(sites(spark, [(3, 3), (5, 5), (9, 9)]), shapes, ["cell_lat", "cell_lon"], most=most)
    assert sorted((r.cell_lat, r.state) for r in got.collect()) == [(0, 0), (1, 1), (2, -1)]


@pytest.mark.parametrize("shape", [(12, 12), (15, 10)])
def test_box_sums_mirror_the_edges(spark, shape):
    a = np.random.default_rng(1).integers(-3, 50, shape)
    rows = [(int(i), int(j), float(a[i, j])) for i in range(shape[0]) for j in range(shape[1])]
    got = s.box_sums(spark.createDataFrame(rows, "row int, col int, value double"), *shape).collect()
    p = np.pad(np.maximum(a, 0), 4, mode="symmetric")
    assert {(r.row, r.col): r.value for r in got} == {(i, j): float(p[i : i + 9, j : j + 9].sum()) for i in range(shape[0]) for j in range(shape[1])}


def test_raster_corners_are_clipped(spark):
    raster = spark.createDataFrame([(i, j, float(10 * i + j)) for i in range(3) for j in range(3)], "row int, col int, value double")
    got = s.sample_raster(sites(spark, [(30, 70), (10, 90), (20.95, 75.05)]), raster, 75.0, 21.0, 0.1, 0.1, 3, 3, "v").collect()
    assert {r.cell_lat: r.v for r in got} == {0: 0.0, 1: 22.0, 2: 0.0}


def test_tiles(spark):
    names = [r.t for r in spark.createDataFrame([(23.7, 86.4), (-0.1, -0.1), (0.0, 180.0)], "a double, b double").select(x.tile_name("a", "b").alias("t")).collect()]
    assert names == ["ESA_WorldCover_10m_2021_v200_N21E084_Map.tif", "ESA_WorldCover_10m_2021_v200_S03W003_Map.tif", "ESA_WorldCover_10m_2021_v200_N00E180_Map.tif"]
    grid = [tuple(r) for r in s.tile_grid(spark, 0.0, 0.0, 5.0, 3.0, 2.0).orderBy("south", "west").collect()]
    assert grid[0] == (0.0, 0.0, 2.0, 2.0) and grid[-1] == (2.0, 4.0, 3.0, 5.0) and len(grid) == 6


def test_ring_measures(spark):
    ring = [{"lon": float(a), "lat": float(b)} for a, b in [*SQUARE, SQUARE[0]]]
    r = spark.createDataFrame([(ring,)], "ring array<struct<lon:double,lat:double>>").select(x.ring_area(F.col("ring")).alias("a"), x.ring_centroid(F.col("ring")).alias("c")).first()
    assert r.a == 16.0 and (r.c.lon, r.c.lat) == (2.0, 2.0)


def test_sites_are_not_shuffled_by_the_polygon_lookup(spark):
    df = s.first_polygon(sites(spark, [(1, 1)]), s.edges_of(spark, [("a", [SQUARE])]), ["cell_lat"])
    assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
