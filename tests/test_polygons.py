import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift.functions.scores import rounded
from skysift.functions.utm import reprojected
from skysift.operators import polygons as po
from skysift.sources import vectors

RING = "array<struct<x:double,y:double>>"


def leaning(rng):
    o, u, v = rng.integers(0, 12, 2), rng.integers(1, 6, 2), rng.integers(1, 6, 2) * (-1, 1)
    ring = [o, o + u, o + u + v, o + v][:: rng.choice((1, -1))]
    return [tuple(map(float, p)) for p in ring]


def apart(a, b):
    """Whether an axis parts two convex rings."""
    for ring in (a, b):
        for e in np.roll(ring, -1, 0) - ring:
            x, y = a @ (-e[1], e[0]), b @ (-e[1], e[0])
            if x.max() < y.min() or y.max() < x.min():
                return True
    return False


def inside(ring, x, y):
    """Even-odd rule on arrays."""
    odd = np.zeros(x.shape, bool)
    for (x0, y0), (x1, y1) in zip(ring, np.roll(ring, -1, 0), strict=True):
        if y0 != y1:
            odd ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return odd


def test_convex_rings_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, leaning(rng), leaning(rng)) for i in range(200)]
    a, b = F.col("a"), F.col("b")
    got = spark.createDataFrame(rows, f"i int, a {RING}, b {RING}").select("i", po.rings_meet(a, b).alias("meet"), po.shared_area(a, b).alias("area"), po.ring_iou(a, b).alias("iou"), po.ring_iou(a, a).alias("own")).collect()
    x, y = np.meshgrid(np.arange(-8, 24, 0.05) + 0.025, np.arange(-2, 24, 0.05) + 0.025)
    for (_, p, q), r in zip(rows, got, strict=True):
        p, q = np.array(p), np.array(q)
        assert r.meet == (not apart(p, q))
        both, either = (inside(p, x, y) & inside(q, x, y)).sum() * 0.0025, (inside(p, x, y) | inside(q, x, y)).sum() * 0.0025
        assert r.area == pytest.approx(both, abs=0.2)
        assert r.iou == pytest.approx(both / either, abs=0.05)
        assert r.own == pytest.approx(1)


def test_hollow_rings_and_boundaries(spark):
    """A U-shaped ring does not meet what lies in its bay; corners, edges and rings within rings meet."""
    bay = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (6.0, 9.0), (6.0, 3.0), (3.0, 3.0), (3.0, 9.0), (0.0, 9.0)]
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    cases = [(square(4.0, 5.0, 1.0), False), (square(3.0, 3.0, 1.0), True), (square(9.0, 9.0, 1.0), True), (square(1.0, 1.0, 1.0), True), (square(-5.0, -5.0, 50.0), True), (square(9.5, 0.0, 1.0), False), ([(4.5, 6.0)], False), ([(3.0, 6.0)], True), ([(1.0, 6.0)], True)]
    other = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)] + [(98, []), (99, None)], f"id int, ring {RING}")
    pairs = po.polygon_pairs(spark.createDataFrame([(bay,)], f"ring {RING}"), other)
    assert sorted(r.r_id for r in pairs.collect()) == [i for i, (_, meets) in enumerate(cases) if meets]


def test_rings_only_meet_within_their_keys(spark):
    one = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    det = spark.createDataFrame([(1, 1, one), (2, 2, one)], f"det_id int, raster_id int, ring {RING}")
    feet = spark.createDataFrame([(1, one)], f"raster_id int, ring {RING}")
    assert [r.det_id for r in po.confirmed_polygons(det, feet, keys=("raster_id",)).collect()] == [1]
    assert {r.det_id for r in po.confirmed_polygons(det, feet).collect()} == {1, 2}


def crowd(spark):
    """60 leaning rings, and 40 others twenty times each; and which of the first meet one of the others."""
    rng = np.random.default_rng(8)
    a = [(i, "tent" if i % 3 else "road", [(x + 60 * (i % 2), y) for x, y in leaning(rng)]) for i in range(60)]
    b = [leaning(rng) for _ in range(3)]
    meets = {i for i, _, p in a if any(not apart(np.array(p), np.array(q)) for q in b)}
    return spark.createDataFrame(a, f"det_id int, label string, ring {RING}"), spark.createDataFrame([(q,) for q in b * 20], f"ring {RING}"), meets


def test_confirming_rings_makes_no_pairs(spark):
    det, feet, meets = crowd(spark)
    found = po.confirmed_polygons(det, feet)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2 and "Join Inner" not in plan
    assert 0 < len(meets) < 60 and {r.det_id for r in found.collect()} == meets


def test_dry_rings_make_no_pairs(spark):
    det, water, meets = crowd(spark)
    dry = po.dry_polygons(det, water, ["tent"])
    plan = dry._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "Join LeftAnti" in plan and "Join Inner" not in plan
    assert {r.det_id for r in dry.collect()} == {i for i in range(60) if i % 3 == 0 or i not in meets}


def test_boxes_are_tested_as_boxes(spark):
    """Small whole numbers, so that many rings only touch a side or a corner, or have no area; the result is that of the test of any two rings."""
    rng = np.random.default_rng(11)
    point = lambda: tuple(map(float, rng.integers(0, 9, 2)))
    low, side = rng.integers(0, 8, (40, 2)), rng.integers(0, 5, (40, 2))
    boxes = spark.createDataFrame([(i, *map(float, (*a, *(a + d)))) for i, (a, d) in enumerate(zip(low, side, strict=True))], "det_id int, xmin double, ymin double, xmax double, ymax double")
    hollow = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (7.0, 8.0), (7.0, 1.0), (1.0, 1.0), (1.0, 8.0), (0.0, 8.0)]
    rings = spark.createDataFrame([(i, [point() for _ in range(1 + i % 4 % 3)]) for i in range(60)] + [(60, hollow)], f"ring_id int, ring {RING}")
    b = tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    both = boxes.crossJoin(rings).withColumns({"quick": po.meets_box(F.col("ring"), b), "any": po.rings_meet(po.box_ring(b), F.col("ring"))})
    assert both.filter("quick <> any").count() == 0 < both.filter("quick").count() < both.count()
    det = boxes.withColumn("ring", po.box_ring(b))
    met = {r.det_id for r in both.filter("any and ring_id % 9 = 0").select("det_id").distinct().collect()}
    some = rings.filter("ring_id % 9 = 0")
    assert {r.det_id for r in po.confirmed_polygons(det, some).collect()} == met and 0 < len(met) < 40
    # The box on the other side, and rings that are boxes by other first points or turned about, which take the general test.
    held = {r.ring_id for r in both.filter("any and det_id < 2").select("ring_id").distinct().collect()}
    for feet in (det, det.withColumn("ring", F.reverse("ring")), det.withColumn("ring", F.concat(F.slice("ring", 2, 3), F.slice("ring", 1, 1)))):
        assert {r.ring_id for r in po.confirmed_polygons(rings, feet.filter("det_id < 2"), id_col="ring_id").collect()} == held
    plan = po.confirmed_polygons(det, rings)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN l___boxed" in plan


def test_layer_is_suppressed_typed_and_written(spark, tmp_path):
    at = lambda x: [(x, 0.0), (x + 10, 5.0), (x + 5, 15.0), (x - 5, 10.0)]
    rows = [(1, "building", 0.9, at(0.0)), (2, "building", 0.8, at(1.0)), (3, "building", 0.7, at(2.0)), (4, "building", 0.6, at(40.0)), (5, "tent", 0.5, at(0.0)), (6, "tent", 0.4, at(0.0))]
    det = spark.createDataFrame(rows, f"det_id int, label string, confidence double, ring {RING}").withColumns({"source_raster": F.lit("s.tif"), "tile_filename": F.lit("t.tif")})
    layer = po.detection_layer(det, prompt="tent", acquired="2024-01-01")
    assert sorted(r.confidence for r in layer.collect()) == [0.4, 0.5, 0.6, 0.9]
    path = vectors.write_layer(layer, str(tmp_path / "d.gpkg"), srs=32636)
    assert sqlite3.connect(path).execute("SELECT count(*), min(prompt_used), min(acquisition_date) FROM detections").fetchone() == (4, "tent", "2024-01-01")
    back = vectors.read_gpkg(spark, path, "detections", "label string").withColumn("ring", vectors.from_wkb(F.col("geom"))).collect()
    assert sorted((r.label, len(r.ring)) for r in back) == [("building", 4), ("building", 4), ("tent", 1), ("tent", 1)]
    assert vectors.write_layer(layer.limit(0), str(tmp_path / "none.gpkg")) is None


def test_rings_change_their_reference_system(spark):
    df = spark.createDataFrame([([(30.5, 50.25), (31.0, -50.5)],)], f"ring {RING}")
    there = df.withColumn("ring", reprojected(F.col("ring"), F.lit(4326), F.lit(32636)))
    back = there.select(reprojected(F.col("ring"), F.lit(32636), F.lit(4326)).alias("r")).first().r
    assert [tuple(p) for p in back] == [pytest.approx((30.5, 50.25)), pytest.approx((31.0, -50.5))]
    assert df.select(reprojected(F.col("ring"), F.lit(4326), F.lit(4326)) == F.col("ring")).first()[0]


def test_rounding_is_of_the_stored_value(spark):
    values = [136.575, 128.425, 134.925, 129.525, 136.975, 0.125, 0.375, -136.575, 2.0, 1e9 / 7]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select(rounded(F.col("v"), 2).alias("r")).collect()
    assert [r.r for r in got] == [round(v, 2) for v in values]
