"""Invariants and hand-computed cases of the operators."""

import itertools
import json
import re
import sqlite3

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skysift.functions import boxes, scores
from skysift.functions.utm import to_utm
from skysift.operators import catalog, change, detections, evaluation, raster, spatial, suppression, tiling
from skysift.sources import adapters, geotiff, prompts, synthetic, vectors
from skysift.streaming import incidents

DET = "det_id long, raster_id long, label string, xmin double, ymin double, xmax double, ymax double, confidence double"


def det(spark, rows):
    return spark.createDataFrame([(i, 0, *r) for i, r in enumerate(rows)], DET)


def ids(df):
    return sorted(r.det_id for r in df.select("det_id").collect())


def test_suppression_is_idempotent_and_leaves_no_overlap(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(200):
        x, y, w = rng.uniform(20, 300), rng.uniform(20, 300), rng.uniform(10, 60)
        rows.append(("a", x, y, x + w, y + w, round(rng.uniform(0.3, 1), 2)))
    df = det(spark, rows)
    kept = suppression.suppress(df, penalise=False)
    assert ids(suppression.suppress(kept, penalise=False)) == ids(kept)
    assert ids(suppression.suppress_by_rounds(df, penalise=False)) == ids(kept)
    b = np.array([[r.xmin, r.ymin, r.xmax, r.ymax] for r in kept.collect()])
    for i, k in itertools.combinations(range(len(b)), 2):
        assert suppression.pair_iou(b[i], b[k]) <= 0.45


def test_rounds_decide_long_chains(spark):
    rows = [("a", 20.0 + 3 * i, 20.0, 30.0 + 3 * i, 30.0, 0.99 - 0.001 * i) for i in range(210)]  # each box overlaps the next one only
    assert ids(suppression.suppress_by_rounds(det(spark, rows), penalise=False)) == list(range(0, 210, 2))


def test_rounds_refuse_repeated_ids(spark):
    rows = [(0, 0, "a", 20.0, 20.0, 30.0, 30.0, 0.9), (0, 0, "a", 21.0, 20.0, 31.0, 30.0, 0.8)]
    with pytest.raises(ValueError):
        suppression.suppress_by_rounds(spark.createDataFrame(rows, DET), penalise=False)


def test_soft_suppression_by_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [("a", x, y, x + 30, y + 30, s) for x, y, s in zip(rng.uniform(20, 120, 60).tolist(), rng.uniform(20, 120, 60).tolist(), rng.uniform(0.3, 1, 60).tolist(), strict=True)]
    got = {r.det_id: r.decayed for r in suppression.soft_suppress(det(spark, rows)).collect()}
    b, s = np.array([r[1:5] for r in rows]), np.array([r[5] for r in rows])
    seam = ((b % 512)[:, :2] <= 8).any(1) | ((b % 512)[:, 2:] >= 504).any(1)
    s = np.where(seam, s * 0.7, s)
    live, want = {i for i in range(60) if s[i] >= 0.25}, {}
    while live:
        i = max(live, key=lambda k: (s[k], -k))
        live.remove(i)
        want[i] = s[i]
        for k in live:
            s[k] *= np.exp(-(suppression.pair_iou(b[i], b[k]) ** 2) / 0.5)
    want = {i: v for i, v in want.items() if v >= 0.25}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_soft_scores_of_many_boxes():
    """Pairs apart from all others, by the heap: the worse of each pair decays, and nothing else."""
    i = np.arange(20000)
    low = np.stack([i % 400 * 20, i // 400 * 20], 1).astype(float)
    boxes, scores = np.hstack([low, low + 12]), 0.3 + i * 7919 % 71 / 100
    boxes[1::2] = boxes[::2] + 4  # each second box over the one before
    got = suppression.soft_scores(boxes, scores, i, 0.25, lambda overlap: np.exp(-(overlap**2) / 0.5))
    pair = np.exp(-(float(suppression.pair_iou(boxes[0], boxes[1])) ** 2) / 0.5)
    first = scores[::2] >= scores[1::2]
    want = np.where(np.repeat(first, 2) == (i % 2 == 0), scores, scores * pair)
    assert np.allclose(got, want)


def test_fusion_of_two_models(spark):
    df = det(spark, [("a", 0.0, 0.0, 10.0, 10.0, 0.8), ("a", 1.0, 0.0, 11.0, 10.0, 0.6), ("a", 50.0, 50.0, 60.0, 60.0, 0.5)]).withColumn("model_source", F.when(F.col("det_id") == 1, "grounding_dino").otherwise("florence2"))
    rows = {r.anchor: r for r in suppression.fuse_boxes(df).collect()}
    w = 0.6 * 1.2 / (0.8 + 0.6 * 1.2)
    assert set(rows) == {0, 2} and rows[0].consensus_models == 2
    assert abs(rows[0].xmin - w) < 1e-9 and abs(rows[0].confidence - 0.8 * 1.15) < 1e-9 and rows[2].confidence == 0.5


def test_zero_area_anchor_keeps_its_cluster(spark):
    df = det(spark, [("a", 5.0, 5.0, 5.0, 5.0, 0.9)]).withColumn("model_source", F.lit("florence2"))
    assert suppression.fuse_boxes(df).count() == 1


@given(st.integers(1, 5), st.integers(0, 3), st.randoms(use_true_random=False))
@settings(max_examples=40, deadline=None)
def test_assignment_is_optimal(n, extra, random):
    cost = np.array([[random.random() for _ in range(n + extra)] for _ in range(n)])
    got = evaluation.assignment(cost)
    best = min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n + extra), n))
    assert abs(cost[np.arange(n), got].sum() - best) < 1e-9


@given(st.integers(1, 12), st.integers(1, 12), st.randoms(use_true_random=False))
@settings(max_examples=60, deadline=None)
def test_sparse_matching_is_optimal(n, m, random):
    side = lambda: random.randint(0, 9)
    make = lambda k: np.array([[x, y, x + side(), y + side()] for x, y in ((random.randint(0, 20), random.randint(0, 20)) for _ in range(k))], float)
    gt, pred = make(n), make(m)
    overlap = np.stack([suppression.pair_iou(g[None, :], pred) for g in gt])
    got = evaluation.match(gt, pred)
    flat = overlap if n <= m else overlap.T
    best = flat[np.arange(len(flat)), evaluation.assignment(1 - flat)].sum()
    assert sum(x for *_, x in got) == pytest.approx(best) and all(overlap[i, j] == x > 0 for i, j, x in got)
    assert len({i for i, _, _ in got}) == len({j for _, j, _ in got}) == len(got)


def crowded(spark, n, labels=("a",)):
    """(gt, pred): n boxes on a square, and each moved by two pixels."""
    i = F.col("id")
    x, y = (i * 7919) % 3907, (i * 6421) % 3911
    at = lambda d: spark.range(n).select((2 * i + d).alias("det_id"), F.lit(0).cast("long").alias("raster_id"), F.element_at(F.array(*map(F.lit, labels)), (i % len(labels) + 1).cast("int")).alias("label"), *[(v + 2 * d).cast("double").alias(c) for v, c in ((x, "xmin"), (y, "ymin"), (x + 8 + (i * 31) % 92, "xmax"), (y + 8 + (i * 17) % 92, "ymax"))])
    return at(0), at(1)


def test_large_groups_are_matched_without_a_dense_table(spark):
    """Of one group of 12,000 and 12,000 boxes a dense table has 1.2 GB; the overlaps take a few MB."""
    import tracemalloc

    gt, pred = (np.array([r[3:] for r in d.collect()]) for d in crowded(spark, 12000))
    tracemalloc.start()
    got = evaluation.match(gt, pred)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(i, j) for i, j, _ in got] == [(i, i) for i in range(12000)] and peak < 400e6


def test_overlaps_of_a_dense_group_take_a_few_bytes_each():
    """Memory stays with the overlaps, about 190 a box: blocks of candidates are small, and the rows of the pairs aren't kept."""
    import tracemalloc

    rng = np.random.default_rng(5)
    low = rng.integers(0, 600, (2, 6000, 2)).astype(float)
    gt, pred = np.concatenate([low, low + rng.integers(8, 100, low.shape)], 2)
    tracemalloc.start()
    first, columns, ious = evaluation.overlaps(gt, pred)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first[-1] == len(columns) == len(ious) > 500_000 and peak < 24 * len(columns) + 30e6
    for i in range(0, 6000, 500):
        at = evaluation.pair_iou(gt[i], pred)
        assert columns[first[i] : first[i + 1]].tolist() == np.nonzero(at > 0)[0].tolist()
        assert ious[first[i] : first[i + 1]].tolist() == at[at > 0].tolist()


def test_pairs_of_a_group_are_arrays(spark):
    """No list of tuples is made for a group: `match` is for callers that want one."""
    gt, pred = crowded(spark, 300)
    boxes = [np.array([r[3:] for r in d.collect()]) for d in (gt, pred)]
    rows, columns, ious = evaluation.matched(*boxes)
    assert [a.dtype.kind for a in (rows, columns, ious)] == ["i", "i", "f"]
    assert evaluation.match(*boxes) == list(zip(rows.tolist(), columns.tolist(), ious.tolist(), strict=True)) and len(rows) == 300
    assert evaluation.match(boxes[0][:0], boxes[1]) == evaluation.match(boxes[0], boxes[1][:0]) == []
    found = {r.gt_id: (r.pred_id, r.iou) for r in evaluation.matches(gt, pred).collect()}
    ids = [[r.det_id for r in d.collect()] for d in (gt, pred)]
    assert found == {ids[0][i]: (ids[1][j], x) for i, j, x in zip(rows.tolist(), columns.tolist(), ious.tolist(), strict=True)}


@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 30), st.sampled_from([1, 2, 5]), st.randoms(use_true_random=False))
@settings(max_examples=60, deadline=None)
def test_overlaps_left_out_are_found_where_they_matter(n, m, span, most, random):
    make = lambda k: np.array([[x, y, x + random.randint(0, 12), y + random.randint(0, 12)] for x, y in ((random.randint(0, span), random.randint(0, span)) for _ in range(k))], float)
    gt, pred = make(n), make(m)
    assert evaluation.heaviest(evaluation.Overlaps(gt, pred), most)[0][-1] <= most * n
    assert all(map(np.array_equal, evaluation.matched(gt, pred, most), evaluation.matched(gt, pred, m)))


def test_matching_of_a_dense_group_does_not_hold_its_overlaps():
    """Of 4 million overlaps 16 a box are held: the peak is 22 MB, and was 84 MB with all of them."""
    import tracemalloc

    rng = np.random.default_rng(5)
    low = rng.integers(0, 600, (12000, 2)).astype(float)
    gt = np.concatenate([low, low + rng.integers(8, 100, low.shape)], 1)
    tracemalloc.start()
    rows, columns, ious = evaluation.matched(gt, gt + 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(evaluation.overlaps(gt, gt + 1)[1]) > 4_000_000
    assert len(set(rows)) == len(set(columns)) == 12000 and peak < 50e6
    assert ious.sum() >= suppression.pair_iou(gt, gt + 1).sum() - 1e-6


def test_places_of_different_labels_match(spark, tmp_path):
    """Events 24 and 262129 are boxes of one raster and two labels with an IoU of 0.57."""
    from oracle import TABLES, same
    from skysift import catalogue

    for t in TABLES:
        spark.createDataFrame([(24,), (262129,)], "event_id long").coalesce(1).write.parquet(str(tmp_path / f"{t}.parquet"))
    found = {name: catalogue.queries()[name](spark, str(tmp_path)) for name in ("eval_report", "eval_location_only")}
    assert [(r.tp, r.fp, r.fn) for r in found["eval_location_only"].collect()] == [(1, 0, 0)]
    assert sorted((r.tp, r.fp, r.fn) for r in found["eval_report"].collect()) == [(0, 0, 1), (0, 1, 0)]
    for name, df in found.items():
        same(df, catalogue.oracle_sql()[name], str(tmp_path))


def test_report_of_a_large_class(spark):
    gt, pred = crowded(spark, 9000, ("a", "b", "c"))
    pairs = evaluation.matches(gt, pred)
    assert {(r["class"], r.tp + r.fn, r.fp + r.tp) for r in evaluation.report(gt, pred, pairs).collect()} == {(c, 3000, 3000) for c in "abc"}
    every = evaluation.report(*map(evaluation.location_only, (gt, pred, pairs))).collect()
    assert [(r["class"], r.tp + r.fn, r.tp) for r in every] == [("object", 9000, pairs.filter("iou >= 0.5").count())] and pairs.count() == 9000


def test_report_of_known_objects(spark):
    gt = synthetic.ground_truth(spark).select(F.monotonically_increasing_id().alias("det_id"), F.lit(0).cast("long").alias("raster_id"), "label", "xmin", "ymin", "xmax", "ymax")
    pred = gt.filter("label != 'trench'")
    r = {x["class"]: x for x in evaluation.report(gt, pred, evaluation.matches(gt, pred)).collect()}
    assert r["tent"].precision == r["tent"].recall == r["tent"].map_50_95 == 1.0 and r["tent"].tp == 3
    assert r["trench"].recall == 0.0 and r["trench"].fn == 1


def test_post_processing_traps(spark):
    df = det(spark, [(" Tent ", 0.0, 0.0, 20.0, 20.0, 0.5), ("x", 20.0, 20.0, 0.0, 0.0, 0.5), ("x", 0.0, 0.0, 200.0, 10.0, 0.5), ("x", 0.0, 0.0, 20.0, 20.0, None)])
    assert detections.map_labels(df, {"tent": "shelter"}).first().label == "shelter"
    assert ids(detections.above_class_threshold(df, {})) == [0, 1, 2]
    assert 2 not in ids(detections.plausible_shape(df)) and 0 in ids(detections.plausible_shape(df))
    small = det(spark, [("x", 0.1, 0.1, 0.5, 0.5, 0.5), ("x", 0.1, 0.1, 0.5, 2.0, 0.5)])
    assert detections.denormalise(small).first().xmax == 0.5  # one box above 1 decides for all
    assert detections.denormalise(small.limit(1)).first().xmax == 256.0


def test_platt_fit_has_no_gradient(spark):
    rng = np.random.default_rng(3)
    s = rng.uniform(0, 1, 400)
    y = (rng.uniform(0, 1, 400) < 1 / (1 + np.exp(-(4 * s - 2)))).astype(int)
    a, b = detections.fit_platt(spark.createDataFrame([(float(i), int(k)) for i, k in zip(s, y, strict=True)], "s double, y int"), "s", "y")
    p = 1 / (1 + np.exp(-(a * s + b)))
    assert abs(((p - y) * s).mean()) < 1e-6 and abs((p - y).mean()) < 1e-6


def test_grid_join_equals_nested_loop_and_avoids_it(spark):
    rng = np.random.default_rng(4)
    make = lambda n: spark.createDataFrame([(i, *map(float, (x, y, x + w, y + w))) for i, (x, y, w) in enumerate(zip(rng.uniform(-900, 900, n), rng.uniform(-900, 900, n), rng.uniform(0, 500, n), strict=True))], "det_id long, xmin double, ymin double, xmax double, ymax double")
    a, b = make(60), make(60)
    pairs = spatial.overlapping_pairs(a, b)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted((r.l_det_id, r.r_det_id) for r in pairs.collect())
    want = sorted((p.det_id, q.det_id) for p in a.collect() for q in b.collect() if p.xmin <= q.xmax and q.xmin <= p.xmax and p.ymin <= q.ymax and q.ymin <= p.ymax)
    assert got == want


def test_confirming_makes_no_pairs(spark):
    """Boxes over many equal and unequal footprints: one semi-join by cells, the same answer as by brute force."""
    rng = np.random.default_rng(7)
    make = lambda n, i0=0: [(i0 + i, *map(float, (x, y, x + w, y + w))) for i, (x, y, w) in enumerate(zip(rng.integers(-900, 900, n), rng.integers(-900, 900, n), rng.integers(0, 300, n), strict=True))]
    schema = "det_id long, xmin double, ymin double, xmax double, ymax double"
    a, b = make(150), make(12)
    found = spatial.confirmed(spark.createDataFrame(a, schema), spark.createDataFrame(b * 20, schema).drop("det_id"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2 and "Join Inner" not in plan
    assert ids(found) == [p[0] for p in a if any(p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4] for q in b)]


def test_touching_counts_and_share_flag(spark):
    d = det(spark, [("a", 0.0, 0.0, 10.0, 10.0, 0.5)])
    f = spark.createDataFrame([(10.0, 0.0, 20.0, 10.0)], "xmin double, ymin double, xmax double, ymax double")
    assert ids(spatial.confirmed(d, f)) == [0]
    assert ids(spatial.confirmed(d, f, least_share=0.1)) == []


def test_no_anchor_drops_all_targets(spark):
    d = det(spark, [("vehicle", 0.0, 0.0, 1.0, 1.0, 0.5), ("tent", 0.0, 0.0, 1.0, 1.0, 0.5)])
    assert ids(spatial.near_anchor(d, "vehicle", "compound", 10)) == [1]


def test_few_rows_are_not_discounted(spark):
    d = det(spark, [("a", 0.0, 0.0, 2.0, 2.0, 0.5)] * 3)
    assert all(r.discounted == 0.5 for r in spatial.density_discount(d).collect())
    assert all(r.lof != r.lof or r.lof is None for r in spatial.outlier_factor(d, ["xmin"], ["label"]).collect())


def test_utm_of_a_textbook_point(spark):
    # 500000 E on the central meridian; the equator is 0 N.
    p = spark.createDataFrame([(33.0, 0.0, 32636), (33.0, 45.0, 32636)], "lon double, lat double, epsg int")
    e, n = to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))
    a, b = p.select(e.alias("e"), n.alias("n")).collect()
    assert abs(a.e - 500000) < 1e-6 and abs(a.n) < 1e-6 and abs(b.n - 4982950.400) < 0.01


def test_chip_and_rebuild_is_identity(spark):
    px = spark.createDataFrame([(0, r, c, (r * 7 + c) % 50 + 1) for r in range(30) for c in range(41)], "raster_id long, row long, col long, value long")
    back = raster.mosaic(raster.tile_pixels(px, 16, 12))
    assert back.exceptAll(px).count() == 0 and px.exceptAll(back).count() == 0


def test_padding_against_numpy(spark):
    a = np.arange(12).reshape(3, 4)
    px = spark.createDataFrame([(0, r, c, int(a[r, c])) for r in range(3) for c in range(4)], "raster_id long, row long, col long, value long")
    for mode in ("reflect", "edge", "constant"):
        got = np.zeros((7, 7), int)
        for r in raster.padded(px, 7, mode=mode).collect():
            got[r.row, r.col] = r.value
        assert (got == np.pad(a, ((0, 4), (0, 3)), mode=mode)).all()
    assert raster.cropped(raster.padded(px, 7)).count() == 12


def test_change_regions(spark):
    grid = np.zeros((12, 12))
    grid[2:8, 2:8] = 0.9
    grid[4, 4] = 0.0  # a hole counts into the area
    grid[9, 9] = 0.9
    cells = spark.createDataFrame([(0, r, c, int(grid[r, c] > 0.5), float(grid[r, c])) for r in range(12) for c in range(12)], "pair_id long, row long, col long, value int, change double")
    (r,) = change.change_polygons(cells).collect()
    assert (r.xmin, r.ymin, r.xmax, r.ymax, r.area) == (2, 2, 8, 8, 36) and r.confidence == 0.9
    assert change.change_polygons(cells, least_area=1).count() == 2


def test_series_of_one_step_is_left_out(spark):
    s = spark.createDataFrame([(1, 0, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 0, [1.0, 0.0])], "site_id long, seq long, embedding array<double>")
    rows = {(r.site_id, r.seq): r.status for r in change.series_status(s).collect()}
    assert rows == {(1, 0): "baseline", (1, 1): "altered/destroyed"}
    assert change.event_window(change.series_status(s)).first().event_window == "0 to 1"


def test_unknown_metric_is_an_error():
    with pytest.raises(ValueError):
        scores.similarity(None, None, "hamming")


def test_catalogue_times(spark):
    rows = [("a_20240102T030405.tif", None), ("b_2024-01-02_999999.tif", None), ("c.tif", '{"datetime": "2020-01-01T00:00:00"}'), ("d.tif", None)]
    df = spark.createDataFrame(rows, "filename string, side string")
    got = [r.t for r in df.select(catalog.acquisition_time(F.col("filename"), F.col("side")).alias("t")).collect()]
    assert got == ["2024-01-02T03:04:05+00:00", "2024-01-02T00:00:00+00:00", "2020-01-01T00:00:00", None]


def test_numbers_before_the_date_of_a_name(spark):
    names = ["spot7_1234_20240105.tif", "s1_hh_12345_20240106.tif", "a_110105_20240107.tif", "b_1012_2024-01-08.tif", "c_9999_20240109T101112.tif", "d_2024_0110.tif", "e_1234_99999999.tif", "f_20230101123456_20240105.tif"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, filename string")
    got = [r.t for r in df.select(catalog.acquisition_time(F.col("filename")).alias("t")).collect()]
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]
    assert got == [f"{d}T00:00:00+00:00" for d in days] + ["2024-01-09T10:11:12+00:00", "2024-01-10T00:00:00+00:00", None, "2023-01-01T00:00:00+00:00"]


def test_search_passes_unreadable_times(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0, "Area", "SAR"), (2, 0.0, 0.0, 2.0, 2.0, "2020-01-01", "SAR"), (3, 1.0, 1.0, 3.0, 3.0, "2024-01-01", "SAR")], "scene_id long, xmin double, ymin double, xmax double, ymax double, ts string, modality string")
    got = [(r.scene_id, r.buffer_coverage_pct) for r in catalog.search(s, (0, 0, 2, 2), start="2023-01-01", modality="sar").collect()]
    assert got == [(1, 100.0), (3, 25.0)]


def test_geotiff_round_trip_and_scan(spark, tmp_path):
    rng = np.random.default_rng(5)
    bands = rng.integers(0, 255, (3, 20, 30)).astype(np.uint8)
    content = geotiff.encode(bands, [0.5, 0.0, 500000.0, 0.0, -0.5, 5300000.0], 32636, 0)
    assert (geotiff.read_bands(content) == bands).all()
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "WV03_20240105.TIF").write_bytes(content)
    (tmp_path / "bad.tif").write_bytes(b"no")
    h = geotiff.scan(spark, str(tmp_path)).collect()
    assert len(h) == 1 and h[0].epsg == 32636 and h[0].width == 30 and h[0].nodata == 0
    c = geotiff.catalogue(geotiff.scan(spark, str(tmp_path))).first()
    assert c.provider == "Vantor / Maxar" and c.xmax == 500015.0 and c.ymin == 5299990.0 and c.ts.startswith("2024-01-05")
    px = geotiff.long_pixels(geotiff.read_pixels(spark, str(tmp_path / "sub")))
    assert px.filter("band = 1 and row = 3 and col = 4").first().value == bands[1, 3, 4]
    tile = geotiff.encoded_tiles(px.select(F.lit(7).alias("tile"), "band", "row", "col", "value"), "tile", [1.0, 0, 0, 0, -1.0, 0], 4326).first()
    assert (geotiff.read_bands(bytes(tile.content)) == bands).all()


def test_lzw():
    # 9-bit codes: clear, 'a', 'b', the entry 'ab', end.
    codes = [256, 97, 98, 258, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert geotiff._lzw(data) == b"abab"


def test_vector_files(spark, tmp_path):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (1, 0), (1, 1))])
    df = spark.range(3).select("id", F.concat(F.lit("n"), "id").alias("name"), ring.alias("ring"))
    path = vectors.write_gpkg(df.select("id", "name", vectors.to_wkb(F.col("ring")).alias("geom")), str(tmp_path / "a.gpkg"), "layer")
    back = vectors.read_gpkg(spark, path, "layer", "id long, name string").orderBy("id").collect()
    assert [r.name for r in back] == ["n0", "n1", "n2"] and vectors.read_wkb(bytes(back[0].geom)) == [(0, 0), (1, 0), (1, 1)] and back[0].srs == 4326
    assert vectors.write_gpkg(df.limit(0).select(F.lit(None).cast("binary").alias("geom")), str(tmp_path / "none.gpkg"), "x") is None
    vectors.write_geojson(df, str(tmp_path / "a.json"))
    g = json.loads((tmp_path / "a.json").read_text())
    assert len(g["features"]) == 3 and g["features"][0]["geometry"]["coordinates"][0][-1] == [0, 0]
    for _ in range(2):
        vectors.write_sqlite(df.select(F.col("id").alias("scene"), "name"), str(tmp_path / "a.db"), "t", "name")
    assert sqlite3.connect(tmp_path / "a.db").execute("select count(*) from t").fetchone() == (3,)


def test_resumed_run_is_a_no_op(spark, tmp_path):
    tiles = spark.createDataFrame([(f"t{i}",) for i in range(20)], "filename string")
    assert adapters.run_pending(tiles, str(tmp_path / "r"), "stub", ["tent", "vehicle"]) == 20
    assert adapters.run_pending(tiles, str(tmp_path / "r"), "stub", ["tent", "vehicle"]) == 0
    found = spark.read.parquet(str(tmp_path / "r/detections"))
    have, missing = adapters.collected(tiles, found)
    assert have.count() == found.count() and missing.count() == 20 - found.select("filename").distinct().count()


def test_unknown_tile_is_an_error(spark):
    d = spark.createDataFrame([("a",)], "filename string")
    with pytest.raises(Exception, match="unknown tile"):
        adapters.unknown_tiles(d, d.limit(0)).collect()


def test_prompts(spark, tmp_path):
    prompts.save(prompts.targets(spark), str(tmp_path / "c"))
    assert prompts.load(spark, str(tmp_path / "c")).count() == 8
    new = spark.createDataFrame([(" Tents ", "p", ["s"], 0.1, 0.1)], prompts.SCHEMA)
    up = prompts.upsert_target(prompts.targets(spark), new)
    assert up.count() == 8 and up.filter("target = 'tents'").first().primary_prompt == "p"
    got = spark.range(1).select(prompts.dotted_prompt(F.array(F.lit("a"), F.lit("b."))).alias("p")).first().p
    assert got == "a . b."


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = incidents.incident_rate(stream).writeStream.outputMode("complete").format("memory").queryName("rates").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("rates").select("window_start", "event_type", "n").exceptAll(incidents.incident_rate(events).select("window_start", "event_type", "n")).count() == 0


def test_ring_area(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3))])
    assert spark.range(1).select(boxes.ring_area(ring).alias("a")).first().a == 12.0


def test_synthetic_scene(spark):
    px = synthetic.scene(spark, size=32, bands=1)
    assert px.count() == 1024 and px.agg(F.min("value"), F.max("value")).first()[0] >= 60


def test_empty_detections_stay_typed(spark):
    none = spark.createDataFrame([], DET)
    for out in (suppression.suppress(none), suppression.fuse_boxes(none.withColumn("model_source", F.lit("x"))), detections.plausible_shape(none), spatial.density_discount(none)):
        assert out.count() == 0 and "confidence" in out.columns


def test_chips_by_brute_force(spark):
    from skysift.operators import raster

    for height, width, size, stride in ((23, 40, 8, 6), (7, 9, 8, 6), (64, 64, 24, 16), (20, 20, 20, 3)):
        pixels = spark.createDataFrame([(0, r, c, r * 100 + c) for r in range(height) for c in range(width)], "raster_id long, row long, col long, value long")
        shape = spark.createDataFrame([(0, height, width)], "raster_id long, height long, width long")
        grid = {(w.row_idx, w.col_idx): w for w in raster.windows(shape, size, stride).collect()}
        want = {(i, r - w.row_off, c - w.col_off, r * 100 + c) for i, w in grid.items() for r in range(w.row_off, w.row_off + w.win_h) for c in range(w.col_off, w.col_off + w.win_w)}
        got = [((t.row_idx, t.col_idx), t.row, t.col, t.value) for t in raster.tile_pixels(pixels, size, stride).collect()]
        assert len(got) == len(want) and set(got) == want


def test_one_radar_band_is_given_three_times(spark):
    from skysift.operators import tiling

    rows = [(0, r, c, 0, 1 + r * c) for r in range(6) for c in range(6)] + [(1, r, c, b, r + c + b) for r in range(4) for c in range(4) for b in range(2)]
    out = tiling.selected(spark.createDataFrame(rows, "raster_id long, row long, col long, band int, value long")).collect()
    one = {}
    for x in out:
        one.setdefault((x.raster_id, x.row, x.col), {})[x.band] = x.stretched
    assert all(set(v) == {0, 1, 2} for v in one.values()) and all(v[0] == v[1] == v[2] for (i, _, _), v in one.items() if i == 0)
    assert all(v[1] == v[2] for (i, _, _), v in one.items() if i == 1) and len(one) == 52


def test_profiles_and_inputs(spark, tmp_path):
    from skysift.sources import adapters

    adapters.write_profile(spark, f"{tmp_path}/p", 1.5, -0.25)
    assert tuple(adapters.read_profile(spark, f"{tmp_path}/p").first()) == (1.5, -0.25, 1.0)
    (tmp_path / "q.json").write_text('{"platt_b": 2.0}')
    assert tuple(adapters.read_profile(spark, f"{tmp_path}/q.json").first()) == (1.0, 2.0, 1.0)
    assert adapters.resolved_input(spark, "q.json", str(tmp_path)) == f"{tmp_path}/q.json"
    with pytest.raises(FileNotFoundError):
        adapters.resolved_input(spark, "none.tif", str(tmp_path))


def broadcast_inputs(df):
    """The operators, projections and filters aside, whose rows a plan broadcasts."""
    lines, found = df._jdf.queryExecution().executedPlan().toString().splitlines(), []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = (re.sub(r"^[\s:+*-]*(\(\d+\) )?", "", x).split("(")[0].split()[0] for x in lines[i + 1 :])
            found.append(next(x for x in below if x not in ("Project", "Filter", "ColumnarToRow")))
    return found


def test_tiles_broadcast_no_pixels(spark):
    """Exploded pixels look small to the planner; only what is aggregated by tile may be broadcast."""
    from skysift.plans import fixtures

    tiles = raster.tile_pixels(fixtures.pixels3(spark, "/root/testdata/sf0.01"), 24, 16)
    assert set(broadcast_inputs(tiling.finished_tiles(tiles, 24))) <= {"HashAggregate", "ObjectHashAggregate"}


def test_resampling_by_brute_force(spark):
    """Up, down and in place, on rasters of one line, with pixels missing; the plan joins no grid of targets."""
    rng = np.random.default_rng(5)
    shapes = {0: (1, 1), 1: (7, 1), 2: (2, 9), 3: (11, 6)}
    rows = [(k, r, c, int(rng.integers(0, 256))) for k, (h, w) in shapes.items() for r in range(h) for c in range(w) if (r, c) == (h - 1, w - 1) or rng.random() < 0.8]
    px, have = spark.createDataFrame(rows, "raster_id long, row long, col long, value long"), {x[:3]: x[3] for x in rows}
    for scale in (0.3, 0.6, 1.0, 2.5):
        want = {}
        for k, (h, w) in shapes.items():
            hh, ww = max(round(h * scale), 1), max(round(w * scale), 1)
            for r, c in itertools.product(range(hh), range(ww)):
                y, x = min(max((r + 0.5) * h / hh - 0.5, 0), h - 1), min(max((c + 0.5) * w / ww - 0.5, 0), w - 1)
                four = [((k, min(int(y) + dy, h - 1), min(int(x) + dx, w - 1)), (y % 1 if dy else 1 - y % 1) * (x % 1 if dx else 1 - x % 1)) for dy in (0, 1) for dx in (0, 1)]
                if any(at in have for at, _ in four):
                    want[k, r, c] = pytest.approx(sum(have[at] * f for at, f in four if at in have))
        out = raster.resampled(px, scale)
        assert {(x.raster_id, x.row, x.col): x.value for x in out.collect()} == want
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_gaussian_by_brute_force(spark):
    """Over block borders, thin rasters, missing and null pixels; a pixel moves to the blocks near it and to no neighbour."""
    rng = np.random.default_rng(6)
    shapes = {0: (1, 1), 1: (3, 20), 2: (19, 17), 3: (16, 2)}
    rows = [(k, r, c, None if rng.random() < 0.1 else float(rng.integers(0, 256))) for k, (h, w) in shapes.items() for r in range(h) for c in range(w) if (r, c) == (h - 1, w - 1) or rng.random() < 0.9]
    px, have = spark.createDataFrame(rows, "raster_id long, row long, col long, value double"), {x[:3]: x[3] for x in rows}
    f = np.exp(-0.5 * (np.arange(-6, 7) / 1.5) ** 2)
    mirror = lambda x, n: -x - 1 if x < 0 else 2 * n - 1 - x if x >= n else x
    want = {}
    for k, r, c in have:
        h, w = shapes[k]
        near = [(have.get((k, mirror(r + i, h), mirror(c + j, w))), f[i + 6] * f[j + 6]) for i in range(-6, 7) for j in range(-6, 7)]
        some = [v * g for v, g in near if v is not None]
        want[k, r, c] = pytest.approx(sum(some) / f.sum() ** 2) if some else None
    for block in (8, 256):
        out = raster.gaussian_filter(px, block=block)
        assert {(x.raster_id, x.row, x.col): x.filtered for x in out.collect()} == want
    assert "explode([-6" not in out._jdf.queryExecution().optimizedPlan().toString()
