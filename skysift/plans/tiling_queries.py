"""Queries over the way from scenes to tiles and over change pairs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift.functions.scores import severity
from skysift.operators import raster as ra
from skysift.operators import tiling as ti
from skysift.plans import fixtures as fx
from skysift.plans import scene_queries as scenes
from skysift.plans.fixtures import with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


_BANDS = ", three AS (SELECT raster_id, row, col, o.band AS band, value FROM pixels3 p JOIN (VALUES (0, 1), (1, 2), (2, 2)) o(band, source) ON p.band = o.source)"


@query(with_views(_BANDS + " SELECT * FROM three", "pixels", "pixels3"))
def chosen_bands(spark, sf):
    return ti.chosen_bands(fx.pixels3(spark, sf), (1, 2, 7)).select("raster_id", "row", "col", "band", "value")


@query(with_views(_BANDS + scenes._STRETCH.format("WHERE value <> 0", f"CASE WHEN value = 0 THEN 0 ELSE {scenes._SCALED} END").replace("pixels3", "three"), "pixels", "pixels3"))
def normalised_tile(spark, sf):
    return ti.normalised(fx.pixels3(spark, sf), (1, 2, 7), nodata=0).select("raster_id", "row", "col", "band", "stretched")


@query(with_views(_BANDS + scenes._STRETCH.format("", scenes._SCALED).replace("pixels3", "three"), "pixels", "pixels3"))
def selected_bands(spark, sf):
    return ti.selected(fx.pixels3(spark, sf), (2, 3, 8)).select("raster_id", "row", "col", "band", "stretched")


@query(with_views("SELECT raster_id, row, col, round(avg(value), 6) AS value FROM pixels3 GROUP BY ALL", "pixels", "pixels3"))
def reference_band(spark, sf):
    return ti.reference_band(fx.pixels3(spark, sf)).select("raster_id", "row", "col", scenes.r("value"))


def _manifest(spark, sf):
    shape = fx.pixels(spark, sf).groupBy("raster_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    transform = F.array(F.lit(0.5), F.lit(0.25), 1000 + F.col("raster_id"), F.lit(0.0), F.lit(-0.5), F.lit(2000.0))
    return ti.tile_records(shape.withColumns({"source_raster": F.concat(F.lit("/raw/scene_"), "raster_id", F.lit(".tif")), "transform": transform, "crs": F.lit("EPSG:32636")}), 24, 16)


_MANIFEST = scenes._WINDOWS + """, tile AS (SELECT *, 'scene_' || raster_id || '_r' || row_idx || '_c' || col_idx || '.tif' AS filename, 1000 + raster_id + 0.5::DOUBLE * col_off + 0.25::DOUBLE * row_off AS c, 2000 - 0.5::DOUBLE * row_off AS f FROM win)"""


@query(with_views(_MANIFEST + " SELECT filename, row_idx, col_idx, row_off, col_off, win_h, win_w, 24 - win_h AS pad_bottom, 24 - win_w AS pad_right, c, f, c AS x0, f - 0.5::DOUBLE * win_h AS y0, c + 0.5::DOUBLE * win_w + 0.25::DOUBLE * win_h AS x1, f AS y1, f - 12 AS padded_y0, c + 18 AS padded_x1 FROM tile", "pixels"))
def tile_manifest(spark, sf):
    b, p, long = F.col("world_bounds"), F.col("padded_bounds"), lambda *names: [F.col(n).cast("long").alias(n) for n in names]
    return _manifest(spark, sf).select("filename", *long("row_idx", "col_idx", "row_off", "col_off", "win_h", "win_w", "pad_bottom", "pad_right"), F.col("transform")[2].alias("c"), F.col("transform")[5].alias("f"), *[b[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], p[1].alias("padded_y0"), p[2].alias("padded_x1"))


@query(with_views(_MANIFEST + " SELECT filename, (0.5::DOUBLE * win_w + 0.25::DOUBLE * win_h) * 0.5::DOUBLE * win_h AS area_crs2 FROM tile", "pixels"))
def tile_grid_export(spark, sf):
    return ti.grid_export(_manifest(spark, sf)).select("filename", "area_crs2")


@query(with_views(_MANIFEST + " SELECT filename, win_w, win_h, crs FROM (SELECT *, 'EPSG:32636' AS crs FROM tile) ORDER BY filename LIMIT 10", "pixels"))
def tile_overview(spark, sf):
    return ti.tile_overview(_manifest(spark, sf)).select("filename", F.col("win_w").cast("long").alias("win_w"), F.col("win_h").cast("long").alias("win_h"), "crs")


def _verdicts(spark, sf):
    tiles = ra.tile_pixels(fx.pixels3(spark, sf), 24, 16)
    key = ["raster_id", "row_idx", "col_idx"]
    return tiles.select(*key).distinct(), ra.tile_quality(tiles, key, cloud=127, most_cloud=0.45, least_entropy=7.0), key


_VERDICTS = scenes._WINDOWS + f""", px AS (SELECT w.raster_id, row_idx, col_idx, p.row, p.col, band, value FROM win w JOIN pixels3 p ON {scenes._IN}),
    bins AS (SELECT raster_id, row_idx, col_idx, least(CAST(floor(value * 256 / 255) AS INT), 255) AS bin, count(*) AS n FROM px GROUP BY ALL),
    ent AS (SELECT raster_id, row_idx, col_idx, sum(-p * log2(p)) AS entropy FROM (SELECT *, n / sum(n) OVER (PARTITION BY raster_id, row_idx, col_idx) AS p FROM bins) GROUP BY ALL),
    one AS (SELECT raster_id, row_idx, col_idx, row, col, max(CASE WHEN band = 0 THEN value END) AS first, avg(value) AS mean FROM px GROUP BY ALL),
    ratios AS (SELECT raster_id, row_idx, col_idx, avg((first <> 0)::INT) AS valid, avg((mean > 127)::INT) AS cloud FROM one GROUP BY ALL),
    verdict AS (SELECT raster_id, row_idx, col_idx, CASE WHEN valid < 0.5 THEN 'nodata' WHEN cloud > 0.45 THEN 'cloud' WHEN entropy < 7 THEN 'low_entropy' ELSE 'valid' END AS reason FROM ratios JOIN ent USING (raster_id, row_idx, col_idx))"""


@query(with_views(_VERDICTS + " SELECT raster_id, row_idx, col_idx FROM verdict WHERE reason = 'valid' ORDER BY row_idx, col_idx, raster_id", "pixels", "pixels3"))
def manifest_filter(spark, sf):
    tiles, verdicts, key = _verdicts(spark, sf)
    return ti.kept_tiles(tiles, verdicts, key)


@query(with_views(_VERDICTS + " SELECT raster_id, row_idx, col_idx FROM verdict WHERE reason = 'valid' ORDER BY row_idx, col_idx, raster_id LIMIT 5", "pixels", "pixels3"))
def manifest_first_tiles(spark, sf):
    tiles, verdicts, key = _verdicts(spark, sf)
    return ti.kept_tiles(tiles, verdicts, key, most=5)


@query(with_views(_VERDICTS + " SELECT raster_id, row_idx, col_idx, reason FROM verdict WHERE reason <> 'valid'", "pixels", "pixels3"))
def rejection_manifest(spark, sf):
    tiles, verdicts, key = _verdicts(spark, sf)
    return ti.rejected_tiles(tiles, verdicts, key)


@query(with_views(f"{scenes._WINDOWS}, px AS (SELECT w.raster_id, row_idx, col_idx, p.row - row_off AS row, p.col - col_off AS col, band, value FROM win w JOIN pixels3 p ON {scenes._IN})," + """
    q AS (SELECT raster_id, row_idx, col_idx, band, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi, max(row) + 1 AS h, max(col) + 1 AS w FROM px GROUP BY ALL),
    g AS (SELECT q.*, r.x AS row, c.x AS col FROM q, range(0, 24) r(x), range(0, 24) c(x))
    SELECT g.raster_id, g.row_idx, g.col_idx, g.band, g.row, g.col, coalesce(""" + scenes._SCALED + """, 0) AS value, g.row < h AND g.col < w AS is_valid
    FROM g LEFT JOIN px USING (raster_id, row_idx, col_idx, band, row, col)""", "pixels", "pixels3"))  # fmt: skip
def finished_tiles(spark, sf):
    return ti.finished_tiles(ra.tile_pixels(fx.pixels3(spark, sf), 24, 16), 24).select("raster_id", "row_idx", "col_idx", "band", "row", "col", "value", "is_valid")


@query(with_views("SELECT det_id, raster_id FROM det WHERE raster_id NOT IN (SELECT raster_id FROM pixels)", "det", "pixels"))
def stale_results_cleared(spark, sf):
    return ti.without_stale(fx.det(spark, sf), fx.pixels(spark, sf), "raster_id").select("det_id", "raster_id")


@query(with_views("SELECT pair_id, any_value(h) AS height, any_value(w) AS width FROM (SELECT pair_id, t, max(row) + 1 AS h, max(col) + 1 AS w FROM patches WHERE (pair_id + t) % 4 <> 3 GROUP BY ALL) GROUP BY pair_id, h, w HAVING count(*) = 2", "patches"))
def pair_check(spark, sf):
    return ti.comparable_pairs(fx.patches(spark, sf).filter((F.col("pair_id") + F.col("t")) % 4 != 3))


@query(with_views(scenes._CHANGE + """, n AS (SELECT 'change_severity_' || CASE WHEN change >= 0.7 THEN 3 WHEN change >= 0.5 THEN 2 WHEN change >= 0.3 THEN 1 ELSE 0 END AS label, count(*) AS n FROM cells GROUP BY 1)
    SELECT (SELECT count(DISTINCT pair_id) FROM patches) AS n_pairs, CAST(sum(n) AS BIGINT) AS n_polygons, '{' || string_agg('"' || label || '":' || n, ',' ORDER BY label) || '}' AS by_label FROM n""", "patches"))  # fmt: skip
def change_summary(spark, sf):
    from skysift.operators.change import change_map

    patches = fx.patches(spark, sf)
    cells = change_map(patches).withColumn("label", F.concat(F.lit("change_severity_"), severity(F.col("change"))))
    return ti.change_summary(cells, patches)


@query(with_views(""", d AS (SELECT raster_id, band, row, col, least(greatest(10 * log10(CAST(value AS DOUBLE) * value * 0.0001 + 1e-10), -30), 5) AS v FROM pixels3 WHERE band < 2)
    SELECT raster_id, band, row, col, round(v, 4) AS value FROM d UNION ALL
    SELECT a.raster_id, 2 AS band, a.row, a.col, round(a.v / (b.v + 1e-10), 4) AS value FROM d a JOIN d b ON a.raster_id = b.raster_id AND a.row = b.row AND a.col = b.col AND a.band = 0 AND b.band = 1""", "pixels", "pixels3"))  # fmt: skip
def radar_scene(spark, sf):
    # Near -1e-10 the ratio has no bound; the tables have no such pixel.
    return ti.radar_scene(fx.pixels3(spark, sf), dual=True).select("raster_id", "band", "row", "col", scenes.r("value", 4))


def _raw(spark, sf):
    return fx.det(spark, sf).groupBy(F.concat(F.lit("t"), "raster_id").alias("filename")).agg(F.sort_array(F.collect_list(F.struct("det_id", F.array("xmin", "ymin", "xmax", "ymax").alias("b"), F.concat(F.lit(" "), "label").alias("l")))).alias("x")).select("filename", F.col("x.b").alias("bboxes"), F.col("x.l").alias("labels"))


@query(with_views("SELECT 't' || raster_id AS filename, xmin, ymin, xmax, ymax, label, 1.0::DOUBLE AS confidence FROM det", "det"))
def raw_output_nested(spark, sf):
    from skysift.sources.adapters import nested_output

    rows = nested_output(_raw(spark, sf)).select("filename", F.explode("detections").alias("d"))
    return rows.select("filename", *[F.col("d.bbox")[i].alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))], "d.label", "d.confidence")


def detect_each_target(spark, sf):
    """One call a tile and target; no SQL, the stub hashes in Python."""
    from skysift.sources.adapters import detect_each

    return detect_each(_manifest(spark, sf).select("filename"), "stub", ["tent", "vehicle"])


def change_pipeline(spark, sf):
    """Regions of all change pairs; no SQL, regions are labelled in Python."""
    from skysift.operators.change import change_pipeline as run

    return run(fx.patches(spark, sf), threshold=0.05, least_area=1)[0]


QUERIES |= {f.__name__: f for f in (detect_each_target, change_pipeline)}
