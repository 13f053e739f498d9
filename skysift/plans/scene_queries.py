"""Registered queries on pixels, embeddings, scenes and prompts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift.functions import scores, utm
from skysift.functions.utm import from_utm, to_utm
from skysift.operators import catalog as ca
from skysift.operators import change as ch
from skysift.operators import raster as ra
from skysift.operators import spatial as sp
from skysift.plans import fixtures as fx
from skysift.plans.fixtures import with_views
from skysift.sources import prompts, vectors
from skysift.streaming.incidents import incident_rate as rate

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


_ENTROPY = ", bins AS (SELECT raster_id, least(CAST(floor(value * 256 / 255) AS INT), 255) AS bin, count(*) AS n FROM {} GROUP BY ALL), ent AS (SELECT raster_id, sum(-p * log2(p)) AS entropy FROM (SELECT raster_id, n / sum(n) OVER (PARTITION BY raster_id) AS p FROM bins) GROUP BY 1)"


@query(with_views(_ENTROPY.format("pixels") + " SELECT raster_id, round(entropy, 6) AS entropy FROM ent", "pixels"))
def tile_entropy(spark, sf):
    return ra.entropy(fx.pixels(spark, sf)).select("raster_id", r("entropy"))


@query(with_views(_ENTROPY.format("pixels3") + """, one AS (SELECT raster_id, row, col, max(CASE WHEN band = 0 THEN value END) AS first, avg(value) AS mean FROM pixels3 GROUP BY ALL),
    ratios AS (SELECT raster_id, avg((first <> 0)::INT) AS valid_ratio, avg((mean > 220)::INT) AS cloud_ratio FROM one GROUP BY 1)
    SELECT raster_id, round(valid_ratio, 6) AS valid_ratio, round(cloud_ratio, 6) AS cloud_ratio, round(entropy, 6) AS entropy,
        CASE WHEN valid_ratio < 0.5 THEN 'nodata' WHEN cloud_ratio > 0.6 THEN 'cloud' WHEN entropy < 3.5 THEN 'low_entropy' ELSE 'valid' END AS reason FROM ratios JOIN ent USING (raster_id)""", "pixels", "pixels3"))  # fmt: skip
def tile_quality(spark, sf):
    return ra.tile_quality(fx.pixels3(spark, sf)).select("raster_id", r("valid_ratio"), r("cloud_ratio"), r("entropy"), "reason")


_STRETCH = """, q AS (SELECT raster_id, band, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM pixels3 {0} GROUP BY ALL)
    SELECT raster_id, row, col, band, {1} AS stretched FROM pixels3 LEFT JOIN q USING (raster_id, band)"""
_SCALED = "CASE WHEN hi = lo THEN 0 ELSE CAST(trunc(least(greatest((value - lo) / (hi - lo), 0), 1) * 255) AS INT) END"


@query(with_views(_STRETCH.format("", _SCALED), "pixels", "pixels3"))
def percentile_stretch(spark, sf):
    return ra.stretch(fx.pixels3(spark, sf)).select("raster_id", "row", "col", "band", "stretched")


@query(with_views(_STRETCH.format("WHERE value <> 0", f"CASE WHEN value = 0 THEN 0 ELSE {_SCALED} END"), "pixels", "pixels3"))
def masked_stretch(spark, sf):
    return ra.stretch(fx.pixels3(spark, sf), nodata=0).select("raster_id", "row", "col", "band", "stretched")


@query(with_views(""", w AS (SELECT raster_id, row, col, max(value) FILTER (WHERE band = 0) AS b0, max(value) FILTER (WHERE band = 1) AS b1, max(value) FILTER (WHERE band = 2) AS b2 FROM pixels3 GROUP BY ALL)
    SELECT w.raster_id, w.row, w.col, """ + ", ".join(f"CAST(trunc(least(greatest(b{i} / ((b0 + b1 + b2) / 3 + 1e-6) * value, 0), 255)) AS INT) AS s{i}" for i in range(3)) + " FROM w JOIN pixels USING (raster_id, row, col)", "pixels", "pixels3"))  # fmt: skip
def pansharpen(spark, sf):
    return ra.pan_sharpen(fx.pixels3(spark, sf), fx.pixels(spark, sf))


_FULL = """, shape AS (SELECT raster_id, max(row) + 1 AS h, max(col) + 1 AS w FROM pixels GROUP BY 1),
    grid AS (SELECT raster_id, h, w, r.x AS row, c.x AS col FROM shape, range(0, 80) r(x), range(0, 80) c(x))"""


def _pad_sql(row: str, col: str) -> str:
    return with_views(f"{_FULL} SELECT g.raster_id, g.row, g.col, coalesce(p.value, 0) AS value, g.row < h AND g.col < w AS is_valid FROM grid g LEFT JOIN pixels p ON p.raster_id = g.raster_id AND p.row = {row} AND p.col = {col}", "pixels")


@query(_pad_sql("g.row", "g.col"))
def pad_constant(spark, sf):
    return ra.padded(fx.pixels(spark, sf), 80)


@query(_pad_sql("least(g.row, h - 1)", "least(g.col, w - 1)"))
def pad_edge(spark, sf):
    return ra.padded(fx.pixels(spark, sf), 80, mode="edge")


@query(_pad_sql("CASE WHEN h = 1 THEN 0 ELSE (h - 1) - abs(g.row % (2 * (h - 1)) - (h - 1)) END", "CASE WHEN w = 1 THEN 0 ELSE (w - 1) - abs(g.col % (2 * (w - 1)) - (w - 1)) END"))
def pad_reflect(spark, sf):
    return ra.padded(fx.pixels(spark, sf), 80, mode="reflect")


@query("WITH " + f"pixels AS ({fx.SQL['pixels']}) SELECT raster_id, row, col, value FROM pixels")
def crop_valid(spark, sf):
    return ra.cropped(ra.padded(fx.pixels(spark, sf), 80)).join(fx.pixels(spark, sf).select("raster_id", "row", "col"), ["raster_id", "row", "col"], "left_semi")


_WINDOWS = """, shape AS (SELECT raster_id, max(row) + 1 AS height, max(col) + 1 AS width FROM pixels GROUP BY 1),
    ro AS (SELECT raster_id, height, width, o, row_number() OVER (PARTITION BY raster_id ORDER BY o) - 1 AS i FROM (SELECT DISTINCT raster_id, height, width, o FROM (SELECT raster_id, height, width, unnest(list_append(range(0, greatest(height - 24, 0) + 1, 16), greatest(height - 24, 0))) AS o FROM shape))),
    co AS (SELECT raster_id, o, row_number() OVER (PARTITION BY raster_id ORDER BY o) - 1 AS i FROM (SELECT DISTINCT raster_id, o FROM (SELECT raster_id, unnest(list_append(range(0, greatest(width - 24, 0) + 1, 16), greatest(width - 24, 0))) AS o FROM shape))),
    win AS (SELECT ro.raster_id, ro.i AS row_idx, co.i AS col_idx, ro.o AS row_off, co.o AS col_off, least(24, height - ro.o) AS win_h, least(24, width - co.o) AS win_w FROM ro JOIN co USING (raster_id))"""


@query(with_views(_WINDOWS + " SELECT * FROM win", "pixels"))
def tile_grid(spark, sf):
    shape = fx.pixels(spark, sf).groupBy("raster_id").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    return ra.windows(shape, 24, 16).select("raster_id", F.col("row_idx").cast("long").alias("row_idx"), F.col("col_idx").cast("long").alias("col_idx"), "row_off", "col_off", F.col("win_h").cast("long").alias("win_h"), F.col("win_w").cast("long").alias("win_w"))


_IN = "p.raster_id = w.raster_id AND p.row >= row_off AND p.row < row_off + 24 AND p.col >= col_off AND p.col < col_off + 24"


@query(with_views(f"{_WINDOWS} SELECT w.raster_id, row_idx, col_idx, row_off, col_off, count(*) AS n_valid FROM win w JOIN pixels p ON {_IN} AND p.value <> 0 GROUP BY ALL", "pixels"))
def chip_skip_nodata(spark, sf):
    return ra.chips(fx.pixels(spark, sf), 24, 16).select("raster_id", F.col("row_idx").cast("long").alias("row_idx"), F.col("col_idx").cast("long").alias("col_idx"), "row_off", "col_off", "n_valid")


@query(with_views(f"{_WINDOWS}, t AS (SELECT p.raster_id, p.row, p.col, p.value + 1000 * row_idx + col_idx AS value, row_idx, col_idx FROM win w JOIN pixels p ON {_IN}) SELECT raster_id, row, col, arg_max(value, row_idx * 1000 + col_idx) AS value FROM t GROUP BY ALL", "pixels"))
def mosaic_rebuild(spark, sf):
    tiles = ra.tile_pixels(fx.pixels(spark, sf), 24, 16)
    return ra.mosaic(tiles.withColumn("value", F.col("value") + 1000 * F.col("row_idx") + F.col("col_idx")))


@query(with_views("SELECT raster_id, row // 4 AS row, col // 4 AS col, value FROM pixels WHERE row % 4 = 0 AND col % 4 = 0", "pixels"))
def mosaic_overview(spark, sf):
    return ra.overview(fx.pixels(spark, sf), 4)


@query(with_views(""", shape AS (SELECT raster_id, max(row) + 1 AS h, max(col) + 1 AS w FROM pixels GROUP BY 1),
    big AS (SELECT *, CAST(greatest(round_even(h * 0.6, 0), 1) AS BIGINT) AS hh, CAST(greatest(round_even(w * 0.6, 0), 1) AS BIGINT) AS ww FROM shape),
    spot AS (SELECT raster_id, h, w, r.x AS row, c.x AS col, least(greatest((r.x + 0.5::DOUBLE) * h / hh - 0.5, 0), h - 1) AS y, least(greatest((c.x + 0.5::DOUBLE) * w / ww - 0.5, 0), w - 1) AS x FROM big, range(0, 64) r(x), range(0, 64) c(x) WHERE r.x < hh AND c.x < ww),
    four AS (SELECT raster_id, row, col, least(floor(y) + dy, h - 1) AS rr, least(floor(x) + dx, w - 1) AS cc, (CASE WHEN dy = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE WHEN dx = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS f FROM spot, (VALUES (0), (1)) a(dy), (VALUES (0), (1)) b(dx))
    SELECT f.raster_id, f.row, f.col, round(sum(p.value * f.f), 4) AS value FROM four f JOIN pixels p ON p.raster_id = f.raster_id AND p.row = rr AND p.col = cc GROUP BY ALL""", "pixels"))  # fmt: skip
def resample_bilinear(spark, sf):
    return ra.resampled(fx.pixels(spark, sf), 0.6).select("raster_id", "row", "col", r("value", 4))


@query(with_views("SELECT raster_id, row, col, round(least(greatest(10 * log10(CAST(value AS DOUBLE) * value * 0.0001 + 1e-10), -30), 5), 6) AS db FROM pixels", "pixels"))
def sar_db(spark, sf):
    return fx.pixels(spark, sf).select("raster_id", "row", "col", F.round(scores.decibel(F.col("value").cast("double"), 0.0001), 6).alias("db"))


@query(with_views("""SELECT raster_id, row, col, round(d1 / (d2 + 1e-10), 4) AS ratio FROM (SELECT raster_id, row, col,
    max(least(greatest(10 * log10(CAST(value AS DOUBLE) * value * 0.0001 + 1e-10), -30), 5)) FILTER (WHERE band = 0) AS d1, max(least(greatest(10 * log10(CAST(value AS DOUBLE) * value * 0.0001 + 1e-10), -30), 5)) FILTER (WHERE band = 1) AS d2 FROM pixels3 GROUP BY ALL)""", "pixels", "pixels3"))  # fmt: skip
def pol_ratio(spark, sf):
    db = scores.decibel(F.col("value").cast("double"), 0.0001)
    wide = fx.pixels3(spark, sf).groupBy("raster_id", "row", "col").agg(*[F.max(F.when(F.col("band") == i, db)).alias(f"d{i}") for i in (0, 1)])
    return wide.select("raster_id", "row", "col", F.round(ra.polarisation_ratio(F.col("d0"), F.col("d1")), 4).alias("ratio"))


def _near_sql(radius: int, source: str = "pixels", value: str = "value") -> str:
    """CTE `near` (raster_id, row, col, value, dr, dc, near): squares mirrored at the border, by an equi-join on the mirrored position."""
    mirror = lambda x, n: f"CASE WHEN {x} < 0 THEN -({x}) - 1 WHEN {x} >= {n} THEN 2 * {n} - 1 - ({x}) ELSE {x} END"
    return f""", size AS (SELECT raster_id, max(row) + 1 AS h, max(col) + 1 AS w FROM {source} GROUP BY 1),
    spots AS (SELECT p.raster_id, p.row, p.col, p.{value} AS value, dr, dc, {mirror('p.row + dr', 'h')} AS rr, {mirror('p.col + dc', 'w')} AS cc FROM {source} p JOIN size USING (raster_id), range(-{radius}, {radius + 1}) a(dr), range(-{radius}, {radius + 1}) b(dc)),
    near AS (SELECT s.raster_id, s.row, s.col, s.value, dr, dc, q.{value} AS near FROM spots s LEFT JOIN {source} q ON q.raster_id = s.raster_id AND q.row = rr AND q.col = cc)"""


@query(with_views(_near_sql(1) + " SELECT raster_id, row, col, quantile_cont(near, 0.5) AS filtered FROM near GROUP BY ALL", "pixels"))
def speckle_median(spark, sf):
    return ra.median_filter(fx.pixels(spark, sf)).select("raster_id", "row", "col", "filtered")


@query(with_views(_near_sql(1) + """, loc AS (SELECT raster_id, row, col, any_value(value) AS value, avg(near) AS m, avg(near * near) AS m2 FROM near GROUP BY ALL), g AS (SELECT raster_id, var_pop(value) AS g FROM pixels GROUP BY 1)
    SELECT raster_id, row, col, round(m + greatest(m2 - m * m, 0) / (greatest(m2 - m * m, 0) + g + 1e-6) * (value - m), 4) AS filtered FROM loc JOIN g USING (raster_id)""", "pixels"))  # fmt: skip
def lee_filter(spark, sf):
    return ra.lee_filter(fx.pixels(spark, sf)).select("raster_id", "row", "col", r("filtered", 4))


_GAUSS = "exp(-0.5 * (dr * dr + dc * dc) / CAST(2.25 AS DOUBLE))"


@query(with_views(_near_sql(6) + f", z AS (SELECT pow(sum(exp(-0.5 * x * x / CAST(2.25 AS DOUBLE))), 2) AS z FROM range(-6, 7) t(x)) SELECT raster_id, row, col, round(sum(near * {_GAUSS}) / any_value(z), 4) AS filtered FROM near, z GROUP BY ALL", "pixels"))
def speckle_gaussian(spark, sf):
    return ra.gaussian_filter(fx.pixels(spark, sf)).select("raster_id", "row", "col", r("filtered", 4))


@query(with_views("SELECT raster_id, round(var_pop(value), 4) AS variance, var_pop(value) >= 15 AS is_good FROM pixels GROUP BY 1", "pixels"))
def crop_quality(spark, sf):
    return ch.crop_quality(fx.pixels(spark, sf), ["raster_id"]).select("raster_id", r("variance", 4), "is_good")


_COS = "list_sum(list_transform(range(1, 65), lambda i: CAST({0}[i] AS DOUBLE) * CAST({1}[i] AS DOUBLE)))"


def _cos(a: str, b: str) -> str:
    return f"({_COS.format(a, b)} / greatest(sqrt({_COS.format(a, a)}) * sqrt({_COS.format(b, b)}), 1e-12))"


_DIST = "list_sum(list_transform(range(1, 65), lambda i: {0}))"
_DIFF = "abs(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE))"


@query(with_views(f"""SELECT a.pair_id, a.row, a.col, round(({_cos('a.embedding', 'b.embedding')} + 1) / 2, 6) AS cosine, round(1 / (1 + sqrt({_DIST.format(f'{_DIFF} * {_DIFF}')})), 6) AS euclidean, round(1 / (1 + {_DIST.format(_DIFF)}), 6) AS manhattan
    FROM patches a JOIN patches b ON a.pair_id = b.pair_id AND a.row = b.row AND a.col = b.col AND a.t = 0 AND b.t = 1""", "patches"))  # fmt: skip
def similarity_metrics(spark, sf):
    p = fx.patches(spark, sf)
    a, b = (p.filter(F.col("t") == t).select("pair_id", "row", "col", F.col("embedding").alias(n)) for t, n in ((0, "x"), (1, "y")))
    both = a.join(b, ["pair_id", "row", "col"])
    return both.select("pair_id", "row", "col", *[F.round(scores.similarity(F.col("x"), F.col("y"), m), 6).alias(m) for m in ("cosine", "euclidean", "manhattan")])


_CHANGE = f""", cells AS (SELECT a.pair_id, a.row, a.col, least(greatest(1 - ({_cos('a.embedding', 'b.embedding')} + 1) / 2, 0), 1) AS change FROM patches a JOIN patches b ON a.pair_id = b.pair_id AND a.row = b.row AND a.col = b.col AND a.t = 0 AND b.t = 1)"""


@query(with_views(_CHANGE + " SELECT pair_id, row, col, round(change, 6) AS change FROM cells", "patches"))
def change_map(spark, sf):
    return ch.change_map(fx.patches(spark, sf)).select("pair_id", "row", "col", r("change"))


@query(with_views(_CHANGE + _near_sql(1, "cells", "change").replace("raster_id", "pair_id") + """, loc AS (SELECT pair_id, row, col, any_value(value) AS x, greatest(avg(near * near) - avg(near) * avg(near), 0) AS v FROM near GROUP BY ALL)
    SELECT pair_id, row, col, round(least(greatest(x * v / (v + avg(v) OVER (PARTITION BY pair_id) + 1e-6), 0), 1), 6) AS change FROM loc""", "patches"))  # fmt: skip
def lvn(spark, sf):
    return ch.variance_normalised(ch.change_map(fx.patches(spark, sf))).select("pair_id", "row", "col", r("change"))


_OTSU = """, bins AS (SELECT pair_id, least(CAST(floor(change * 256) AS INT), 255) AS bin, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY ALL),
    every AS (SELECT pair_id, b.bin, coalesce(n, 0) AS n, (b.bin + 0.5::DOUBLE) / 256 AS c FROM (SELECT pair_id, x AS bin FROM (SELECT DISTINCT pair_id FROM bins), range(0, 256) t(x)) b LEFT JOIN bins USING (pair_id, bin)),
    cum AS (SELECT pair_id, bin, c, sum(n) OVER u AS w1, sum(n) OVER d AS w2, sum(n * c) OVER u AS s1, sum(n * c) OVER d AS s2 FROM every
        WINDOW u AS (PARTITION BY pair_id ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), d AS (PARTITION BY pair_id ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    th AS (SELECT pair_id, c AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY round(w1 * w2 * (s1 / greatest(w1, 1e-12) - s2 / greatest(w2, 1e-12)) * (s1 / greatest(w1, 1e-12) - s2 / greatest(w2, 1e-12)), 6) DESC, bin) AS k FROM cum WHERE bin < 255) WHERE k = 1)"""


@query(with_views(_CHANGE + _OTSU + " SELECT pair_id, threshold FROM th", "patches"))
def otsu_threshold(spark, sf):
    return ra.otsu(ch.change_map(fx.patches(spark, sf)))


def _morph(name: str, source: str, how: str) -> str:
    return f""", {name} AS (SELECT p.pair_id, p.row, p.col, {how}(coalesce(q.value, 0)) AS value FROM (SELECT * FROM {source}, range(-1, 2) a(dr), range(-1, 2) b(dc)) p LEFT JOIN {source} q ON q.pair_id = p.pair_id AND q.row = p.row + dr AND q.col = p.col + dc GROUP BY ALL)"""


@query(with_views(""", m AS (SELECT raster_id AS pair_id, row, col, CAST(value < 200 AS INT) AS value FROM pixels)""" + _morph("m1", "m", "min") + _morph("m2", "m1", "max") + _morph("m3", "m2", "max") + _morph("m4", "m3", "min") + " SELECT * FROM m4", "pixels"))
def morph_clean(spark, sf):
    mask = fx.pixels(spark, sf).select(F.col("raster_id").alias("pair_id"), "row", "col", (F.col("value") < 200).cast("int").alias("value"))
    return ra.morphology(mask)


@query(with_views(_CHANGE + " SELECT CASE WHEN change >= 0.7 THEN 3 WHEN change >= 0.5 THEN 2 WHEN change >= 0.3 THEN 1 ELSE 0 END AS severity, count(*) AS n_cells FROM cells GROUP BY 1", "patches"))
def severity_counts(spark, sf):
    return ch.severity_counts(ch.change_map(fx.patches(spark, sf)))


def _pixel_change(spark, sf):
    return fx.pixels(spark, sf).select(F.col("raster_id").alias("pair_id"), "row", "col", (F.col("value") / 255).alias("change"))


@query()
def change_polygons(spark, sf):
    masked = ch.change_mask(_pixel_change(spark, sf), threshold=0.25)
    return ch.change_polygons(masked).select("pair_id", "xmin", "ymin", "xmax", "ymax", "label", r("confidence"), "area")


@query()
def ecc_align(spark, sf):
    p = fx.pixels(spark, sf).filter("row < 64")
    smooth = ra.moving(p, F.avg("near"), "v", border="reflect").select(F.col("raster_id").alias("pair_id"), "row", "col", "v")
    other = smooth.select("pair_id", F.col("row"), (F.col("col") - 1).alias("col"), F.col("v").alias("v2"))
    pair = smooth.withColumnRenamed("v", "v1").join(other, ["pair_id", "row", "col"])
    return ch.shift_estimate(pair).select("pair_id", *[F.round(c, 2).alias(c) for c in ("theta", "tx", "ty")])


_STATUS = f""", s AS (SELECT e.site_id, e.seq, e.seq = f.seq AS base, ({_cos('e.embedding', 'f.embedding')} + 1) / 2 AS s FROM emb_series e JOIN (SELECT site_id, min(seq) AS seq, arg_min(embedding, seq) AS embedding, count(*) AS n FROM emb_series GROUP BY 1) f ON e.site_id = f.site_id WHERE n >= 2),
    st AS (SELECT site_id, seq, CASE WHEN base THEN 1::DOUBLE ELSE round_even(s, 4) END AS similarity, CASE WHEN base THEN 'baseline' WHEN s >= 0.85 THEN 'intact' ELSE 'altered/destroyed' END AS status FROM s)"""


@query(with_views(_STATUS + " SELECT * FROM st", "emb_series"))
def time_series_status(spark, sf):
    return ch.series_status(fx.emb_series(spark, sf))


@query(with_views(_STATUS + """, b AS (SELECT *, lag(seq) OVER (PARTITION BY site_id ORDER BY seq) AS before FROM st), f AS (SELECT site_id, min(seq) AS seq FROM st WHERE status = 'altered/destroyed' GROUP BY 1)
    SELECT a.site_id, before AS pre_event, f.seq AS post_event, CASE WHEN f.seq IS NULL THEN 'No significant change detected in sequence.' ELSE before || ' to ' || f.seq END AS event_window
    FROM (SELECT DISTINCT site_id FROM st) a LEFT JOIN f USING (site_id) LEFT JOIN b ON b.site_id = a.site_id AND b.seq = f.seq""", "emb_series"))  # fmt: skip
def event_window(spark, sf):
    return ch.event_window(ch.series_status(fx.emb_series(spark, sf)))


@query(f"""WITH u AS (SELECT vec_id, label, embedding, sqrt({_COS.format('embedding', 'embedding')}) AS n FROM embeddings),
    x AS (SELECT label, unnest(range(1, 65)) AS i, unnest(list_transform(range(1, 65), lambda k: CAST(embedding[k] AS DOUBLE) / greatest(n, 1e-12))) AS v FROM u), m AS (SELECT label, i, avg(v) AS v FROM x GROUP BY ALL),
    p AS (SELECT label, list(v ORDER BY i) AS prototype FROM m GROUP BY 1)
    SELECT vec_id, round_even(0.5 * CAST((vec_id * 37) % 101 AS DOUBLE) / 100 + 0.5 * greatest({_cos('u.embedding', 'p.prototype')}, 0), 4) AS verified FROM u JOIN p USING (label) WHERE label <> 3
    UNION ALL SELECT vec_id, round_even(CAST((vec_id * 37) % 101 AS DOUBLE) / 100, 4) FROM u WHERE label = 3""")
def prototype_verify(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    protos = ch.prototypes(e).filter("label != 3")
    det = e.withColumn("confidence", ((F.col("vec_id") * 37) % 101).cast("double") / 100)
    return ch.verified(det, protos).select("vec_id", "verified")


@query(f"SELECT vec_id, round(sqrt({_COS.format('embedding', 'embedding')}), 6) AS norm, round(CAST(embedding[1] AS DOUBLE) / greatest(sqrt({_COS.format('embedding', 'embedding')}), 1e-12), 6) AS first FROM embeddings")
def embedding_norm(spark, sf):
    return ch.embedding_norm(spark.read.parquet(f"{sf}/embeddings.parquet")).select("vec_id", r("norm"), F.round(F.get("unit", F.lit(0)), 6).alias("first"))


_NAME = "lower(filename)"
_PROVIDER = f"""CASE WHEN contains({_NAME}, 'capella') THEN 'Capella Space' WHEN regexp_matches({_NAME}, 'airbus|pleiades|spot|phr') THEN 'Airbus' WHEN regexp_matches({_NAME}, 'maxar|wv|gegd|vantor') THEN 'Vantor / Maxar' ELSE 'Unknown Vendor' END"""
_MODALITY = f"""CASE WHEN contains({_NAME}, 'capella') THEN 'SAR' WHEN regexp_matches({_NAME}, 'airbus|pleiades|spot|phr|maxar|wv|gegd|vantor') THEN 'Optical' WHEN bands = 1 AND regexp_matches({_NAME}, 'sar|hh|vv') THEN 'SAR' ELSE 'Optical' END"""


@query(with_views(f"SELECT scene_id, filename, {_PROVIDER} AS provider, {_MODALITY} AS modality FROM scenes", "scenes"))
def vendor_classify(spark, sf):
    s = fx.scenes(spark, sf)
    provider, modality = ca.vendor(F.col("filename"), F.col("filename"), F.col("bands"))
    return s.select("scene_id", "filename", provider.alias("provider"), modality.alias("modality"))


@query(with_views("SELECT scene_id, CASE WHEN scene_id % 5 = 0 THEN '2023-05-06T07:08:09' WHEN scene_id % 5 = 1 THEN '2022-03-0' || (1 + scene_id % 4) || 'T01:02:03Z' ELSE '2024-01-' || lpad(CAST(1 + scene_id % 28 AS VARCHAR), 2, '0') || 'T00:00:00+00:00' END AS ts FROM scenes", "scenes"))
def timestamp_extract(spark, sf):
    sidecar = F.when(F.col("scene_id") % 5 == 0, F.lit('{"collect": {"start_time": "2023-05-06T07:08:09"}}'))
    tag = F.element_at(F.array(*map(F.lit, ca.TIME_TAGS)), (1 + F.col("scene_id") % 4).cast("int"))
    xml = F.when(F.col("scene_id") % 5 == 1, F.concat(F.lit("<a><b>x</b><"), tag, F.lit("> 2022-03-0"), 1 + F.col("scene_id") % 4, F.lit("T01:02:03Z </"), tag, F.lit("></a>")))
    return fx.scenes(spark, sf).select("scene_id", ca.acquisition_time(F.col("filename"), sidecar, xml).alias("ts"))


@query(with_views(f"""SELECT scene_id, round_even((least(x1, 30) - greatest(x0, -20)) * (least(y1, 45) - greatest(y0, -10)) / (50 * 55) * 100, 2) AS buffer_coverage_pct FROM scenes
    WHERE {_MODALITY} = 'Optical' AND (ts = 'Area' OR (ts >= '2024-01-05' AND ts <= '2024-01-20')) AND x0 <= 30 AND x1 >= -20 AND y0 <= 45 AND y1 >= -10""", "scenes"))  # fmt: skip
def catalog_query(spark, sf):
    s = sp.as_boxes(fx.scenes(spark, sf)).withColumn("modality", ca.vendor(F.col("filename"), F.col("filename"), F.col("bands"))[1])
    return ca.search(s, (-20, -10, 30, 45), start="2024-01-05", end="2024-01-20", modality="optical").select("scene_id", "buffer_coverage_pct")


@query(with_views(""", p AS (SELECT i.incident_id, s.scene_id, lon - 0.1 AS ax, lat - 0.1 AS ay, lon + 0.1 AS bx, lat + 0.1 AS top, s.* FROM incidents i JOIN scenes s ON lon - 0.1 <= x1 AND x0 <= lon + 0.1 AND lat - 0.1 <= y1 AND y0 <= lat + 0.1),
    w AS (SELECT incident_id, scene_id, greatest(floor(round((ax - x0) / 0.01, 6)), 0) AS c0, least(ceil(round((bx - x0) / 0.01, 6)), 500) AS c1, greatest(floor(round((y1 - top) / 0.01, 6)), 0) AS r0, least(ceil(round((y1 - ay) / 0.01, 6)), 400) AS r1 FROM p)
    SELECT incident_id, scene_id, CAST(r0 AS BIGINT) AS row_off, CAST(c0 AS BIGINT) AS col_off, CAST(r1 - r0 AS BIGINT) AS height, CAST(c1 - c0 AS BIGINT) AS width FROM w""".replace("0.01,", "CAST(0.01 AS DOUBLE),").replace("0.1 ", "CAST(0.1 AS DOUBLE) "), "incidents", "scenes"))  # fmt: skip
def incident_windows(spark, sf):
    return ca.incident_windows(fx.incidents(spark, sf), sp.as_boxes(fx.scenes(spark, sf)))


@query(with_views("SELECT incident_id, scene_id FROM incidents JOIN scenes ON lon - 1e-6 <= x1 AND x0 <= lon + 1e-6 AND lat - 1e-6 <= y1 AND y0 <= lat + 1e-6", "incidents", "scenes"))
def tile_point_probe(spark, sf):
    points = fx.incidents(spark, sf).withColumnsRenamed({"lon": "x", "lat": "y"})
    return sp.probe_tiles(points, sp.as_boxes(fx.scenes(spark, sf)), point_id="incident_id", tile_id="scene_id")


@query(with_views("SELECT incident_id, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + CAST(trunc((lon + 180) / 6) AS INT) + 1 AS epsg FROM incidents", "incidents"))
def utm_zone(spark, sf):
    return fx.incidents(spark, sf).select("incident_id", scores.utm_zone(F.col("lon"), F.col("lat")).alias("epsg"))


@query(with_views("SELECT incident_id, lon, lat FROM incidents", "incidents"))
def utm_round_trip(spark, sf):
    p = fx.incidents(spark, sf).withColumn("epsg", scores.utm_zone(F.col("lon"), F.col("lat")))
    e, n = to_utm(F.col("lon"), F.col("lat"), F.col("epsg"))
    lon, lat = from_utm(F.col("e"), F.col("n"), F.col("epsg"))
    return p.select("incident_id", "epsg", e.alias("e"), n.alias("n")).select("incident_id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def _buffer_sql(metres: float = 1000.0) -> str:
    """Squares around incidents: to the point's zone by the Krüger series, out to the corners, and back."""
    series = lambda terms, sign, a, b, x, y: "".join(f" {sign} CAST({t!r} AS DOUBLE) * {a}({2 * j} * {x}) * {b}({2 * j} * {y})" for j, t in enumerate(terms, 1))
    e, scale = f"CAST({utm._E!r} AS DOUBLE)", f"CAST({utm._K0 * utm._RADIUS!r} AS DOUBLE)"
    latitude = "chi"
    for _ in range(4):
        latitude = f"asin(tanh(atanh(sin(chi)) + {e} * atanh({e} * sin({latitude}))))"
    corners = ", ".join(f"({i}, {x * metres}, {y * metres})" for i, (x, y) in enumerate(((1, -1), (1, 1), (-1, 1), (-1, -1))))
    return f""", zoned AS (
    SELECT incident_id, radians(lat) AS phi, lon, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + CAST(trunc((lon + 180) / 6) AS INT) + 1 AS epsg FROM incidents
), spheric AS (
    SELECT *, radians(CAST(epsg % 100 * 6 - 183 AS DOUBLE)) AS meridian, sinh(atanh(sin(phi)) - {e} * atanh({e} * sin(phi))) AS t FROM zoned
), gauss AS (
    SELECT *, atan2(t, cos(radians(lon) - meridian)) AS xi, atanh(sin(radians(lon) - meridian) / sqrt(1 + t * t)) AS eta FROM spheric
), flat AS (
    SELECT *, {scale} * (eta{series(utm._FORWARD, "+", "cos", "sinh", "xi", "eta")}) AS e, {scale} * (xi{series(utm._FORWARD, "+", "sin", "cosh", "xi", "eta")}) AS n FROM gauss
), corners AS (
    SELECT incident_id, epsg, meridian, i, (n + CAST(dy AS DOUBLE)) / {scale} AS xi, (e + CAST(dx AS DOUBLE)) / {scale} AS eta FROM flat, (VALUES {corners}) AS c(i, dx, dy)
), back AS (
    SELECT *, xi{series(utm._INVERSE, "-", "sin", "cosh", "xi", "eta")} AS u, eta{series(utm._INVERSE, "-", "cos", "sinh", "xi", "eta")} AS v FROM corners
), placed AS (
    SELECT *, asin(sin(u) / cosh(v)) AS chi FROM back
), degree AS (
    SELECT incident_id, epsg, i, round(degrees(atan2(sinh(v), cos(u)) + meridian), 6) AS x, round(degrees({latitude}), 6) AS y FROM placed
)
SELECT incident_id, epsg, {", ".join(f"max({k}) FILTER (i = {i}) AS {k}{i}" for i in range(4) for k in "xy")} FROM degree GROUP BY incident_id, epsg"""


@query(with_views(_buffer_sql(), "incidents"))
def metric_buffer(spark, sf):
    rings = ca.metric_buffer(fx.incidents(spark, sf))
    return rings.select("incident_id", "epsg", *[F.round(F.get("ring", F.lit(i))[k], 6).alias(f"{k}{i}") for i in range(4) for k in "xy"])


@query(with_views("""SELECT '/archive/' || (scene_id % 60) AS filepath, arg_max(scene_id, k) AS scene_id, arg_max(ts, k) AS ts FROM
    (SELECT scene_id, ts, scene_id + CASE WHEN scene_id % 2 = 1 THEN 1000000 ELSE 0 END AS k FROM scenes) GROUP BY 1""", "scenes"))  # fmt: skip
def catalog_upsert(spark, sf):
    s = fx.scenes(spark, sf).select(F.concat(F.lit("/archive/"), (F.col("scene_id") % 60).cast("string")).alias("filepath"), "scene_id", "ts")
    return ca.upserted(s.filter("scene_id % 2 = 0"), s.filter("scene_id % 2 = 1"), "filepath", "scene_id")


@query(with_views("SELECT DISTINCT raster_id FROM det WHERE raster_id NOT IN (SELECT raster_id FROM pixels)", "det", "pixels"))
def resume_pending(spark, sf):
    return ca.pending(fx.det(spark, sf).select("raster_id").distinct(), fx.pixels(spark, sf), "raster_id")


@query(with_views("""SELECT scene_id, greatest(32, CASE scene_id % 3 WHEN 0 THEN 256 WHEN 1 THEN 333 ELSE 410 END) AS stride, greatest(32, 512 - least(CAST(trunc(25 / (0.1 * bands)) AS INT), 307)) AS metric_stride,
    CASE WHEN 512 - (300 + 60 * bands) <= 0 THEN 1::DOUBLE ELSE least(1::DOUBLE, round_even(greatest(scene_id % 50, 20) / CAST(512 - (300 + 60 * bands) AS DOUBLE), 4)) END AS risk,
    round(CAST(0.0001 * bands * 111320 AS DOUBLE), 4) AS gsd_x FROM scenes""", "scenes"))  # fmt: skip
def tile_strides(spark, sf):
    s = fx.scenes(spark, sf)
    kind = F.when(F.col("scene_id") % 3 == 0, "linear").when(F.col("scene_id") % 3 == 1, "cluster").otherwise("point")
    gsd = ca.ground_sample(0.0001 * F.col("bands"), 0.0001 * F.col("bands"), F.lit(True))[0]
    return s.select("scene_id", ca.tile_stride(kind).alias("stride"), ca.metric_stride(0.1 * F.col("bands")).alias("metric_stride"), ca.truncation_risk(F.col("scene_id") % 50, F.lit(20), 300 + 60 * F.col("bands")).alias("risk"), F.round(gsd, 4).alias("gsd_x"))


@query(with_views("""SELECT scene_id, r.x AS row_off, c.x AS col_off, least(512, 1000 + 37 * bands - r.x) AS win_h, least(512, 1500 - c.x) AS win_w FROM scenes, range(0, 1148, 333) r(x), range(0, 1500, 333) c(x) WHERE r.x < 1000 + 37 * bands""", "scenes"))
def adaptive_grid(spark, sf):
    images = fx.scenes(spark, sf).select("scene_id", (1000 + 37 * F.col("bands")).alias("height"), F.lit(1500).cast("long").alias("width"))
    return ca.adaptive_grid(images, 333).select("scene_id", "row_off", "col_off", "win_h", "win_w")


_TARGETS = ", ".join(f"('{k}', '{p}', {s!r}, {b}, {t})" for k, p, s, b, t in prompts.TARGETS)
_ASKED = ", ".join(f"('{p}', {i}, '{q}')" for p, qs in {**prompts.PROFILES, "catalogue": [" Tents", "aircraft ", "GUARD_TOWERS"]}.items() for i, q in enumerate(qs))
_FOUND = f"WITH t(target, primary_prompt, synonyms, box_threshold, text_threshold) AS (VALUES {_TARGETS}), q(profile, position, query) AS (VALUES {_ASKED}), f AS (SELECT profile, position, query, coalesce(primary_prompt, query) AS primary_prompt, coalesce(synonyms, []) AS synonyms, coalesce(CAST(box_threshold AS DOUBLE), CAST(0.25 AS DOUBLE)) AS box_threshold, coalesce(CAST(text_threshold AS DOUBLE), CAST(0.25 AS DOUBLE)) AS text_threshold FROM q LEFT JOIN t ON lower(trim(query)) = target)"


def _found(spark):
    more = spark.createDataFrame([("catalogue", i, q) for i, q in enumerate([" Tents", "aircraft ", "GUARD_TOWERS"])], "profile string, position int, query string")
    return prompts.looked_up(prompts.profiles(spark).unionByName(more), prompts.targets(spark))


@query(_FOUND + """ SELECT profile, position, trim('<CAPTION_TO_PHRASE> ' || primary_prompt) AS caption, trim('<CAPTION_TO_PHRASE> ' || array_to_string(list_concat([primary_prompt], synonyms), ', ')) AS caption_with_synonyms,
    array_to_string(list_concat([primary_prompt], synonyms), ' . ') || ' .' AS dotted, CASE WHEN query = '' THEN 'find' ELSE 'find ' || query END AS plain FROM f""")  # fmt: skip
def prompt_format(spark, sf):
    return _found(spark).select(
        "profile", "position", prompts.caption_prompt().alias("caption"), prompts.caption_prompt(synonyms=True).alias("caption_with_synonyms"),
        prompts.dotted_prompt(F.concat(F.array("primary_prompt"), F.col("synonyms"))).alias("dotted"), prompts.plain_prompt(F.lit("find"), F.col("query")).alias("plain"),
    )


@query(_FOUND + " SELECT profile, position, CASE WHEN position = 1 THEN CAST(0.5 AS DOUBLE) ELSE box_threshold END AS box_threshold, text_threshold FROM f")
def threshold_lookup(spark, sf):
    return prompts.with_thresholds(_found(spark), F.when(F.col("position") == 1, 0.5)).select("profile", "position", "box_threshold", "text_threshold")


@query(with_views("SELECT ctx_id, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || x0 || ',' || y0 || ']},\"properties\":{\"ctx_id\":' || ctx_id || '}}' AS feature FROM ctx_boxes", "ctx_boxes"))
def geojson_features(spark, sf):
    c = fx.ctx_boxes(spark, sf).select("ctx_id", F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y"))).alias("ring"))
    return vectors.features(c).select(F.get_json_object("feature", "$.properties.ctx_id").cast("long").alias("ctx_id"), "feature")


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL")
def incident_rate(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return rate(e).select("window_start", "event_type", "n", r("mean_value"))
