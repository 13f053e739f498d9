"""Registered queries on detections, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skysift.functions import boxes
from skysift.functions.boxes import box
from skysift.operators import detections as d
from skysift.operators import evaluation as ev
from skysift.operators import polygons as po
from skysift.operators import spatial as sp
from skysift.operators import suppression as su
from skysift.plans import fixtures as fx
from skysift.plans.fixtures import with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


NAMES = {"tent": "shelter", "vehicle": "military vehicle"}
THRESHOLDS = {"tent": 0.4, "aircraft": 0.2, "shelter": 0.35}
SCALES = {"tent": (50.0, 400.0), "vehicle": (10.0, 900.0)}
_NAMES_SQL = "(VALUES ('tent', 'shelter'), ('vehicle', 'military vehicle')) names(a, b)"
_LEAST_SQL = "CASE label WHEN 'tent' THEN 0.4 WHEN 'aircraft' THEN 0.2 WHEN 'shelter' THEN 0.35 ELSE 0.30 END"
_SHAPE_SQL = """(xmax - xmin) * (ymax - ymin) BETWEEN 10 AND 250000 AND
    greatest(xmax - xmin, ymax - ymin) / (CASE WHEN least(xmax - xmin, ymax - ymin) = 0 THEN 1e-6 ELSE least(xmax - xmin, ymax - ymin) END) <= 10"""
_SEAM = "(xmin % 512 <= 8 OR ymin % 512 <= 8 OR xmax % 512 >= 504 OR ymax % 512 >= 504)"
PENALISED = f"CASE WHEN {_SEAM} THEN confidence * 0.70 ELSE confidence END"


def iou_sql(a: str, b: str) -> str:
    inter = f"(greatest(least({a}.xmax, {b}.xmax) - greatest({a}.xmin, {b}.xmin), 0) * greatest(least({a}.ymax, {b}.ymax) - greatest({a}.ymin, {b}.ymin), 0))"
    return f"({inter} / ((({a}.xmax - {a}.xmin) * ({a}.ymax - {a}.ymin)) + (({b}.xmax - {b}.xmin) * ({b}.ymax - {b}.ymin)) - {inter}))"


def gap_sql(a: str, b: str) -> str:
    dx = f"greatest({a}.xmin - {b}.xmax, {b}.xmin - {a}.xmax, 0)"
    dy = f"greatest({a}.ymin - {b}.ymax, {b}.ymin - {a}.ymax, 0)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def greedy_sql(group: str, source: str, score: str, test: str) -> str:
    """CTEs that end in `greedy` (det_id, anchor): the first kept box, by rank, that a box meets; itself if it is kept."""
    return f""", ranked AS (SELECT *, {group} AS grp, row_number() OVER (PARTITION BY {group} ORDER BY {score} DESC, det_id) AS rk FROM {source}),
    steps(grp, rk, det_id, anchor, kept) AS (
        SELECT grp, rk, det_id, det_id, [{{'det_id': det_id, 'xmin': xmin, 'ymin': ymin, 'xmax': xmax, 'ymax': ymax}}] FROM ranked WHERE rk = 1
        UNION ALL
        SELECT grp, rk, det_id, coalesce(hit, det_id), CASE WHEN hit IS NULL THEN list_append(kept, {{'det_id': det_id, 'xmin': xmin, 'ymin': ymin, 'xmax': xmax, 'ymax': ymax}}) ELSE kept END
        FROM (SELECT r.grp, r.rk, r.det_id, r.xmin, r.ymin, r.xmax, r.ymax, s.kept, list_filter(s.kept, lambda k: {iou_sql('k', 'r')} {test})[1].det_id AS hit
              FROM steps s JOIN ranked r ON r.grp = s.grp AND r.rk = s.rk + 1)
    ), greedy AS (SELECT det_id, anchor FROM steps)"""


_KEPT = "FROM det WHERE det_id IN (SELECT det_id FROM greedy WHERE det_id = anchor)"


@query(with_views(f"SELECT det_id, round({PENALISED}, 6) AS penalised FROM det", "det"))
def edge_penalty(spark, sf):
    return d.edge_penalty(fx.det(spark, sf)).select("det_id", F.round("penalised", 6).alias("penalised"))


_SCORED = f", scored AS (SELECT * FROM (SELECT *, {PENALISED} AS score FROM det) WHERE score >= 0.25)"


@query(with_views(_SCORED + greedy_sql("raster_id || '/' || label", "scored", "score", "> 0.45") + f" SELECT det_id, raster_id, label, confidence {_KEPT}", "det"))
def nms_per_class(spark, sf):
    return su.suppress(fx.det(spark, sf)).select("det_id", "raster_id", "label", "confidence")


@query(SQL["nms_per_class"])
def nms_by_rounds(spark, sf):
    return su.suppress_by_rounds(fx.det(spark, sf)).select("det_id", "raster_id", "label", "confidence")


@query(with_views(_SCORED + greedy_sql("raster_id", "scored", "score", "> 0.45") + f" SELECT det_id, raster_id, label, confidence {_KEPT}", "det"))
def nms_agnostic(spark, sf):
    return su.suppress(fx.det(spark, sf), ("raster_id",)).select("det_id", "raster_id", "label", "confidence")


def _soft_sql(factor: str) -> str:
    """The best open box of a raster leaves, and the scores of the rest decay by their overlap with it, until none is open."""
    fields = "'det_id': det_id, 'xmin': xmin, 'ymin': ymin, 'xmax': xmax, 'ymax': ymax, 'score': score"
    rest = ", ".join(f"'{c}': x.{c}" for c in ("det_id", "xmin", "ymin", "xmax", "ymax"))
    return f"""{_SCORED}, taken(raster_id, b, rest) AS (
        SELECT raster_id, NULL::STRUCT(det_id BIGINT, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE, score DOUBLE), list({{{fields}}}) FROM scored GROUP BY raster_id
        UNION ALL
        SELECT raster_id, best, list_transform(list_filter(rest, lambda x: x.det_id <> best.det_id), lambda x: {{{rest}, 'score': x.score * {factor.format(iou_sql('best', 'x'))}}})
        FROM (SELECT raster_id, rest, list_reduce(rest, lambda a, x: CASE WHEN x.score > a.score OR (x.score = a.score AND x.det_id < a.det_id) THEN x ELSE a END) AS best FROM taken WHERE len(rest) > 0)
    ) SELECT det_id, d.raster_id, confidence, round(b.score, 6) AS decayed FROM taken t JOIN det d ON d.det_id = t.b.det_id WHERE b.score >= 0.25"""


@query(with_views(_soft_sql("exp(-({0} * {0}) / 0.5)"), "det"))
def soft_nms_gaussian(spark, sf):
    return su.soft_suppress(fx.det(spark, sf)).select("det_id", "raster_id", "confidence", F.round("decayed", 6).alias("decayed"))


@query(with_views(_soft_sql("CASE WHEN {0} > 0.45 THEN 1 - {0} ELSE 1 END"), "det"))
def soft_nms_linear(spark, sf):
    return su.soft_suppress(fx.det(spark, sf), method="linear").select("det_id", "raster_id", "confidence", F.round("decayed", 6).alias("decayed"))


_W = "CASE model_source WHEN 'florence2' THEN 1.0 WHEN 'grounding_dino' THEN 1.2 ELSE 1.0 END"


@query(with_views(greedy_sql("raster_id || '/' || label", "det", "confidence", ">= 0.50") + f"""
    SELECT raster_id, label, anchor, round(sum(xmin * confidence * w) / greatest(sum(confidence * w), 1e-6), 6) AS xmin, round(sum(ymin * confidence * w) / greatest(sum(confidence * w), 1e-6), 6) AS ymin,
        round(sum(xmax * confidence * w) / greatest(sum(confidence * w), 1e-6), 6) AS xmax, round(sum(ymax * confidence * w) / greatest(sum(confidence * w), 1e-6), 6) AS ymax,
        round(CASE WHEN count(DISTINCT model_source) > 1 THEN least(max(confidence) * (1 + 0.15 * (count(DISTINCT model_source) - 1)), 1.0) ELSE max(confidence) END, 6) AS confidence,
        count(DISTINCT model_source) AS consensus_models
    FROM (SELECT *, CAST({_W} AS DOUBLE) AS w FROM det JOIN greedy USING (det_id)) GROUP BY raster_id, label, anchor""", "det"))  # fmt: skip
def wbf_fusion(spark, sf):
    out = su.fuse_boxes(fx.det(spark, sf), keys=("raster_id", "label"))
    return out.select("raster_id", "label", "anchor", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], F.round("confidence", 6).alias("confidence"), "consensus_models")


@query(with_views(f"SELECT det_id, coalesce(b, trim(lower('  ' || upper(label) || ' '))) AS label FROM det LEFT JOIN {_NAMES_SQL} ON trim(lower('  ' || upper(label) || ' ')) = a", "det"))
def semantic_map(spark, sf):
    raw = fx.det(spark, sf).withColumn("label", F.concat(F.lit("  "), F.upper("label"), F.lit(" ")))
    return d.map_labels(raw, NAMES).select("det_id", "label")


@query(with_views(f"SELECT det_id, label, confidence FROM det WHERE confidence >= {_LEAST_SQL}", "det"))
def class_threshold(spark, sf):
    return d.above_class_threshold(fx.det(spark, sf), THRESHOLDS).select("det_id", "label", "confidence")


@query(with_views(f"SELECT det_id, xmin, ymin, xmax, ymax FROM det WHERE {_SHAPE_SQL}", "det"))
def geometry_filter(spark, sf):
    return d.plausible_shape(fx.det(spark, sf)).select("det_id", "xmin", "ymin", "xmax", "ymax")


_SMALL = ", small AS (SELECT det_id, xmin / 8192 AS xmin, ymin / 8192 AS ymin, xmax / 8192 AS xmax, ymax / 8192 AS ymax FROM det)"


@query(with_views(_SMALL + """ SELECT det_id, round(xmin * f, 6) AS xmin, round(ymin * f, 6) AS ymin, round(xmax * f, 6) AS xmax, round(ymax * f, 6) AS ymax
    FROM small, (SELECT CASE WHEN max(greatest(xmin, ymin, xmax, ymax)) <= 1 THEN 512 ELSE 1 END AS f FROM small)""", "det"))  # fmt: skip
def denormalize(spark, sf):
    small = fx.det(spark, sf).withColumns({c: F.col(c) / 8192 for c in ("xmin", "ymin", "xmax", "ymax")})
    return d.denormalise(small).select("det_id", *[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query(with_views(f""", mapped AS (SELECT det.* EXCLUDE (label), coalesce(b, trim(lower(label))) AS label FROM det LEFT JOIN {_NAMES_SQL} ON trim(lower(label)) = a)
    SELECT det_id, label, confidence, xmin, ymin, xmax, ymax FROM mapped WHERE confidence >= {_LEAST_SQL} AND {_SHAPE_SQL}""", "det"))  # fmt: skip
def postprocess_chain(spark, sf):
    return d.post_process(fx.det(spark, sf), NAMES, THRESHOLDS).select("det_id", "label", "confidence", "xmin", "ymin", "xmax", "ymax")


@query(with_views(f""", mapped AS (SELECT det.* EXCLUDE (label), coalesce(b, trim(lower(label))) AS label FROM det LEFT JOIN {_NAMES_SQL} ON trim(lower(label)) = a),
    clean AS (SELECT * FROM mapped WHERE confidence >= {_LEAST_SQL} AND {_SHAPE_SQL}), scored AS (SELECT * FROM (SELECT *, {PENALISED} AS score FROM clean) WHERE score >= 0.25)"""
    + greedy_sql("raster_id || '/' || label", "scored", "score", "> 0.45") + """ SELECT label, count(*) AS n, round(avg(confidence), 6) AS mean_confidence
    FROM clean WHERE det_id IN (SELECT det_id FROM greedy WHERE det_id = anchor) GROUP BY label""", "det"))  # fmt: skip
def dedup_by_class(spark, sf):
    """The flagship: post-processing, seam penalty, suppression and a count for each class."""
    kept = su.suppress(d.post_process(fx.det(spark, sf), NAMES, THRESHOLDS))
    return kept.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


@query(with_views("SELECT det_id, confidence FROM det WHERE confidence BETWEEN 0.25 AND 0.40", "det"))
def uncertain_band(spark, sf):
    return d.uncertain(fx.det(spark, sf)).select("det_id", "confidence")


@query(with_views("""SELECT det_id, label FROM det WHERE CASE label WHEN 'tent' THEN (xmax - xmin) * (ymax - ymin) * 0.25 BETWEEN 50 AND 400
    WHEN 'vehicle' THEN (xmax - xmin) * (ymax - ymin) * 0.25 BETWEEN 10 AND 900 ELSE TRUE END""", "det"))  # fmt: skip
def physical_scale(spark, sf):
    return d.physical_scale(fx.det(spark, sf), 0.5, SCALES).select("det_id", "label")


@query(with_views("""SELECT det_id, greatest(CAST(trunc(xmin) AS INT) - 20, 0) AS crop_x0, greatest(CAST(trunc(ymin) AS INT) - 20, 0) AS crop_y0, least(CAST(trunc(xmax) AS INT) + 20, 4000) AS crop_x1,
    least(CAST(trunc(ymax) AS INT) + 20, 4000) AS crop_y1, '0 0.5 0.5 0.9 0.9' AS label_line FROM det""", "det"))  # fmt: skip
def hard_negative_crops(spark, sf):
    return d.crop_windows(fx.det(spark, sf), 4000, 4000).select("det_id", "crop_x0", "crop_y0", "crop_x1", "crop_y1", "label_line")


@query(with_views("""SELECT raster_id, '<html><body>' || string_agg(printf('<figure><img src="crops/%d.jpg"><figcaption>%s %.2f</figcaption></figure>', det_id, label, confidence), '' ORDER BY det_id) || '</body></html>' AS html
    FROM det WHERE confidence BETWEEN 0.25 AND 0.40 GROUP BY raster_id""", "det"))  # fmt: skip
def html_gallery(spark, sf):
    return d.gallery(d.uncertain(fx.det(spark, sf)))


@query(with_views("SELECT det_id, round_even(1 / (1 + exp(-least(greatest(confidence * 1.7 - 0.4, -15), 15))), 4) AS calibrated FROM det", "det"))
def platt_apply(spark, sf):
    return d.calibrated(fx.det(spark, sf), 1.7, -0.4).select("det_id", "calibrated")


@query(with_views("SELECT det_id, round(CASE WHEN j > 0 THEN exp(-confidence * 5 / pow(j, 0.6)) ELSE exp(-confidence * 5) END, 6) AS score FROM det", "det"))
def length_norm(spark, sf):
    return d.with_length_score(fx.det(spark, sf), -F.col("confidence") * 5, F.col("j")).select("det_id", F.round("score", 6).alias("score"))


@query()
def platt_fit(spark, sf):
    det = fx.det(spark, sf).withColumn("y", (F.pmod(F.col("det_id") * 31, F.lit(100)) < F.col("confidence") * 100).cast("int"))
    a, b = d.fit_platt(det, "confidence", "y")
    return spark.createDataFrame([(round(a, 6), round(b, 6))], "platt_a double, platt_b double")


_CTX = "(SELECT x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM ctx_boxes WHERE kind = {})"
_TOUCH = "d.xmin <= c.xmax AND c.xmin <= d.xmax AND d.ymin <= c.ymax AND c.ymin <= d.ymax"


def _ctx(spark, sf, kind: int):
    return sp.as_boxes(fx.ctx_boxes(spark, sf).filter(F.col("kind") == kind))


@query(with_views(f"SELECT det_id FROM det d WHERE EXISTS (SELECT 1 FROM {_CTX.format(0)} c WHERE {_TOUCH})", "det", "ctx_boxes"))
def footprint_confirm(spark, sf):
    return sp.confirmed(fx.det(spark, sf), _ctx(spark, sf, 0)).select("det_id")


@query(with_views(f"SELECT det_id, label FROM det d WHERE label NOT IN ('tent', 'trench line') OR NOT EXISTS (SELECT 1 FROM {_CTX.format(1)} c WHERE {_TOUCH})", "det", "ctx_boxes"))
def water_mask(spark, sf):
    return sp.off_water(fx.det(spark, sf), _ctx(spark, sf, 1), ["tent", "trench line"]).select("det_id", "label")


@query(with_views(f"""SELECT det_id, label FROM det d WHERE label <> 'vehicle' OR EXISTS (SELECT 1 FROM det a WHERE a.label = 'military compound' AND a.raster_id = d.raster_id AND {gap_sql('a', 'd')} <= 60)""", "det"))
def relational_distance(spark, sf):
    return sp.near_anchor(fx.det(spark, sf), "vehicle", "military compound", 60.0, keys=("raster_id",)).select("det_id", "label")


@query(with_views(f"""SELECT det_id, label FROM det d WHERE NOT contains(label, 'trench') OR EXISTS (SELECT 1 FROM det a WHERE contains(a.label, 'trench') AND a.raster_id = d.raster_id AND a.det_id <> d.det_id AND {gap_sql('a', 'd')} <= 15)""", "det"))
def trench_continuity(spark, sf):
    return sp.connected(fx.det(spark, sf), keys=("raster_id",)).select("det_id", "label")


@query(with_views(""", c AS (SELECT det_id, raster_id, confidence, (xmin + xmax) / 2 AS x, (ymin + ymax) / 2 AS y FROM det),
    n AS (SELECT a.det_id, count(*) AS n FROM c a JOIN c b ON a.raster_id = b.raster_id AND a.det_id <> b.det_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 100 GROUP BY a.det_id)
    SELECT det_id, coalesce(n, 0) AS neighbours, round(confidence * (1 - least(0.30, coalesce(n, 0) * 0.03)), 6) AS discounted FROM c LEFT JOIN n USING (det_id)""", "det"))  # fmt: skip
def density_discount(spark, sf):
    out = sp.density_discount(fx.det(spark, sf), keys=("raster_id",))
    return out.select("det_id", "neighbours", F.round("discounted", 6).alias("discounted"))


# All rasters stand side by side, and the zones lie over all of them.
@query(with_views(""", wide AS (SELECT 64 * (max(raster_id) + 1) AS w FROM pixels), p AS (SELECT raster_id * 64 + col + 0.5::DOUBLE AS x, row + 0.5::DOUBLE AS y, value FROM pixels WHERE value <> -9999),
    z AS (SELECT ctx_id, (ctx_id * 97) % w AS x0, y0 % 64 AS y0, (ctx_id * 97) % w + (x1 - x0) % 16 AS x1, y0 % 64 + (y1 - y0) % 16 AS y1 FROM ctx_boxes, wide),
    s AS (SELECT ctx_id, sum(value) AS s, avg(value) AS m, max(value) AS x FROM z c JOIN p ON p.x BETWEEN c.x0 AND c.x1 AND p.y BETWEEN c.y0 AND c.y1 GROUP BY ctx_id)
    SELECT ctx_id, coalesce(round_even(CAST(s AS DOUBLE), 2), 0::DOUBLE) AS zone_sum, coalesce(round_even(m, 2), 0::DOUBLE) AS zone_mean, coalesce(round_even(CAST(s.x AS DOUBLE), 2), 0::DOUBLE) AS zone_max FROM ctx_boxes LEFT JOIN s USING (ctx_id)""", "pixels", "ctx_boxes"))  # fmt: skip
def zonal_population(spark, sf):
    c, p = fx.ctx_boxes(spark, sf), fx.pixels(spark, sf)
    width = p.select(64 * (F.max("raster_id") + 1)).scalar()
    x, y, size_x, size_y = (F.col("ctx_id") * 97) % width, F.col("y0") % 64, (F.col("x1") - F.col("x0")) % 16, (F.col("y1") - F.col("y0")) % 16
    zones = c.select("ctx_id", x.cast("double").alias("xmin"), y.alias("ymin"), (x + size_x).alias("xmax"), (y + size_y).alias("ymax"))
    return sp.zonal(zones, p.withColumn("col", F.col("raster_id") * 64 + F.col("col")), id_col="ctx_id").select("ctx_id", "zone_sum", "zone_mean", "zone_max")


@query(with_views(""", c AS (SELECT det_id, raster_id || '/' || label AS g, (xmin + xmax) / 2 AS x, (ymin + ymax) / 2 AS y FROM det),
    sized AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM c),
    pairs AS (SELECT * FROM (SELECT a.g, a.det_id AS a, b.det_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d, a.n,
        row_number() OVER (PARTITION BY a.det_id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.det_id) AS rn FROM sized a JOIN sized b ON a.g = b.g AND a.det_id <> b.det_id WHERE a.n >= 10) WHERE rn <= least(20, n - 1)),
    reach AS (SELECT a, max(d) AS kd FROM pairs GROUP BY a),
    dens AS (SELECT p.a, 1 / (avg(greatest(p.d, r.kd)) + 1e-10) AS lrd FROM pairs p JOIN reach r ON p.b = r.a GROUP BY p.a),
    lof AS (SELECT p.a AS det_id, any_value(p.g) AS g, avg(o.lrd) / any_value(s.lrd) AS lof FROM pairs p JOIN dens o ON p.b = o.a JOIN dens s ON p.a = s.a GROUP BY p.a),
    lim AS (SELECT g, quantile_cont(lof, 0.95) AS q FROM lof GROUP BY g)
    SELECT c.det_id, round(lof, 6) AS lof, lof > q AS is_spatial_anomaly FROM c LEFT JOIN lof USING (det_id) LEFT JOIN lim ON lim.g = lof.g""", "det"))  # fmt: skip
def lof_outliers(spark, sf):
    x, y = boxes.centre(box())
    out = sp.outlier_factor(fx.det(spark, sf).select("det_id", "raster_id", "label", x.alias("x"), y.alias("y")), ["x", "y"], ["raster_id", "label"])
    return out.select("det_id", F.round(F.nanvl("lof", F.lit(None).cast("double")), 6).alias("lof"), "is_spatial_anomaly")


# A single overlap for each box holds up to sf0.01, so the greedy pairs of the SQL are the optimal ones there.
_PAIRS = f""", gt AS (SELECT * FROM det WHERE j = 0), pred AS (SELECT * FROM det WHERE j = 1),
    pairs AS (SELECT gt.label, gt.raster_id, gt.det_id AS gt_id, pred.det_id AS pred_id, {iou_sql('gt', 'pred')} AS iou FROM gt JOIN pred ON gt.raster_id = pred.raster_id AND gt.label = pred.label AND {iou_sql('gt', 'pred')} > 0)"""


def _sides(spark, sf):
    det = fx.det(spark, sf)
    return det.filter("j = 0"), det.filter("j = 1")


@query(with_views(_PAIRS + " SELECT raster_id, label, gt_id, pred_id, round(iou, 6) AS iou FROM pairs", "det"))
def hungarian_full(spark, sf):
    return ev.matches(*_sides(spark, sf)).select("raster_id", "label", "gt_id", "pred_id", F.round("iou", 6).alias("iou"))


# By place alone: boxes of any label meet. Up to sf0.01 this too holds a single overlap for each box.
_PLACE_PAIRS = _PAIRS.replace(" AND gt.label = pred.label", "")


def _report_sql(label: str, pairs: str = _PAIRS) -> str:
    ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN round_even({a} / CAST({b} AS DOUBLE), 4) ELSE 0 END"
    steps = [0.50 + 0.05 * i for i in range(10)]
    hits = ", ".join(f"count(*) FILTER (WHERE iou >= CAST({t!r} AS DOUBLE)) AS tp{i}" for i, t in enumerate(steps))
    ap = [f"({ratio(f'tp{i}', 'np')}) * ({ratio(f'tp{i}', 'ng')})" for i in range(10)]
    tps = ", ".join(f"coalesce(tp{i}, 0) AS tp{i}" for i in range(10))
    return f"""{pairs}, g AS (SELECT {label} AS class, count(*) AS ng, sum((xmax - xmin) * (ymax - ymin)) AS ag FROM gt GROUP BY 1), p AS (SELECT {label} AS class, count(*) AS np, sum((xmax - xmin) * (ymax - ymin)) AS ap FROM pred GROUP BY 1),
    h AS (SELECT {label} AS class, {hits} FROM pairs GROUP BY 1),
    r AS (SELECT class, coalesce(ng, 0) AS ng, coalesce(ag, 0) AS ag, coalesce(np, 0) AS np, coalesce(ap, 0) AS ap, {tps} FROM g FULL JOIN p USING (class) LEFT JOIN h USING (class)),
    q AS (SELECT *, {ratio('tp0', 'np')} AS pr, {ratio('tp0', 'ng')} AS rc FROM r)
    SELECT class, pr AS precision, rc AS recall, CASE WHEN pr + rc > 0 THEN round_even(2 * pr * rc / (pr + rc), 4) ELSE 0 END AS f1_score, tp0 AS tp, np - tp0 AS fp, ng - tp0 AS fn,
        round_even({ap[0]}, 4) AS map_50, round_even(({' + '.join(ap)}) / 10, 4) AS map_50_95, round_even(ag, 2) AS gt_total_area, round_even(ap, 2) AS pred_total_area, round_even(ap - ag, 2) AS area_difference,
        CASE WHEN ag > 0 THEN round_even(ap / ag, 4) ELSE 0 END AS area_ratio FROM q"""


@query(with_views(_report_sql("label"), "det"))
def eval_report(spark, sf):
    gt, pred = _sides(spark, sf)
    return ev.report(gt, pred, ev.matches(gt, pred))


@query(with_views(_report_sql("'object'", _PLACE_PAIRS), "det"))
def eval_location_only(spark, sf):
    gt, pred = map(ev.location_only, _sides(spark, sf))
    return ev.report(gt, pred, ev.matches(gt, pred))


# Each detection's tile: the affine of its raster, half a metre a pixel, rotated for odd rasters.
_AFFINE = "0.5::DOUBLE AS a, CASE WHEN raster_id % 2 = 1 THEN 0.1::DOUBLE ELSE 0::DOUBLE END AS b, 500000::DOUBLE + 1000 * raster_id AS c, CASE WHEN raster_id % 2 = 1 THEN 0.1::DOUBLE ELSE 0::DOUBLE END AS d, -0.5::DOUBLE AS e, 5300000::DOUBLE AS f"
_PLACED = f", placed AS (SELECT *, {_AFFINE} FROM det)"


def _placed(spark, sf):
    turn = F.when(F.col("raster_id") % 2 == 1, 0.1).otherwise(0.0)
    return fx.det(spark, sf).withColumns({"a": F.lit(0.5), "b": turn, "c": 500000.0 + 1000 * F.col("raster_id"), "d": turn, "e": F.lit(-0.5), "f": F.lit(5300000.0)})


def _affine():
    return [F.col(k) for k in "abcdef"]


def _xy(col: str, row: str) -> tuple[str, str]:
    return f"(a * {col} + b * {row} + c)", f"(d * {col} + e * {row} + f)"


def _boxed(p: tuple[str, str], q: tuple[str, str]) -> str:
    return f"round(least({p[0]}, {q[0]}), 6) AS xmin, round(least({p[1]}, {q[1]}), 6) AS ymin, round(greatest({p[0]}, {q[0]}), 6) AS xmax, round(greatest({p[1]}, {q[1]}), 6) AS ymax"


@query(with_views(_PLACED + f" SELECT det_id, {_boxed(_xy('xmin', 'ymin'), _xy('(xmax + 1)', '(ymax + 1)'))} FROM placed", "det"))
def geo_bbox(spark, sf):
    b = boxes.map_box_outer(_affine(), box())
    return _placed(spark, sf).select("det_id", *[F.round(v, 6).alias(n) for v, n in zip(b, ("xmin", "ymin", "xmax", "ymax"), strict=True)])


@query(with_views(_PLACED + f" SELECT det_id, {_boxed(_xy('xmin', 'ymin'), _xy('xmax', 'ymax'))} FROM placed", "det"))
def geo_bbox_corners(spark, sf):
    b = boxes.map_box_corners(_affine(), box())
    return _placed(spark, sf).select("det_id", *[F.round(v, 6).alias(n) for v, n in zip(b, ("xmin", "ymin", "xmax", "ymax"), strict=True)])


_CORNERS = [_xy(*p) for p in (("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"))]


@query(with_views(_PLACED + f" SELECT det_id, {', '.join(f'round({x}, 6) AS x{i}, round({y}, 6) AS y{i}' for i, (x, y) in enumerate(_CORNERS))}, round(abs(a * e - b * d) * (xmax - xmin) * (ymax - ymin), 4) AS area FROM placed", "det"))
def geo_polygon(spark, sf):
    rows = _placed(spark, sf).withColumn("ring", boxes.corners(_affine(), box()))
    at = [F.round(F.get("ring", F.lit(i))[k], 6).alias(f"{k}{i}") for i in range(4) for k in "xy"]
    return rows.select("det_id", *at, F.round(boxes.ring_area(F.col("ring")), 4).alias("area"))


_POINT = "regexp_matches(lower(label), 'tent|aircraft|helicopter|vehicle')"


@query(with_views(_PLACED + f""" SELECT det_id, CASE WHEN {_POINT} THEN 'Point' ELSE 'Polygon' END AS geom_type,
    round(({' + '.join(x for x, _ in _CORNERS)}) / 4, 4) AS x, round(({' + '.join(y for _, y in _CORNERS)}) / 4, 4) AS y FROM placed""", "det"))
def geometry_typing(spark, sf):
    rows = po.placed(_placed(spark, sf), _affine())
    typed = rows.withColumn("typed", po.typed_ring(F.col("ring"), F.col("label")))
    mean = lambda k: F.round(F.aggregate("ring", F.lit(0.0), lambda s, p: s + p[k]) / 4, 4)
    return typed.select("det_id", F.when(F.size("typed") == 1, "Point").otherwise("Polygon").alias("geom_type"), mean("x").alias("x"), mean("y").alias("y"))


# North-up rasters only: there the polygons' overlap is that of their boxes. Points have no area and always stay.
@query(with_views(_PLACED + f""", polys AS (SELECT det_id, raster_id, label, confidence, least(500000 + xmin * 0.5, 500000 + xmax * 0.5) AS xmin, 5300000 - ymax * 0.5 AS ymin, 500000 + xmax * 0.5 AS xmax, 5300000 - ymin * 0.5 AS ymax FROM det WHERE NOT {_POINT})"""
    + greedy_sql("raster_id || '/' || label", "polys", "confidence", "> 0.4") + f" SELECT det_id, label FROM det WHERE {_POINT} OR det_id IN (SELECT det_id FROM greedy WHERE det_id = anchor)", "det"))
def geo_nms(spark, sf):
    det = fx.det(spark, sf)
    point = F.lower("label").rlike("tent|aircraft|helicopter|vehicle")
    t = [F.lit(v) for v in (0.5, 0.0, 500000.0, 0.0, -0.5, 5300000.0)]
    b = boxes.map_box_corners(t, box())
    polys = det.filter(~point).select("det_id", "raster_id", "label", "confidence", *[v.alias(n) for v, n in zip(b, ("xmin", "ymin", "xmax", "ymax"), strict=True)])
    kept = su.suppress(polys, threshold=0.4, least=float("-inf"), penalise=False)
    return kept.select("det_id", "label").unionByName(det.filter(point).select("det_id", "label"))


@query(with_views("SELECT det_id, 'd' || label AS label, xmin + 512 * raster_id AS xmin, ymin AS ymin, 0.85::DOUBLE AS confidence FROM det", "det"))
def raw_output_flat(spark, sf):
    raw = fx.det(spark, sf).select("det_id", (512 * F.col("raster_id")).alias("ox"), F.lit(0).alias("oy"), F.array(F.array(*box())).alias("bboxes"), F.array(F.concat(F.lit(" d"), F.col("label"), F.lit(" "))).alias("labels"))
    return d.flat_detections(raw, offset=("ox", "oy")).select("det_id", "label", "xmin", "ymin", "confidence")
