"""Clean-up, scoring and filtering of detections (xmin, ymin, xmax, ymax, label, confidence)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.functions.boxes import area, box, on_seam
from skysift.functions.scores import length_normalised, normal_label, platt


def lookup(df: DataFrame, rows: list[tuple], schema: str, key: Column) -> DataFrame:
    """`df` left joined with a small literal table (its first column is the key)."""
    table = df.sparkSession.createDataFrame(rows, schema)
    return df.join(F.broadcast(table), key == table[table.columns[0]], "left").drop(table[table.columns[0]])


def map_labels(df: DataFrame, names: Mapping[str, str], label: str = "label") -> DataFrame:
    """Labels in lower case without outer blanks, then by the map where it has them."""
    out = df.withColumn(label, normal_label(F.col(label)))
    if not names:
        return out
    return lookup(out, list(names.items()), "__from string, __to string", F.col(label)).withColumn(label, F.coalesce("__to", label)).drop("__to")


def above_class_threshold(df: DataFrame, thresholds: Mapping[str, float], default: float = 0.30, label: str = "label", score: str = "confidence") -> DataFrame:
    """Detections that reach their class's threshold; null and NaN scores go."""
    kept = df.filter(F.col(score).isNotNull() & ~F.isnan(score))
    if not thresholds:
        return kept.filter(F.col(score) >= default)
    rows = [(k, float(v)) for k, v in thresholds.items()]
    return lookup(kept, rows, "__class string, __least double", F.col(label)).filter(F.col(score) >= F.coalesce("__least", F.lit(default))).drop("__least")


def denormalise(df: DataFrame, tile: int = 512) -> DataFrame:
    """Coordinates times the tile size, if none in the whole frame is above 1."""
    most = df.agg(F.max(F.greatest(*box())).alias("m")).select("m").scalar()
    return df.withColumns({c: F.when(most <= 1.0, F.col(c) * tile).otherwise(F.col(c)) for c in ("xmin", "ymin", "xmax", "ymax")})


def plausible_shape(df: DataFrame, least: float = 10, most: float = 250_000, aspect: float = 10) -> DataFrame:
    """Boxes with an area between the limits and sides in a ratio of `aspect` at the most."""
    b = box()
    w, h = F.abs(b[2] - b[0]) * F.signum(b[2] - b[0]), b[3] - b[1]
    short = F.when(F.least(w, h) == 0, 1e-6).otherwise(F.least(w, h))
    return df.filter(area(b).between(least, most) & (F.greatest(w, h) / short <= aspect))


def post_process(df: DataFrame, names: Mapping[str, str], thresholds: Mapping[str, float], default: float = 0.30, tile: int = 512) -> DataFrame:
    """Label map, class thresholds, denormalisation, shape filter, in this order."""
    return plausible_shape(denormalise(above_class_threshold(map_labels(df, names), thresholds, default), tile))


def uncertain(df: DataFrame, low: float = 0.25, high: float = 0.40) -> DataFrame:
    return df.filter(F.col("confidence").between(low, high))


def physical_scale(df: DataFrame, gsd: float, scales: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Boxes of a physical area within their class's limits; classes without limits pass."""
    rows = [(k, float(a), float(b)) for k, (a, b) in scales.items()]
    out = lookup(df, rows, "__class string, __low double, __high double", F.col("label"))
    size = area(box()) * gsd**2
    return out.filter(F.col("__low").isNull() | size.between(F.col("__low"), F.col("__high"))).drop("__low", "__high")


def edge_penalty(df: DataFrame, tile: int = 512, margin: int = 8, factor: float = 0.70, out: str = "penalised") -> DataFrame:
    return df.withColumn(out, F.when(on_seam(box(), tile, margin), F.col("confidence") * factor).otherwise(F.col("confidence")))


def calibrated(df: DataFrame, a: float = 1.0, b: float = 0.0, out: str = "calibrated") -> DataFrame:
    return df.withColumn(out, platt(F.col("confidence"), a, b))


def with_length_score(df: DataFrame, log_likelihood: Column, length: Column, out: str = "score") -> DataFrame:
    return df.withColumn(out, length_normalised(log_likelihood, length))


def fit_platt(df: DataFrame, score: str, target: str, *, steps: int = 50) -> tuple[float, float]:
    """(a, b) that minimise the cross entropy of 1 / (1 + exp(-(a s + b))), by Newton steps of one aggregate each."""
    a, b = 1.0, 0.0
    s, y = F.col(score).cast("double"), F.col(target).cast("double")
    for _ in range(steps):
        p = 1 / (1 + F.exp(-F.least(F.greatest(s * a + b, F.lit(-15.0)), F.lit(15.0))))
        w = p * (1 - p)
        g0, g1, h00, h01, h11 = df.agg(F.avg((p - y) * s), F.avg(p - y), F.avg(w * s * s), F.avg(w * s), F.avg(w)).first()
        if g0 is None:
            return 1.0, 0.0
        h00, h11 = h00 + 1e-9, h11 + 1e-9
        det = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def flat_detections(df: DataFrame, boxes: str = "bboxes", labels: str = "labels", confidence: float = 0.85, offset: tuple[str, str] | None = None) -> DataFrame:
    """One row for each box of a model's raw output (parallel arrays), moved by a tile's offset."""
    keep = [c for c in df.columns if c not in (boxes, labels)]
    rows = df.select(*keep, F.explode(F.arrays_zip(F.col(boxes).alias("b"), F.col(labels).alias("l"))).alias("d"))
    dx, dy = (F.col(offset[0]), F.col(offset[1])) if offset else (F.lit(0), F.lit(0))
    at = [F.get("d.b", F.lit(i)) + (dx if i % 2 == 0 else dy) for i in range(4)]
    return rows.select(*keep, *[c.cast("double").alias(n) for c, n in zip(at, ("xmin", "ymin", "xmax", "ymax"), strict=True)], F.trim("d.l").alias("label"), F.lit(confidence).alias("confidence"))


def crop_windows(df: DataFrame, width: int, height: int, margin: int = 20) -> DataFrame:
    """Training crops: the box with a margin, clamped to the image, and its constant label line."""
    return df.select(
        "*",
        F.greatest(F.col("xmin").cast("int") - margin, F.lit(0)).alias("crop_x0"),
        F.greatest(F.col("ymin").cast("int") - margin, F.lit(0)).alias("crop_y0"),
        F.least(F.col("xmax").cast("int") + margin, F.lit(width)).alias("crop_x1"),
        F.least(F.col("ymax").cast("int") + margin, F.lit(height)).alias("crop_y1"),
        F.lit("0 0.5 0.5 0.9 0.9").alias("label_line"),
    )


def gallery(df: DataFrame) -> DataFrame:
    """An HTML page of all detections, one figure each, by id, for each raster."""
    figure = F.format_string('<figure><img src="crops/%s.jpg"><figcaption>%s %.2f</figcaption></figure>', F.col("det_id").cast("string"), F.col("label"), F.col("confidence"))
    rows = df.groupBy("raster_id").agg(F.array_sort(F.collect_list(F.struct("det_id", figure.alias("f")))).alias("r"))
    return rows.select("raster_id", F.concat(F.lit("<html><body>"), F.array_join(F.col("r.f"), ""), F.lit("</body></html>")).alias("html"))


DETECTION = T.StructType([*[T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")], T.StructField("label", T.StringType()), T.StructField("confidence", T.DoubleType())])
