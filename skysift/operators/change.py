"""Embedding similarity, change grids and their regions, and time series of a site."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skysift.functions.scores import cosine, norm, severity, similarity, unit
from skysift.operators.raster import morphology, neighbours, otsu


def change_map(patches: DataFrame) -> DataFrame:
    """(pair_id, row, col, change): 1 - (cos + 1) / 2 of the two times' patches, within 0 and 1."""
    at = ["pair_id", "row", "col"]
    one, two = (patches.filter(F.col("t") == t).select(*at, F.col("embedding").alias(n)) for t, n in ((0, "e1"), (1, "e2")))
    c = 1 - (cosine(F.col("e1"), F.col("e2")) + 1) / 2
    return one.join(two, at).select(*at, F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)).alias("change"))


def variance_normalised(cells: DataFrame, key: Sequence[str] = ("pair_id",)) -> DataFrame:
    """x var / (var + mean var + 1e-6) by the variance in the 3 x 3 square, within 0 and 1."""
    local = neighbours(cells.withColumnRenamed("change", "value"), key).groupBy(*key, "row", "col").agg(F.first("value").alias("change"), F.greatest(F.avg(F.col("near") * F.col("near")) - F.avg("near") * F.avg("near"), F.lit(0.0)).alias("var"))
    mean = F.avg("var").over(Window.partitionBy(*key))
    x = F.col("change") * F.col("var") / (F.col("var") + mean + 1e-6)
    return local.select(*key, "row", "col", F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)).alias("change"))


def change_mask(cells: DataFrame, *, threshold: float | None = None, key: Sequence[str] = ("pair_id",)) -> DataFrame:
    """(key, row, col, value, change): the cleaned mask by Otsu's or a fixed threshold."""
    k = list(key)
    marked = cells.join(otsu(cells, key), k) if threshold is None else cells.withColumn("threshold", F.lit(threshold))
    mask = marked.select(*k, "row", "col", (F.col("change") >= F.col("threshold")).cast("int").alias("value"))
    return morphology(mask, key).join(cells, [*k, "row", "col"])


def _regions(mask: np.ndarray) -> list[np.ndarray]:
    """Cells of each 4-connected region, by the least of row-major order."""
    label = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        near = label.copy()
        for axis, shift in ((0, 1), (0, -1), (1, 1), (1, -1)):
            moved = np.roll(label, shift, axis)
            edge = [slice(None)] * 2
            edge[axis] = 0 if shift == 1 else -1
            moved[tuple(edge)] = 0
            near = np.where(mask & (moved > 0), np.where(near > 0, np.minimum(near, moved), moved), near)
        if (near == label).all():
            break
        label = near
    return [np.argwhere(label == v) for v in np.unique(label[label > 0])]


def _filled(region: np.ndarray) -> int:
    """Area within the outer ring: the region and its holes."""
    (r0, c0), (r1, c1) = region.min(0), region.max(0)
    grid = np.zeros((r1 - r0 + 3, c1 - c0 + 3), bool)
    grid[region[:, 0] - r0 + 1, region[:, 1] - c0 + 1] = True
    out = np.zeros_like(grid)
    out[0, 0] = True
    while True:
        more = out.copy()
        more[1:] |= out[:-1]
        more[:-1] |= out[1:]
        more[:, 1:] |= out[:, :-1]
        more[:, :-1] |= out[:, 1:]
        more &= ~grid
        if (more == out).all():
            return int((~out).sum())
        out = more


def change_polygons(masked: DataFrame, *, least_area: int = 16, x_offset: int = 0, y_offset: int = 0, key: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Regions of the mask as boxes: severity from the mean tier and confidence from the largest change of the box's slice, one cell more each way."""
    k = list(key)
    out = f"{', '.join(f'{c} long' for c in k)}, xmin double, ymin double, xmax double, ymax double, label string, confidence double, area double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        h, w = int(rows.row.max()) + 1, int(rows.col.max()) + 1
        mask, change = np.zeros((h, w), bool), np.zeros((h, w))
        mask[rows.row, rows.col], change[rows.row, rows.col] = rows.value.to_numpy() > 0, rows.change
        tier = (change >= 0.30).astype(int) + (change >= 0.50) + (change >= 0.70)
        found = []
        for region in _regions(mask):
            area = _filled(region)
            if area < least_area:
                continue
            (y0, x0), (y1, x1) = region.min(0), region.max(0) + 1
            part = np.s_[y0 : y1 + 1, x0 : x1 + 1]
            found.append([*[rows[c].iloc[0] for c in k], x0 + x_offset, y0 + y_offset, x1 + x_offset, y1 + y_offset, f"change_severity_{int(tier[part].mean())}", change[part].max(), area])
        return pd.DataFrame(found, columns=[*k, "xmin", "ymin", "xmax", "ymax", "label", "confidence", "area"])

    return masked.groupBy(*k).applyInPandas(run, out)


def change_pipeline(patches: DataFrame, *, threshold: float | None = None, least_area: int = 16) -> tuple[DataFrame, DataFrame]:
    """(polygons, summary) of all pairs of which both times are there in one size; the others give nothing."""
    from skysift.operators.tiling import change_summary, comparable_pairs

    pairs = comparable_pairs(patches).select("pair_id")
    cells = variance_normalised(change_map(spatial_map(patches.join(pairs, "pair_id", "left_semi"))))
    polygons = change_polygons(change_mask(cells, threshold=threshold), least_area=least_area)
    return polygons, change_summary(polygons, pairs)


def spatial_map(patches: DataFrame, vector: str = "embedding") -> DataFrame:
    """Patches with each cell's embedding at unit length; a whole-tile embedding is a map of one cell."""
    return patches.withColumn(vector, unit(F.col(vector)))


def severity_counts(cells: DataFrame) -> DataFrame:
    return cells.withColumn("severity", severity(F.col("change"))).groupBy("severity").agg(F.count(F.lit(1)).alias("n_cells"))


def series_status(series: DataFrame, *, threshold: float = 0.85) -> DataFrame:
    """Similarity of each step of a site to its first, in the series' own order; sites of one step give nothing."""
    site = Window.partitionBy("site_id")
    order = site.orderBy("seq")
    s = series.withColumn("__first", F.first("embedding").over(order)).withColumn("__n", F.count(F.lit(1)).over(site)).withColumn("__k", F.row_number().over(order)).filter("__n >= 2")
    score = F.when(F.col("__k") == 1, 1.0).otherwise(similarity(F.col("embedding"), F.col("__first")))
    s = s.withColumn("__s", score)
    status = F.when(F.col("__k") == 1, "baseline").when(F.col("__s") >= threshold, "intact").otherwise("altered/destroyed")
    return s.select("site_id", "seq", F.bround("__s", 4).alias("similarity"), status.alias("status"))


def event_window(status: DataFrame) -> DataFrame:
    """Of each site the first altered step and the one before it."""
    order = Window.partitionBy("site_id").orderBy("seq")
    s = status.withColumn("before", F.lag("seq").over(order))
    altered = F.col("status") == "altered/destroyed"
    first = s.groupBy("site_id").agg(F.min(F.when(altered, F.struct("seq", "before"))).alias("f"))
    text = F.when(F.col("f").isNull(), "No significant change detected in sequence.").otherwise(F.concat(F.col("f.before").cast("string"), F.lit(" to "), F.col("f.seq").cast("string")))
    return first.select("site_id", F.col("f.before").alias("pre_event"), F.col("f.seq").alias("post_event"), text.alias("event_window"))


def prototypes(vectors: DataFrame, key: str = "label", vector: str = "embedding") -> DataFrame:
    """The mean of each class's unit vectors, itself not normalised."""
    rows = vectors.select(F.col(key), F.posexplode(unit(F.col(vector))).alias("i", "x"))
    means = rows.groupBy(key, "i").agg(F.avg("x").alias("x"))
    return means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("p")).select(key, F.col("p.x").alias("prototype"))


def verified(det: DataFrame, protos: DataFrame, *, key: str = "label", vector: str = "embedding", alpha: float = 0.5) -> DataFrame:
    """`verified`: the score blended with the similarity to the class's prototype; alone where there is none."""
    s = F.greatest(cosine(F.col(vector), F.col("prototype")), F.lit(0.0))
    out = det.join(F.broadcast(protos), key, "left")  # one row a class
    return out.withColumn("verified", F.bround(F.when(F.col("prototype").isNull(), F.col("confidence")).otherwise(alpha * F.col("confidence") + (1 - alpha) * s), 4)).drop("prototype")


def crop_quality(pixels: DataFrame, key: Sequence[str], *, least: float = 15.0) -> DataFrame:
    """Whether a crop's population variance reaches `least`."""
    return pixels.groupBy(*key).agg(F.var_pop("value").alias("variance")).withColumn("is_good", F.col("variance") >= least)


def shift_estimate(pair: DataFrame, key: Sequence[str] = ("pair_id",), *, steps: int = 50, eps: float = 1e-4) -> DataFrame:
    """Euclidean alignment of the second raster with the first by the enhanced correlation coefficient.

    `pair` has key, row, col, v1, v2. Gauss-Newton on angle and shift; where it
    does not converge, the identity.
    """
    k = list(key)
    out = f"{', '.join(f'{c} long' for c in k)}, theta double, tx double, ty double, rho double"

    def sample(img: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (x >= 0) & (y >= 0) & (x <= img.shape[1] - 1) & (y <= img.shape[0] - 1)
        xi, yi = np.clip(np.floor(x).astype(int), 0, img.shape[1] - 2), np.clip(np.floor(y).astype(int), 0, img.shape[0] - 2)
        fx, fy = x - xi, y - yi
        v = img[yi, xi] * (1 - fx) * (1 - fy) + img[yi, xi + 1] * fx * (1 - fy) + img[yi + 1, xi] * (1 - fx) * fy + img[yi + 1, xi + 1] * fx * fy
        return np.where(ok, v, 0.0), ok

    def align(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float, float]:
        gy, gx = np.gradient(b)
        yy, xx = np.mgrid[: a.shape[0], : a.shape[1]].astype(float)
        p, last = np.zeros(3), -1.0
        for _ in range(steps):
            c, s = np.cos(p[0]), np.sin(p[0])
            x, y = c * xx - s * yy + p[1], s * xx + c * yy + p[2]
            w, ok = sample(b, x, y)
            if ok.sum() < 16:
                return 0.0, 0.0, 0.0, 0.0
            dx, dy = sample(gx, x, y)[0], sample(gy, x, y)[0]
            jac = np.stack([dx * (-s * xx - c * yy) + dy * (c * xx - s * yy), dx, dy], axis=-1)[ok]
            ref, cur = a[ok] - a[ok].mean(), w[ok] - w[ok].mean()
            size = np.linalg.norm(ref) * np.linalg.norm(cur)
            if size < 1e-12:
                return 0.0, 0.0, 0.0, 0.0
            rho = float(ref @ cur / size)
            if abs(rho - last) < eps:
                return float(p[0]), float(p[1]), float(p[2]), rho
            last = rho
            jac = jac - jac.mean(0)
            inv = np.linalg.pinv(jac.T @ jac)
            proj = inv @ (jac.T @ cur)
            num, den = cur @ cur - (jac.T @ cur) @ proj, ref @ cur - (jac.T @ ref) @ proj
            lam = num / den if den > 0 else 1.0
            p = p + inv @ (jac.T @ (lam * ref - cur))
        return float(p[0]), float(p[1]), float(p[2]), last

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        h, w = int(rows.row.max()) + 1, int(rows.col.max()) + 1
        a, b = np.zeros((h, w)), np.zeros((h, w))
        a[rows.row, rows.col], b[rows.row, rows.col] = rows.v1, rows.v2
        return pd.DataFrame([[*[rows[c].iloc[0] for c in k], *align(a, b)]], columns=[*k, "theta", "tx", "ty", "rho"])

    return pair.groupBy(*k).applyInPandas(run, out)


def embedding_norm(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn("unit", unit(F.col(vector))).withColumn("norm", norm(F.col(vector)))
