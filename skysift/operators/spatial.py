"""Spatial joins by grid cells, and what is built on them.

A bare overlap predicate would be planned as a nested loop. Boxes are exploded
to the cells they touch and joined on the cell; a pair is taken only in the
lowest cell that both touch, so it comes once, and then tested exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skysift.functions.boxes import Box, box, centre, gap, intersection, touches

_BOX = ("xmin", "ymin", "xmax", "ymax")


def _cells(df: DataFrame, b: Box, cell: float) -> DataFrame:
    span = lambda a, z: F.sequence(F.floor(a / cell), F.floor(z / cell))
    return df.withColumn("__cx", F.explode(span(b[0], b[2]))).withColumn("__cy", F.explode(span(b[1], b[3])))


def overlapping_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), *, cell: float = 256.0, reach: float = 0.0) -> DataFrame:
    """All pairs whose closed boxes, the left grown by `reach`, touch; columns get l_ and r_.

    Boxes with an end before their start, or without one, touch nothing.
    """
    l, r = (d.select(*[F.col(c).alias(p + c) for c in d.columns]) for d, p in ((left, "l_"), (right, "r_")))
    a, b = box("l_"), box("r_")
    grown = (a[0] - reach, a[1] - reach, a[2] + reach, a[3] + reach)
    l, r = (d.filter((x[0] <= x[2]) & (x[1] <= x[3])) for d, x in ((l, grown), (r, b)))
    cells = _cells(l, grown, cell).join(_cells(r, b, cell).withColumnsRenamed({"__cx": "__dx", "__cy": "__dy"}), (F.col("__cx") == F.col("__dx")) & (F.col("__cy") == F.col("__dy")) & _same(keys))
    first = (F.col("__cx") == F.greatest(F.floor(grown[0] / cell), F.floor(b[0] / cell))) & (F.col("__cy") == F.greatest(F.floor(grown[1] / cell), F.floor(b[1] / cell)))
    return cells.filter(first & touches(grown, b)).drop("__cx", "__cy", "__dx", "__dy")


def touched_ids(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), *, id_col: str, cell: float = 256.0, also: Column | None = None) -> DataFrame:
    """The ids of `left` that touch a row of `right` for which `also` (a condition on l_ and r_ columns) holds; ids may come more than once.

    A semi-join in the cells: a box is done with at the first row that it
    touches, so no pairs are made, however many rows lie over it. Equal rows of
    `right` are taken once. The cells are exploded, which the planner's sizes
    do not show, so they may not be broadcast.
    """
    l, r = (d.select(*[F.col(c).alias(p + c) for c in d.columns]) for d, p in ((left, "l_"), (right.distinct(), "r_")))
    a, b = box("l_"), box("r_")
    l, r = (d.filter((x[0] <= x[2]) & (x[1] <= x[3])) for d, x in ((l, a), (r, b)))
    there = _cells(r, b, cell).withColumnsRenamed({"__cx": "__dx", "__cy": "__dy"}).hint("merge")
    meets = (F.col("__cx") == F.col("__dx")) & (F.col("__cy") == F.col("__dy")) & _same(keys) & touches(a, b)
    return _cells(l, a, cell).join(there, meets if also is None else meets & also, "left_semi").select(F.col(f"l_{id_col}").alias(id_col))


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    return out


def as_boxes(df: DataFrame, names: Sequence[str] = ("x0", "y0", "x1", "y1")) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(names, _BOX, strict=True)))


def confirmed(det: DataFrame, footprints: DataFrame, *, id_col: str = "det_id", least_share: float | None = None) -> DataFrame:
    """Detections that touch a footprint; with `least_share`, by that share of their area with one footprint."""
    share = None if least_share is None else intersection(box("l_"), box("r_")) >= least_share * (F.col("l_xmax") - F.col("l_xmin")) * (F.col("l_ymax") - F.col("l_ymin"))
    return det.join(touched_ids(det.select(id_col, *_BOX), footprints.select(*_BOX), id_col=id_col, also=share), id_col, "left_semi")


def off_water(det: DataFrame, water: DataFrame, land_only: Sequence[str], *, id_col: str = "det_id") -> DataFrame:
    """All but the land-only classes' detections that touch water."""
    land = det.filter(F.col("label").isin(list(land_only)))
    wet = touched_ids(land.select(id_col, *_BOX), water.select(*_BOX), id_col=id_col)
    return det.join(wet, id_col, "left_anti")


def near_anchor(det: DataFrame, target: str, anchor: str, distance: float, *, keys: Sequence[str] = (), id_col: str = "det_id") -> DataFrame:
    """All but the targets without an anchor within the distance."""
    cols = [id_col, *keys, *_BOX]
    pairs = overlapping_pairs(det.filter(F.col("label") == target).select(*cols), det.filter(F.col("label") == anchor).select(*cols), keys, reach=distance)
    near = pairs.filter(gap(box("l_"), box("r_")) <= distance).select(F.col(f"l_{id_col}").alias(id_col)).distinct()
    return det.join(near.withColumn("__near", F.lit(True)), id_col, "left").filter((F.col("label") != target) | F.col("__near")).drop("__near")


def connected(det: DataFrame, word: str = "trench", distance: float = 15.0, *, keys: Sequence[str] = (), id_col: str = "det_id") -> DataFrame:
    """All but the segments (labels that hold `word`) without another segment within the distance."""
    cols = [id_col, *keys, *_BOX]
    part = det.filter(F.col("label").contains(word)).select(*cols)
    pairs = overlapping_pairs(part, part, keys, reach=distance).filter((F.col(f"l_{id_col}") != F.col(f"r_{id_col}")) & (gap(box("l_"), box("r_")) <= distance))
    linked = pairs.select(F.col(f"l_{id_col}").alias(id_col)).distinct().withColumn("__linked", F.lit(True))
    return det.join(linked, id_col, "left").filter(~F.col("label").contains(word) | F.col("__linked")).drop("__linked")


def density_discount(det: DataFrame, *, radius: float = 100.0, each: float = 0.03, most: float = 0.30, least_rows: int = 5, keys: Sequence[str] = (), id_col: str = "det_id") -> DataFrame:
    """`discounted`: the score less a share for each other detection with its centre within the radius."""
    cx, cy = centre(box())
    points = det.select(id_col, *keys, cx.alias("xmin"), cy.alias("ymin"), cx.alias("xmax"), cy.alias("ymax"))
    near = overlapping_pairs(points, points, keys, reach=radius).filter((F.col(f"l_{id_col}") != F.col(f"r_{id_col}")) & (gap(box("l_"), box("r_")) <= radius))
    count = near.groupBy(F.col(f"l_{id_col}").alias(id_col)).agg(F.count(F.lit(1)).alias("neighbours"))
    out = det.join(count, id_col, "left").withColumn("neighbours", F.coalesce("neighbours", F.lit(0)))
    enough = det.agg(F.count(F.lit(1)).alias("n")).select("n").scalar() >= least_rows
    less = F.least(F.lit(most), F.col("neighbours") * each)
    return out.withColumn("discounted", F.when(enough, F.least(F.greatest(F.col("confidence") * (1 - less), F.lit(0.0)), F.lit(1.0))).otherwise(F.col("confidence")))


def zonal(polygons: DataFrame, pixels: DataFrame, *, id_col: str, cell: float = 64.0, nodata: float = -9999.0) -> DataFrame:
    """sum, mean and max of the pixels with their centre within each box, rounded to 2; 0 where there are none."""
    points = pixels.filter(F.col("value") != nodata).select("value", (F.col("col") + 0.5).alias("xmin"), (F.col("row") + 0.5).alias("ymin"), (F.col("col") + 0.5).alias("xmax"), (F.col("row") + 0.5).alias("ymax"))
    pairs = overlapping_pairs(polygons.select(id_col, *_BOX), points, cell=cell)
    stats = pairs.groupBy(F.col(f"l_{id_col}").alias(id_col)).agg(F.sum("r_value").alias("s"), F.avg("r_value").alias("m"), F.max("r_value").alias("x"))
    out = polygons.join(stats, id_col, "left")
    return out.select(*polygons.columns, *[F.coalesce(F.bround(F.col(c).cast("double"), 2), F.lit(0.0)).alias(n) for c, n in (("s", "zone_sum"), ("m", "zone_mean"), ("x", "zone_max"))])


def probe_tiles(points: DataFrame, tiles: DataFrame, *, point_id: str, tile_id: str, reach: float = 1e-6) -> DataFrame:
    """(point, tile) for every tile whose box meets a small box around the point."""
    p = points.select(point_id, F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"))
    return overlapping_pairs(p, tiles.select(tile_id, *_BOX), reach=reach, cell=8.0).select(F.col(f"l_{point_id}").alias(point_id), F.col(f"r_{tile_id}").alias(tile_id))


def outlier_factor(df: DataFrame, features: Sequence[str], group: Sequence[str], *, k: int = 20, share: float = 0.05, id_col: str = "det_id", least_rows: int = 10) -> DataFrame:
    """`lof`, the local outlier factor within a group, and `is_spatial_anomaly` beyond the share's percentile; null in groups of fewer than `least_rows`.

    Neighbours are ordered by distance, then id. Distances are made for a block
    of rows at a time, so memory grows with the group and not with its square.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("lof", T.DoubleType()), T.StructField("is_spatial_anomaly", T.BooleanType())])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows["lof"], rows["is_spatial_anomaly"] = np.nan, None
        n = len(rows)
        if n < least_rows:
            return rows
        x, ids = rows[list(features)].to_numpy(float), rows[id_col].to_numpy()
        m = min(k, n - 1)
        near, dist = np.empty((n, m), np.int64), np.empty((n, m))
        for a in range(0, n, 256):
            d = np.sqrt(((x[a : a + 256, None, :] - x[None, :, :]) ** 2).sum(-1))
            d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
            order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=-1)[:, :m]
            near[a : a + 256], dist[a : a + 256] = order, np.take_along_axis(d, order, 1)
        reach = np.maximum(dist, dist[:, -1][near])
        density = 1 / (reach.mean(1) + 1e-10)
        rows["lof"] = density[near].mean(1) / density
        rows["is_spatial_anomaly"] = rows["lof"] > np.quantile(rows["lof"], 1 - share)
        return rows

    return df.groupBy(*group).applyInPandas(run, schema)
