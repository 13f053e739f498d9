"""Polygons as rings of struct(x, y), without the closing point: exact predicates, and the operators on them.

Pairs come from the grid join on the rings' boxes and are then tested exactly
by column expressions. A ring may be of any simple shape for the predicates;
overlap areas need convex rings, such as the affine images of boxes. A ring of
one point is a point; boundaries belong to their polygon.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.functions.boxes import Box, any_of, box, corners, let, ring_area, ring_box
from skysift.functions.scores import rounded
from skysift.functions.utm import reprojected
from skysift.operators.spatial import overlapping_pairs, touched_ids
from skysift.plans.tables import written

_BOX = ("xmin", "ymin", "xmax", "ymax")

#: Labels with one of these words stand for points.
POINT_WORDS = ("tent", "aircraft", "helicopter", "vehicle")


def box_ring(b: Box) -> Column:
    at = [(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])]
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in at])


def _turn(p: Column, q: Column, r: Column) -> Column:
    """Twice the signed area of a triangle."""
    return (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])


def _on(p: Column, q: Column, r: Column) -> Column:
    """Whether r lies on the segment from p to q."""
    within = r["x"].between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & r["y"].between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"]))
    return within & (_turn(p, q, r) == 0)


def _edges(ring: Column) -> Column:
    """struct(p, q) of each edge, the last back to the first point."""
    return F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.get(ring, (i + 1) % F.size(ring)).alias("q")))


def _edges_meet(e: Column, f: Column) -> Column:
    p, q, r, s = e["p"], e["q"], f["p"], f["q"]
    crossed = (_turn(p, q, r) * _turn(p, q, s) < 0) & (_turn(r, s, p) * _turn(r, s, q) < 0)
    return crossed | any_of([_on(p, q, r), _on(p, q, s), _on(r, s, p), _on(r, s, q)])


def holds_point(ring: Column, point: Column) -> Column:
    """Whether a ring holds a point: an odd number of edges to its right, or a boundary point."""
    e, x, y = _edges(ring), point["x"], point["y"]
    right = lambda s: ((s["p"]["y"] > y) != (s["q"]["y"] > y)) & (x < (s["q"]["x"] - s["p"]["x"]) * (y - s["p"]["y"]) / (s["q"]["y"] - s["p"]["y"]) + s["p"]["x"])
    return F.exists(e, lambda s: _on(s["p"], s["q"], point)) | (F.size(F.filter(e, right)) % 2 == 1)


def rings_meet(a: Column, b: Column) -> Column:
    """Whether two rings share a point: their edges meet, or one lies within the other."""
    # The cheaper tests first; the edges of b are made once.
    edges = let(_edges(b), lambda other: F.exists(_edges(a), lambda e: F.exists(other, lambda f: _edges_meet(e, f))))
    return holds_point(a, F.get(b, F.lit(0))) | holds_point(b, F.get(a, F.lit(0))) | edges


def meets_box(ring: Column, b: Box) -> Column:
    """Whether a ring shares a point with a box: one of its edges does, or it holds a corner, and so the box."""
    corner = [F.struct(x.alias("x"), y.alias("y")) for x, y in ((b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3]))]

    def met(e: Column) -> Column:
        p, q = e["p"], e["q"]
        near = (F.least(p["x"], q["x"]) <= b[2]) & (F.greatest(p["x"], q["x"]) >= b[0]) & (F.least(p["y"], q["y"]) <= b[3]) & (F.greatest(p["y"], q["y"]) >= b[1])
        # Corners on both sides of the edge's line, or on it.
        sides = [_turn(p, q, c) for c in corner]
        return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.exists(_edges(ring), met) | holds_point(ring, corner[0])


def shared_area(a: Column, b: Column) -> Column:
    """The area that two convex rings share: the one cut by each edge of the other."""
    none = F.array().cast("array<struct<x:double,y:double>>")
    # Coordinates near the origin keep the digits of the products.
    near = lambda ring: F.transform(ring, lambda p: F.struct((p["x"] - F.get(a, F.lit(0))["x"]).alias("x"), (p["y"] - F.get(a, F.lit(0))["y"]).alias("y")))
    turned = lambda edges: F.signum(F.aggregate(edges, F.lit(0.0), lambda s, e: s + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]))

    def cut(ring: Column, edge: Column, sign: Column) -> Column:
        """The part of a ring on the inner side of an edge: its points there, and where its edges pass over."""
        sided = F.transform(ring, lambda p: F.struct(p.alias("p"), (_turn(edge["p"], edge["q"], p) * sign).alias("d")))

        def step(points: Column) -> Column:
            def part(to: Column, i: Column) -> Column:
                def passed(at: Column) -> Column:
                    t = at["d"] / (at["d"] - to["d"])
                    return F.struct((at["p"]["x"] + t * (to["p"]["x"] - at["p"]["x"])).alias("x"), (at["p"]["y"] + t * (to["p"]["y"] - at["p"]["y"])).alias("y"))

                into = lambda at: F.when((at["d"] >= 0) != (to["d"] >= 0), F.array(passed(at))).otherwise(none)
                return F.concat(let(F.get(points, (i + F.size(points) - 1) % F.size(points)), into), F.when(to["d"] >= 0, F.array(to["p"])).otherwise(none))

            return F.flatten(F.transform(points, part))

        return let(sided, step)

    clipped = lambda edges: let(turned(edges), lambda sign: F.aggregate(edges, near(a), lambda ring, edge: cut(ring, edge, sign)))
    area = lambda rest: F.when(F.size(rest) >= 3, ring_area(rest)).otherwise(0.0)
    return F.when((F.size(a) >= 3) & (F.size(b) >= 3), let(let(_edges(near(b)), clipped), area)).otherwise(0.0)


def ring_iou(a: Column, b: Column) -> Column:
    """Share of the united area that two convex rings have in common; 0 where one has no area."""
    area = lambda ring: F.when(F.size(ring) >= 3, ring_area(ring)).otherwise(0.0)
    ratio = lambda s: F.when(s["both"] > s["shared"], s["shared"] / (s["both"] - s["shared"])).otherwise(0.0)
    return let(F.struct(shared_area(a, b).alias("shared"), (area(a) + area(b)).alias("both")), ratio)


def polygon_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), *, ring: str = "ring", cell: float = 256.0) -> DataFrame:
    """All pairs of rows whose rings share a point; columns get l_ and r_. Null and empty rings meet nothing."""
    l, r = (d.drop(*_BOX).withColumns(dict(zip(_BOX, ring_box(F.col(ring)), strict=True))) for d in (left, right))
    pairs = overlapping_pairs(l, r, keys, cell=cell)
    return pairs.filter(rings_meet(F.col(f"l_{ring}"), F.col(f"r_{ring}"))).drop(*[p + c for p in ("l_", "r_") for c in _BOX])


def _shaped(df: DataFrame, ring: str) -> DataFrame:
    """The box of each ring, and `__boxed`: whether the ring is its box, as `box_ring` makes it."""
    r, b = F.col(ring), box()
    at = lambda p, i: (p["x"] == F.when((i == 0) | (i == 3), b[0]).otherwise(b[2])) & (p["y"] == F.when(i < 2, b[1]).otherwise(b[3]))
    boxed = (F.size(r) == 4) & ~F.isnan(b[2]) & ~F.isnan(b[3]) & F.forall(F.transform(r, at), lambda same: same)
    return df.withColumns(dict(zip(_BOX, ring_box(r), strict=True))).withColumn("__boxed", F.coalesce(boxed, F.lit(False)))


def touched_polygons(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), *, id_col: str, ring: str = "ring", also: Column | None = None) -> DataFrame:
    """The ids of `left` whose ring shares a point with one of `right` for which `also` holds; a semi-join, so no pairs are made."""
    l, r = _shaped(left.select(id_col, *keys, ring), ring), _shaped(right.select(*keys, ring), ring)
    a, b = F.col(f"l_{ring}"), F.col(f"r_{ring}")
    # A box takes a quarter of the tests of edges.
    exact = F.when(F.col("l___boxed"), meets_box(b, box("l_"))).when(F.col("r___boxed"), meets_box(a, box("r_"))).otherwise(rings_meet(a, b))
    return touched_ids(l, r, keys, id_col=id_col, also=exact if also is None else exact & also)


def confirmed_polygons(det: DataFrame, footprints: DataFrame, *, id_col: str = "det_id", keys: Sequence[str] = (), ring: str = "ring", least_share: float | None = None) -> DataFrame:
    """Detections that touch a footprint; with `least_share`, by that share of their area with one (convex) footprint."""
    share = None if least_share is None else shared_area(F.col(f"l_{ring}"), F.col(f"r_{ring}")) >= least_share * ring_area(F.col(f"l_{ring}"))
    return det.join(touched_polygons(det, footprints, keys, id_col=id_col, ring=ring, also=share), id_col, "left_semi")


def dry_polygons(det: DataFrame, water: DataFrame, land_only: Sequence[str], *, id_col: str = "det_id", keys: Sequence[str] = (), ring: str = "ring") -> DataFrame:
    """All but the land-only classes' detections that touch water."""
    land = det.filter(F.col("label").isin(list(land_only)))
    return det.join(touched_polygons(land, water, keys, id_col=id_col, ring=ring), id_col, "left_anti")


def zonal_polygons(zones: DataFrame, pixels: DataFrame, *, id_col: str, ring: str = "ring", cell: float = 64.0, nodata: float = -9999.0) -> DataFrame:
    """sum, mean and max of the pixels with their centre within each ring, rounded to 2; 0 where there are none."""
    x, y = F.col("col") + 0.5, F.col("row") + 0.5
    points = pixels.filter(F.col("value") != nodata).select("value", x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax"))
    boxed = zones.select(id_col, ring).withColumns(dict(zip(_BOX, ring_box(F.col(ring)), strict=True)))
    held = overlapping_pairs(boxed, points, cell=cell).filter(holds_point(F.col(f"l_{ring}"), F.struct(F.col("r_xmin").alias("x"), F.col("r_ymin").alias("y"))))
    stats = held.groupBy(F.col(f"l_{id_col}").alias(id_col)).agg(F.sum("r_value").alias("s"), F.avg("r_value").alias("m"), F.max("r_value").alias("x"))
    out = zones.join(stats, id_col, "left")
    return out.select(*zones.columns, *[F.coalesce(rounded(F.col(c).cast("double"), 2), F.lit(0.0)).alias(n) for c, n in (("s", "zone_sum"), ("m", "zone_mean"), ("x", "zone_max"))])


def typed_ring(ring: Column, label: Column) -> Column:
    """The ring, or for labels of point objects the one point at the mean of its corners."""
    n = F.size(ring)
    mean = lambda k: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[k]) / n
    point = any_of([F.lower(label).contains(w) for w in POINT_WORDS])
    return F.when(point & (n > 0), F.array(F.struct(mean("x").alias("x"), mean("y").alias("y")))).otherwise(ring)


def placed(det: DataFrame, transform: Sequence[Column], *, source: Column | None = None, target: int | None = None) -> DataFrame:
    """Detections with the `ring` of their pixel box in the raster's reference system, or moved from EPSG `source` to `target`."""
    ring = corners(list(transform), tuple(F.col(c) for c in _BOX))
    return det.withColumn("ring", ring if target is None else reprojected(ring, source, F.lit(target)))


def suppress_polygons(det: DataFrame, keys: Sequence[str] = ("raster_id", "label"), *, threshold: float = 0.4, id_col: str = "det_id", ring: str = "ring", score: str = "confidence") -> DataFrame:
    """Greedy suppression of convex rings by score, then id, within `keys`; points overlap nothing and stay.

    The rings are written once, since both sides of the join read them.
    Overlaps are found by joins; a group then sends only its ids, scores and
    overlaps to one task, and no geometry. Rows need an id of their own.
    """
    side = det.filter(F.size(ring) >= 3).select(id_col, *keys, ring, F.col(score).alias("s"))
    boxed = written(side.withColumns(dict(zip(_BOX, ring_box(F.col(ring)), strict=True))), "polygons")
    first = (F.col("l_s") > F.col("r_s")) | ((F.col("l_s") == F.col("r_s")) & (F.col(f"l_{id_col}") < F.col(f"r_{id_col}")))
    pairs = overlapping_pairs(boxed, boxed, keys).filter(first).filter(ring_iou(F.col(f"l_{ring}"), F.col(f"r_{ring}")) > threshold)
    edges = pairs.select(*[F.col(f"l_{k}").alias(k) for k in keys], F.col(f"l_{id_col}").alias("up"), F.col(f"l_s").alias("s"), F.col(f"r_{id_col}").alias("down"))

    def kernel(rows: pd.DataFrame) -> pd.DataFrame:
        beaten = set()
        for up, down in rows.sort_values(["s", "up"], ascending=[False, True])[["up", "down"]].itertuples(index=False):
            if up not in beaten:
                beaten.add(down)
        return pd.DataFrame({id_col: np.array(list(beaten))})

    gone = edges.groupBy(*keys).applyInPandas(kernel, f"{id_col} {det.schema[id_col].dataType.simpleString()}")
    return det.join(gone, id_col, "left_anti")


def detection_layer(det: DataFrame, *, prompt: str, acquired: str = "Unknown", threshold: float = 0.4, keys: Sequence[str] = ("source_raster", "label"), id_col: str = "det_id") -> DataFrame:
    """The rows of a detection layer: typed geometry, suppressed within `keys`, with where they come from."""
    typed = det.withColumn("ring", typed_ring(F.col("ring"), F.col("label")))
    kept = suppress_polygons(typed, keys, threshold=threshold, id_col=id_col)
    return kept.select("ring", "label", "confidence", F.lit(prompt).alias("prompt_used"), F.lit(acquired).alias("acquisition_date"), "source_raster", "tile_filename")
