"""Suppression and fusion of overlapping boxes.

The greedy kernels run in grouped maps, a group being what may interact: one
raster and label, or one raster. Within a group boxes are taken in blocks of
a grid on their centres, so memory stays with the overlaps, not with the square
of the group. Order is total: score descending, then id.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.functions.boxes import box, iou
from skysift.operators.detections import edge_penalty


def pair_iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of one box (or a column of boxes) with boxes."""
    w = np.minimum(a[..., 2], b[..., 2]) - np.maximum(a[..., 0], b[..., 0])
    h = np.minimum(a[..., 3], b[..., 3]) - np.maximum(a[..., 1], b[..., 1])
    inter = np.clip(w, 0, None) * np.clip(h, 0, None)
    union = (a[..., 2] - a[..., 0]) * (a[..., 3] - a[..., 1]) + (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1]) - inter
    return np.where(union > 0, inter / np.where(union > 0, union, 1), 0.0)


class Neighbours:
    """Boxes by grid cells of the largest box side: candidates that may overlap a box."""

    def __init__(self, boxes: np.ndarray):
        self.boxes = boxes
        side = max(float((boxes[:, 2:] - boxes[:, :2]).max(initial=0)), 1e-9)
        self.cell = np.floor((boxes[:, :2] + boxes[:, 2:]) / 2 / side).astype(np.int64)
        self.by_cell: dict[tuple[int, int], list[int]] = {}
        for i, (x, y) in enumerate(self.cell.tolist()):
            self.by_cell.setdefault((x, y), []).append(i)

    def near(self, i: int) -> np.ndarray:
        x, y = self.cell[i].tolist()
        return np.array([k for dx in (-1, 0, 1) for dy in (-1, 0, 1) for k in self.by_cell.get((x + dx, y + dy), ())])


def greedy_owner(boxes: np.ndarray, scores: np.ndarray, ids: np.ndarray, threshold: float, closed: bool) -> np.ndarray:
    """For each box the row of the first box, by rank, that is kept and overlaps it; its own row if it is kept."""
    order = np.lexsort((ids, -scores))
    owner = np.full(len(boxes), -1)
    grid = Neighbours(boxes)
    for i in order:
        if owner[i] >= 0:
            continue
        owner[i] = i
        near = grid.near(i)
        near = near[owner[near] < 0]
        if len(near):
            overlap = pair_iou(boxes[i], boxes[near])
            owner[near[overlap >= threshold if closed else overlap > threshold]] = i
    return owner


_BOX = ["xmin", "ymin", "xmax", "ymax"]


def suppress(df: DataFrame, keys: Sequence[str] = ("raster_id", "label"), *, threshold: float = 0.45, least: float = 0.25, penalise: bool = True, id_col: str = "det_id", score: str = "confidence") -> DataFrame:
    """Greedy suppression within `keys`; scores are ranked with the seam penalty but returned without it."""
    ranked = edge_penalty(df, out="__score") if penalise else df.withColumn("__score", F.col(score))
    ranked = ranked.filter(F.col("__score") >= least)

    def kernel(rows: pd.DataFrame) -> pd.DataFrame:
        owner = greedy_owner(rows[_BOX].to_numpy(float), rows["__score"].to_numpy(float), rows[id_col].to_numpy(), threshold, closed=False)
        return rows[owner == np.arange(len(rows))]

    return ranked.groupBy(*keys).applyInPandas(kernel, ranked.schema).drop("__score")


def suppress_by_rounds(df: DataFrame, keys: Sequence[str] = ("raster_id", "label"), *, threshold: float = 0.45, least: float = 0.25, penalise: bool = True, id_col: str = "det_id") -> DataFrame:
    """The same result by joins alone, for groups too large for one task.

    A box whose better neighbours are all decided is decided: kept if none of
    them is kept. Each round decides at least the best of every open cluster, and
    rounds go on until no box is open: a chain takes as many as it has links.
    """
    from skysift.operators.spatial import overlapping_pairs
    from skysift.plans.tables import written

    ranked = edge_penalty(df, out="__score") if penalise else df.withColumn("__score", F.col("confidence"))
    ranked = written(ranked.filter(F.col("__score") >= least), "nms-ranked")
    side = ranked.select(*keys, F.col(id_col).alias("id"), F.col("__score").alias("s"), *_BOX)
    pairs = overlapping_pairs(side, side, keys).filter(iou(box("l_"), box("r_")) > threshold)
    better = (F.col("l_s") > F.col("r_s")) | ((F.col("l_s") == F.col("r_s")) & (F.col("l_id") < F.col("r_id")))
    edges = written(pairs.filter(better).select(F.col("l_id").alias("up"), F.col("r_id").alias("down")), "nms-edges")
    state = ranked.select(F.col(id_col).alias("id"), F.lit(None).cast("boolean").alias("kept"))
    left, k = -1, 0
    while True:
        above = edges.join(state.withColumnRenamed("id", "up"), "up").groupBy(F.col("down").alias("id")).agg(F.max(F.coalesce("kept", F.lit(False))).alias("beaten"), F.max(F.col("kept").isNull()).alias("open"))
        new = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("beaten"), F.lit(False)).when(F.coalesce("open", F.lit(False)), F.lit(None)).otherwise(F.lit(True))
        state = written(state.join(above, "id", "left").select("id", new.alias("kept")), f"nms-state-{k}")
        before, left, k = left, state.filter("kept is null").count(), k + 1
        if not left:
            break
        if left == before:  # only where an id stands for several overlapping boxes
            raise ValueError(f"{left} boxes cannot be decided: {id_col} is not unique")
    return ranked.join(state.filter("kept").select(F.col("id").alias(id_col)), id_col, "left_semi").drop("__score").select(*df.columns)


def soft_scores(boxes: np.ndarray, scores: np.ndarray, ids: np.ndarray, least: float, decay: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The decayed scores: the best open box leaves and the open boxes over it decay, until no open box reaches `least`.

    Scores only fall, so a box below `least` can't come before one that
    reaches it, and is closed at once. The best stands at the top of a heap; a
    box whose score has fallen since it was put there is put back.
    """
    scores, order = scores.copy(), np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    heap = list(zip((-scores).tolist(), rank.tolist(), strict=True))
    heapq.heapify(heap)
    grid = Neighbours(boxes)
    cells = {c: np.array(rows) for c, rows in grid.by_cell.items()}
    places = {c: boxes[rows] for c, rows in cells.items()}
    open_ = scores >= least
    while heap and -heap[0][0] >= least:
        s, k = heap[0]
        i = order[k]
        if not open_[i] or -scores[i] > s:
            if open_[i]:
                heapq.heapreplace(heap, (-float(scores[i]), k))
            else:
                heapq.heappop(heap)
            continue
        heapq.heappop(heap)
        open_[i] = False
        x, y = grid.cell[i].tolist()
        b = boxes[i]
        for c in [(x + dx, y + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]:
            near = cells.get(c)
            if near is None:
                continue
            at = places[c]
            hit = np.nonzero((at[:, 0] < b[2]) & (at[:, 2] > b[0]) & (at[:, 1] < b[3]) & (at[:, 3] > b[1]))[0]
            rows = near[hit]
            live = open_[rows]
            if not live.all():
                # Closed boxes leave their cell when they are many.
                if 4 * (len(rows) - live.sum()) > len(rows):
                    keep = open_[near]
                    cells[c], places[c] = near[keep], at[keep]
                rows, hit = rows[live], hit[live]
            if len(rows):
                scores[rows] *= decay(pair_iou(b, boxes[rows]))
                open_[rows[scores[rows] < least]] = False
    return scores


def soft_suppress(df: DataFrame, keys: Sequence[str] = ("raster_id",), *, method: str = "gaussian", sigma: float = 0.5, threshold: float = 0.45, least: float = 0.25, id_col: str = "det_id") -> DataFrame:
    """Soft suppression over all labels of a raster: the decayed score must reach `least`; scores are returned undecayed, with the decayed one beside."""
    ranked = edge_penalty(df, out="decayed").filter(F.col("decayed") >= least)

    def kernel(rows: pd.DataFrame) -> pd.DataFrame:
        scores = soft_scores(rows[_BOX].to_numpy(float), rows["decayed"].to_numpy(float), rows[id_col].to_numpy(), least, decay)
        rows["decayed"] = scores
        return rows[scores >= least]

    def decay(overlap: np.ndarray) -> np.ndarray:
        return np.exp(-(overlap**2) / sigma) if method == "gaussian" else np.where(overlap > threshold, 1 - overlap, 1.0)

    return ranked.groupBy(*keys).applyInPandas(kernel, ranked.schema)


def fuse_boxes(df: DataFrame, weights: dict[str, float] | None = None, keys: Sequence[str] = ("label",), *, threshold: float = 0.50, boost: float = 0.15, id_col: str = "det_id") -> DataFrame:
    """Weighted box fusion across models: clusters by a grouped map, the fused rows by an aggregate."""
    weights = {"florence2": 1.0, "grounding_dino": 1.2} if weights is None else weights
    rows = df.filter(F.col(keys[-1]).isNotNull()).withColumn("anchor", F.lit(0).cast("long"))

    def kernel(group: pd.DataFrame) -> pd.DataFrame:
        owner = greedy_owner(group[_BOX].to_numpy(float), group["confidence"].to_numpy(float), group[id_col].to_numpy(), threshold, closed=True)
        group["anchor"] = group[id_col].to_numpy()[owner]
        return group

    clustered = rows.groupBy(*keys).applyInPandas(kernel, rows.schema)
    weight = F.lit(1.0)
    for model, w in weights.items():
        weight = F.when(F.col("model_source") == model, F.lit(float(w))).otherwise(weight)
    w = F.col("confidence") * weight
    models = F.count_distinct("model_source")
    fused = [(F.sum(F.col(c) * w) / F.greatest(F.sum(w), F.lit(1e-6))).alias(c) for c in _BOX]
    score = F.when(models > 1, F.least(F.max("confidence") * (1 + boost * (models - 1)), F.lit(1.0))).otherwise(F.max("confidence"))
    return clustered.groupBy(*keys, "anchor").agg(*fused, score.alias("confidence"), models.alias("consensus_models")).withColumn("ensemble_method", F.lit("wbf"))
