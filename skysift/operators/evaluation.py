"""Detections against ground truth: optimal assignment and class reports."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.functions.boxes import area, box
from skysift.operators.suppression import pair_iou

_BOX = ["xmin", "ymin", "xmax", "ymax"]


def assignment(cost: np.ndarray) -> np.ndarray:
    """Column of each row in an assignment of least cost (rows <= columns), by shortest augmenting paths."""
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            row = cost[owner[j0] - 1] - u[owner[j0]] - v[1:]
            free = ~used[1:]
            better = free & (row < least[1:])
            least[1:][better], way[1:][better] = row[better], j0
            j1 = int(np.where(free, least[1:], np.inf).argmin()) + 1
            delta = least[j1]
            u[owner[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if owner[j0] == 0:
                break
        while j0:
            owner[j0], j0 = owner[way[j0]], way[j0]
    out = np.full(n, -1)
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


class Overlaps:
    """Finds the preds that overlap each gt, by a grid of a quarter of the largest box side."""

    def __init__(self, gt: np.ndarray, pred: np.ndarray):
        self.gt, self.pred = gt, pred
        sized = lambda b: np.nonzero(np.isfinite(b).all(1) & (b[:, 2] > b[:, 0]) & (b[:, 3] > b[:, 1]))[0]
        #: The gts that can overlap, and the candidates of each.
        self.rows, p = sized(gt), sized(pred)
        self.size = np.zeros(len(self.rows), np.int64)
        if not len(self.rows) or not len(p):
            self.rows, self.size = self.rows[:0], self.size[:0]
            return
        g = gt[self.rows]
        both = np.vstack([g, pred[p]])
        mid = lambda b: (b[:, :2] + b[:, 2:]) / 2
        low, high = mid(both).min(0), mid(both).max(0)
        side = float((both[:, 2:] - both[:, :2]).max())
        # At most 2^20 cells a side. A gt reaches a little over what the largest pred needs, so that rounding loses no overlap.
        cell = max(side / 4, float((high - low).max()) / 2**20)
        reach = (g[:, 2:] - g[:, :2] + side) / 2 * (1 + 1e-9) + 4 * np.spacing(np.abs(both).max())
        at = lambda m: np.floor((m - low) / cell).astype(np.int64)
        a, z, of = at(mid(g) - reach), at(mid(g) + reach), at(mid(pred[p]))
        key = of[:, 0] * 2**22 + of[:, 1]
        order = np.argsort(key, kind="stable")
        self.by_cell, key = p[order], key[order]
        # The cells of a column stand together.
        column = a[:, :1] + np.arange((z - a)[:, 0].max() + 1)
        self.starts = np.searchsorted(key, column * 2**22 + a[:, 1:])
        ends = np.searchsorted(key, column * 2**22 + z[:, 1:], "right")
        self.counts = np.where(column <= z[:, :1], ends - self.starts, 0)
        self.size = self.counts.sum(1)

    def of(self, a: int, z: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gt, pred, iou) of rows[a:z], by gt and then pred."""
        s, k = self.starts[a:z].ravel(), self.counts[a:z].ravel()
        i = np.repeat(self.rows[a:z], self.size[a:z])
        j = self.by_cell[np.repeat(s - np.cumsum(k) + k, k) + np.arange(k.sum())]
        x = pair_iou(self.gt[i], self.pred[j])
        i, j, x = i[x > 0], j[x > 0], x[x > 0]
        by = np.argsort(i * len(self.pred) + j)
        return i[by], j[by], x[by]

    def of_row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(preds, ious) of one gt."""
        a = int(np.searchsorted(self.rows, i))
        return self.of(a, a + 1)[1:]

    def blocks(self, block: int):
        """The pairs of all rows, about `block` candidates at a time."""
        cut = np.unique([0, *np.searchsorted(np.cumsum(self.size), np.arange(block, self.size.sum(), block)), len(self.rows)])
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            yield self.of(a, z)


def overlaps(gt: np.ndarray, pred: np.ndarray, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, columns, ious): the preds that overlap each gt, those of gt i from first[i] to first[i + 1].

    Made a block of candidates at a time, so memory grows with the overlaps and
    not with gt x pred: 12 bytes for each, twice that while they are put together.
    """
    return heaviest(Overlaps(gt, pred), len(pred) or 1, block)[:3]


def heaviest(found: Overlaps, most: int, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As `overlaps`, of the `most` largest overlaps of each gt only; and the largest that each leaves out (0 for none)."""
    n, rest = np.zeros(len(found.gt), np.int64), np.zeros(len(found.gt))
    cols, ious = [np.empty(0, np.int32)], [np.empty(0)]
    for i, j, x in found.blocks(block):
        if not len(i):
            continue
        starts = np.nonzero(np.diff(i, prepend=-1))[0]
        size = np.diff(starts, append=len(i))
        if size.max() > most:
            keep = np.zeros(len(i), bool)
            # By gt, then down by overlap; of overlaps within 1e-9 of each other any may stay.
            keep[np.argsort(2.0 * (i - i[0]) - x)[np.arange(len(i)) - np.repeat(starts, size) < most]] = True
            rest[i[starts]] = np.maximum.reduceat(np.where(keep, 0, x), starts)
            i, j, x = i[keep], j[keep], x[keep]
        cols.append(j.astype(np.int32)), ious.append(x)
        # The rows of a block stand together, so its counts have their own stretch.
        n[i[0] : i[-1] + 1] += np.bincount(i - i[0])
    columns = np.concatenate(cols)
    cols.clear()
    return np.concatenate([[0], np.cumsum(n)]), columns, np.concatenate(ious), rest


def best_pairs(first: np.ndarray, columns: np.ndarray, weights: np.ndarray, m: int, rest: np.ndarray | None = None, of_row=None) -> np.ndarray:
    """Column of each row (-1 for none) in the matching of largest total weight, the weights given as in `overlaps`.

    Rows enter one by one, by the shortest path to a free column or to a row
    that had better go without one. Prices u and v stay at or above every weight
    (u[i] + v[j] >= w), so a path visits only the rows that compete.

    With `rest` the weights are those of `heaviest`, and `of_row` gives a whole
    row. It is asked wherever a weight left out, at most rest[i], could matter:
    prices are not negative, so the rest is no nearer than at price 0. The pairs
    are those that all weights give.
    """
    n = len(first) - 1
    rest = [0.0] * n if rest is None else rest.tolist()
    u, v = [0.0] * n, [0.0] * m
    mate, owner = [-1] * n, [-1] * m
    listed = lambda j, w: list(zip(j.tolist(), w.tolist(), strict=True))
    kept = lambda i: listed(columns[first[i] : first[i + 1]], weights[first[i] : first[i + 1]])
    for s in range(n):
        if first[s] == first[s + 1]:
            continue
        u[s] = max(0.0, max(w - v[j] for j, w in kept(s)))
        if rest[s] > u[s]:
            u[s] = max(0.0, max(w - v[j] for j, w in listed(*of_row(s))))
        least, end, dropped = u[s], -1, s  # to leave s itself out
        seen, dist, way, heap, done, i, d = {s: 0.0}, {}, {}, [], {}, s, 0.0
        while True:
            edges = kept(i)
            if rest[i] and d + u[i] - rest[i] <= min([least, *(max(d + u[i] + v[j] - w, d) for j, w in edges if owner[j] < 0)]):
                edges = listed(*of_row(i))
            for j, w in edges:
                to = max(d + u[i] + v[j] - w, d)
                if j not in done and to < dist.get(j, np.inf) and (to < least or (to == least and dropped >= 0 and owner[j] < 0)):
                    dist[j], way[j] = to, i
                    if owner[j] < 0:
                        least, end, dropped = to, j, -1
                    else:
                        heapq.heappush(heap, (to, j))
            while heap and heap[0][1] in done:
                heapq.heappop(heap)
            if not heap or heap[0][0] >= least:
                break
            d, j = heapq.heappop(heap)
            i = owner[j]
            done[j] = seen[i] = d
            if d + u[i] < least:
                least, end, dropped = d + u[i], -1, i
        for i, d in seen.items():
            u[i] = max(u[i] - (least - d), 0.0)
        for j, d in done.items():
            v[j] += least - d
        if dropped >= 0:
            if dropped == s:
                continue
            end, mate[dropped] = mate[dropped], -1
        while True:
            i = way[end]
            owner[end], mate[i], end = i, end, mate[i]
            if i == s:
                break
    return np.array(mate, np.int64)


def matched(gt: np.ndarray, pred: np.ndarray, most: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gt, pred, iou) as arrays, of the assignment with the largest total IoU, pairs without overlap left out.

    The `most` largest overlaps of each gt are kept; the others are found again where they matter.
    """
    near = Overlaps(gt, pred)
    first, columns, ious, rest = heaviest(near, most)
    found = best_pairs(first, columns, ious, len(pred), rest, near.of_row)
    rows = np.nonzero(found >= 0)[0]
    return rows, found[rows], pair_iou(gt[rows], pred[found[rows]])


def match(gt: np.ndarray, pred: np.ndarray) -> list[tuple[int, int, float]]:
    """The same pairs as a list."""
    return list(zip(*(a.tolist() for a in matched(gt, pred)), strict=True))


def matches(gt: DataFrame, pred: DataFrame, keys: tuple[str, ...] = ("raster_id", "label")) -> DataFrame:
    """(keys, gt_id, pred_id, iou): the optimal pairs within each group."""
    k = list(keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in gt.select(*k).schema) + ", gt_id long, pred_id long, iou double"

    def run(key: tuple, g: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if g.empty or p.empty:
            return pd.DataFrame(columns=[*k, "gt_id", "pred_id", "iou"])
        g, p = g.sort_values("det_id"), p.sort_values("p_det_id")
        i, j, x = matched(g[_BOX].to_numpy(float), p[[f"p_{c}" for c in _BOX]].to_numpy(float))
        return pd.DataFrame({**dict(zip(k, key, strict=True)), "gt_id": g.det_id.to_numpy()[i], "pred_id": p.p_det_id.to_numpy()[j], "iou": x})

    cols = [*k, "det_id", *_BOX]
    # New names, since both sides may come from one table.
    other = pred.select(*[F.col(c).alias(f"p_{c}") for c in cols]).groupBy(*[f"p_{c}" for c in k])
    return gt.select(*cols).groupBy(*k).cogroup(other).applyInPandas(run, schema)


def report(gt: DataFrame, pred: DataFrame, pairs: DataFrame, *, threshold: float = 0.50, key: str = "label") -> DataFrame:
    """One row a class: counts, precision, recall, F1, the two mean precisions and the areas."""
    n = lambda d, name: d.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.sum(area(box())).alias(f"area_{name}"))
    steps = [0.50 + 0.05 * i for i in range(10)]
    hits = pairs.groupBy(key).agg(F.count_if(F.col("iou") >= threshold).alias("tp"), *[F.count_if(F.col("iou") >= F.lit(t)).alias(f"tp{i}") for i, t in enumerate(steps)])
    r = n(gt, "gt").join(n(pred, "pred"), key, "full").join(hits, key, "left").na.fill(0)
    ratio = lambda a, b: F.when(b > 0, F.bround(a / b, 4)).otherwise(0.0)
    p, c = ratio(F.col("tp"), F.col("n_pred")), ratio(F.col("tp"), F.col("n_gt"))
    ap = [ratio(F.col(f"tp{i}"), F.col("n_pred")) * ratio(F.col(f"tp{i}"), F.col("n_gt")) for i in range(10)]
    f1 = F.when(F.col("precision") + F.col("recall") > 0, F.bround(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")), 4)).otherwise(0.0)
    out = r.select("*", p.alias("precision"), c.alias("recall")).withColumn("f1_score", f1)
    return out.select(
        F.col(key).alias("class"), "precision", "recall", "f1_score", F.col("tp").cast("long").alias("tp"),
        (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"),
        F.bround(ap[0], 4).alias("map_50"), F.bround(sum(ap[1:], ap[0]) / 10, 4).alias("map_50_95"),
        F.bround("area_gt", 2).alias("gt_total_area"), F.bround("area_pred", 2).alias("pred_total_area"),
        F.bround(F.col("area_pred") - F.col("area_gt"), 2).alias("area_difference"),
        F.when(F.col("area_gt") > 0, F.bround(F.col("area_pred") / F.col("area_gt"), 4)).otherwise(0.0).alias("area_ratio"),
    )


def location_only(df: DataFrame) -> DataFrame:
    """All labels as one, to score places alone."""
    return df.withColumn("label", F.lit("object"))
