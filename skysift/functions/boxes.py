"""Column functions on axis-aligned boxes, corners and affine transforms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", names: tuple[str, str, str, str] = ("xmin", "ymin", "xmax", "ymax")) -> Box:
    return tuple(F.col(f"{prefix}{n}") for n in names)  # type: ignore[return-value]


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union has no area."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def touches(a: Box, b: Box) -> Column:
    """Whether two closed boxes share a point."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def gap(a: Box, b: Box) -> Column:
    """Euclidean distance between two boxes; 0 where they touch."""
    dx = F.greatest(a[0] - b[2], b[0] - a[2], F.lit(0))
    dy = F.greatest(a[1] - b[3], b[1] - a[3], F.lit(0))
    return F.sqrt((dx * dx + dy * dy).cast("double"))


def centre(b: Box) -> tuple[Column, Column]:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def on_seam(b: Box, tile: int = 512, margin: int = 8) -> Column:
    """Whether a box touches the margin of a tile, by its coordinates modulo the tile size."""
    r = [F.pmod(c, F.lit(tile)) for c in b]
    return (r[0] <= margin) | (r[1] <= margin) | (r[2] >= tile - margin) | (r[3] >= tile - margin)


def to_map(t: list[Column], col: Column, row: Column) -> tuple[Column, Column]:
    """Map coordinates of a pixel corner by the affine (a, b, c, d, e, f)."""
    return t[0] * col + t[1] * row + t[2], t[3] * col + t[4] * row + t[5]


def corners(t: list[Column], b: Box) -> Column:
    """The four map corners of a pixel box, upper left first, clockwise in pixels."""
    pairs = [(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])]
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in (to_map(t, *p) for p in pairs)])


def map_box_outer(t: list[Column], b: Box) -> Box:
    """The map box of a pixel box, its lower right corner taken at the far edge of the last pixel."""
    return _ordered(to_map(t, b[0], b[1]), to_map(t, b[2] + 1, b[3] + 1))


def map_box_corners(t: list[Column], b: Box) -> Box:
    """The map box of a pixel box from two opposite corners."""
    return _ordered(to_map(t, b[0], b[1]), to_map(t, b[2], b[3]))


def _ordered(p: tuple[Column, Column], q: tuple[Column, Column]) -> Box:
    return F.least(p[0], q[0]), F.least(p[1], q[1]), F.greatest(p[0], q[0]), F.greatest(p[1], q[1])


def ring_box(ring: Column) -> Box:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring given without its closing point, relative to its first point."""
    n, o = F.size(ring), F.get(ring, F.lit(0))
    x = lambda i: F.get(ring, i % n)["x"] - o["x"]
    y = lambda i: F.get(ring, i % n)["y"] - o["y"]
    terms = F.transform(F.sequence(F.lit(0), n - 1), lambda i: x(i) * y(i + 1) - x(i + 1) * y(i))
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)) / 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that stands in the expression once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
