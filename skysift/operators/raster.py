"""Pixel operators on long rasters (raster_id, row, col, value[, band])."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skysift.functions.scores import entropy_bin, stretched


def tile_quality(pixels: DataFrame, key: Sequence[str] = ("raster_id",), *, nodata: float = 0, cloud: float = 220, least_valid: float = 0.50, most_cloud: float = 0.60, least_entropy: float = 3.5) -> DataFrame:
    """For each tile valid_ratio, cloud_ratio, entropy and the verdict: the first test that fails.

    `pixels` has one row a pixel and band; band 0 decides validity, the mean of
    the first three bands, where there are three, decides cloud.
    """
    k = list(key)
    at = [*k, "row", "col"]
    one = pixels.groupBy(*at).agg(F.max(F.when(F.col("band") == 0, F.col("value"))).alias("first"), F.avg(F.when(F.col("band") < 3, F.col("value"))).alias("mean"), F.count_if(F.col("band") < 3).alias("bands"))
    ratios = one.groupBy(*k).agg(F.avg((F.col("first") != nodata).cast("double")).alias("valid_ratio"), F.avg(((F.col("mean") > cloud) & (F.col("bands") == 3)).cast("double")).alias("cloud_ratio"))
    # The entropy is needed only where the cheaper tests pass.
    passed = ratios.filter((F.col("valid_ratio") >= least_valid) & (F.col("cloud_ratio") <= most_cloud)).select(*k)
    out = ratios.join(entropy(pixels.join(passed, k, "left_semi"), k), k, "left")
    reason = F.when(F.col("valid_ratio") < least_valid, "nodata").when(F.col("cloud_ratio") > most_cloud, "cloud").when(F.coalesce("entropy", F.lit(0.0)) < least_entropy, "low_entropy").otherwise("valid")
    return out.withColumn("reason", reason).withColumn("is_valid", F.col("reason") == "valid")


def entropy(pixels: DataFrame, key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Shannon entropy, in bits, of the 256-bin histogram of all bands."""
    k = list(key)
    bins = pixels.withColumn("bin", entropy_bin(F.col("value"))).filter("bin is not null").groupBy(*k, "bin").agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy(*k)
    p = F.col("n") / F.sum("n").over(total)
    return bins.select(*k, (-p * F.log2(p)).alias("t")).groupBy(*k).agg(F.sum("t").alias("entropy"))


def stretch(pixels: DataFrame, key: Sequence[str] = ("raster_id", "band"), *, low: float = 0.02, high: float = 0.98, nodata: float | None = None) -> DataFrame:
    """`stretched`: each band between its percentiles as 0 to 255; nodata and non-finite pixels are left out and become 0."""
    v = F.col("value").cast("double")
    good = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    if nodata is not None:
        good = good & (v != nodata)
    limits = pixels.filter(good).groupBy(*key).agg(F.percentile("value", F.array(F.lit(low), F.lit(high))).alias("q"))
    out = pixels.join(limits, list(key), "left")
    return out.withColumn("stretched", F.when(good, stretched(v, F.get("q", F.lit(0)), F.get("q", F.lit(1)))).otherwise(0)).drop("q")


def pan_sharpen(bands: DataFrame, pan: DataFrame) -> DataFrame:
    """Brovey: each of three bands over their mean, times the panchromatic pixel; 0 to 255, truncated."""
    at = ["raster_id", "row", "col"]
    wide = bands.groupBy(*at).agg(*[F.max(F.when(F.col("band") == i, F.col("value"))).alias(f"b{i}") for i in range(3)])
    mean = (F.col("b0") + F.col("b1") + F.col("b2")) / 3
    sharp = [F.least(F.greatest(F.col(f"b{i}") / (mean + 1e-6) * F.col("pan"), F.lit(0.0)), F.lit(255.0)).cast("int").alias(f"s{i}") for i in range(3)]
    return wide.join(pan.select(*at, F.col("value").alias("pan")), at).select(*at, *sharp)


def neighbours(pixels: DataFrame, key: Sequence[str] = ("raster_id",), *, radius: int = 1, border: str = "reflect") -> DataFrame:
    """All (pixel, neighbour) pairs in a square: key, row, col, value, dr, dc, near.

    'reflect' mirrors at the border with the edge pixel repeated, and expects
    full rectangles from (0, 0); 'none' has no neighbours beyond it. Each
    pixel is sent to the pixels that it is a neighbour of, so the join that
    mirrors is an equi-join on position.
    """
    k = list(key)
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    around = pixels.select(*k, "row", "col", "value").withColumn("dr", F.explode(steps)).withColumn("dc", F.explode(steps))
    r, c = F.col("row") + F.col("dr"), F.col("col") + F.col("dc")
    if border == "reflect":
        size = pixels.groupBy(*k).agg((F.max("row") + 1).alias("__h"), (F.max("col") + 1).alias("__w"))
        around = around.join(size, k)
        mirror = lambda x, n: F.when(x < 0, -x - 1).when(x >= n, 2 * n - 1 - x).otherwise(x)
        r, c = mirror(r, F.col("__h")), mirror(c, F.col("__w"))
    around = around.withColumn("__r", r).withColumn("__c", c)
    other = pixels.select(*k, F.col("row").alias("__r"), F.col("col").alias("__c"), F.col("value").alias("near"))
    return around.join(other, [*k, "__r", "__c"], "left").drop("__r", "__c", "__h", "__w")


def moving(pixels: DataFrame, what: Column, name: str, key: Sequence[str] = ("raster_id",), *, border: str = "reflect") -> DataFrame:
    """An aggregate of `near` over the 3 x 3 square of each pixel."""
    return neighbours(pixels, key, border=border).groupBy(*key, "row", "col").agg(F.first("value").alias("value"), what.alias(name))


def lee_filter(pixels: DataFrame, key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Speckle filter: mean + w (x - mean) with w = var / (var + var of the raster + 1e-6)."""
    local = neighbours(pixels, key).groupBy(*key, "row", "col").agg(F.first("value").alias("value"), F.avg("near").alias("m"), F.avg(F.col("near") * F.col("near")).alias("m2"))
    overall = pixels.groupBy(*key).agg(F.var_pop("value").alias("g"))
    var = F.greatest(F.col("m2") - F.col("m") * F.col("m"), F.lit(0.0))
    w = var / (var + F.col("g") + 1e-6)
    return local.join(overall, list(key)).select(*key, "row", "col", (F.col("m") + w * (F.col("value") - F.col("m"))).alias("filtered"))


def median_filter(pixels: DataFrame, key: Sequence[str] = ("raster_id",)) -> DataFrame:
    return moving(pixels, F.percentile("near", F.lit(0.5)), "filtered", key)


def gaussian_filter(pixels: DataFrame, key: Sequence[str] = ("raster_id",), *, size: int = 3, block: int = 256) -> DataFrame:
    """Gaussian with sigma = size / 2 to four sigma, mirrored at the border; missing and null neighbours count nothing.

    Rasters are cut in blocks, and a pixel is sent to the blocks within its
    reach only: some 1.1 rows a pixel move, not one for each of its neighbours.
    A block is filtered along its columns, then along its rows.
    """
    k, sigma = list(key), size / 2
    radius = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights /= weights.sum()
    shape = pixels.groupBy(*k).agg((F.max("row") + 1).alias("__h"), (F.max("col") + 1).alias("__w"))
    near = lambda at, n: F.sequence(F.floor(F.greatest(at - radius, F.lit(0)) / block), F.floor(F.least(at + radius, n - 1) / block))
    held = pixels.dropna(subset=[*k, "row", "col"]).select(*k, "row", "col", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"), F.col("value").isNotNull().alias("__has")).join(shape, k, "left")
    sent = held.withColumn("__r", F.explode(near(F.col("row"), F.col("__h")))).withColumn("__c", F.explode(near(F.col("col"), F.col("__w"))))

    def spread(x: np.ndarray) -> np.ndarray:
        x = sum(w * x[d : d + len(x) - 2 * radius] for d, w in enumerate(weights))
        return sum(w * x[:, d : d + x.shape[1] - 2 * radius] for d, w in enumerate(weights))

    def run(at: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        place, lows = [], []
        for b, n in zip(at[-2:], rows[["__h", "__w"]].iloc[0], strict=True):
            x = np.arange(b * block - radius, min((b + 1) * block, n) + radius)
            x = np.where(x < 0, -x - 1, np.where(x >= n, 2 * n - 1 - x, x))
            low = max(b * block - radius, 0)
            # One place beyond the block's pixels stands for positions without any.
            place.append(np.where((x >= 0) & (x < n), x - low, block + 2 * radius)), lows.append(low)
        r, c = rows["row"].to_numpy(), rows["col"].to_numpy()
        grid, has = np.zeros((block + 2 * radius + 1,) * 2), np.zeros((block + 2 * radius + 1,) * 2)
        grid[r - lows[0], c - lows[1]], has[r - lows[0], c - lows[1]] = rows["value"], rows["__has"]
        around = np.ix_(*place)
        own = (r // block == at[-2]) & (c // block == at[-1])
        spot = r[own] - at[-2] * block, c[own] - at[-1] * block
        out = rows.loc[own, [*k, "row", "col"]]
        out["filtered"], known = spread(grid[around])[spot], spread(has[around])[spot] > 0
        out["__known"] = known
        return out

    types = {f.name: f.dataType.simpleString() for f in pixels.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*k, "row", "col"]) + ", filtered double, __known boolean"
    done = sent.groupBy(*k, "__r", "__c").applyInPandas(run, schema)
    return done.select(*k, "row", "col", F.when(F.col("__known"), F.col("filtered")).alias("filtered"))


def polarisation_ratio(first: Column, second: Column) -> Column:
    return first / (second + 1e-10)


def padded(pixels: DataFrame, size: int, key: Sequence[str] = ("raster_id",), *, mode: str = "constant", fill: float = 0) -> DataFrame:
    """Tiles grown to size x size at the bottom and right, with `is_valid` for the pixels they had.

    'constant' fills, 'edge' repeats the last row and column, 'reflect' mirrors
    without repeating them (a triangular wave of the position).
    """
    k = list(key)
    shape = pixels.groupBy(*k).agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w"))
    span = F.sequence(F.lit(0), F.lit(size - 1))
    full = shape.withColumn("row", F.explode(span)).withColumn("col", F.explode(span)).withColumns({"row": F.col("row").cast("long"), "col": F.col("col").cast("long")})

    def source(x: Column, n: Column) -> Column:
        if mode == "edge":
            return F.least(x, n - 1)
        if mode == "reflect":
            period = F.greatest(2 * (n - 1), F.lit(1))
            return F.when(n == 1, F.lit(0).cast("long")).otherwise((n - 1) - F.abs(x % period - (n - 1)))
        return x

    full = full.withColumn("__r", source(F.col("row"), F.col("h"))).withColumn("__c", source(F.col("col"), F.col("w")))
    # Both sides are exploded, which the planner's sizes do not show: neither may be broadcast.
    have = pixels.select(*k, F.col("row").alias("__r"), F.col("col").alias("__c"), "value").hint("merge")
    valid = (F.col("row") < F.col("h")) & (F.col("col") < F.col("w"))
    return full.join(have, [*k, "__r", "__c"], "left").select(*k, "row", "col", F.coalesce("value", F.lit(fill)).alias("value"), valid.alias("is_valid"))


def cropped(padded_pixels: DataFrame) -> DataFrame:
    return padded_pixels.filter("is_valid").drop("is_valid")


def windows(shape: DataFrame, size: int, stride: int) -> DataFrame:
    """Windows over rasters (key, height, width): regular offsets and a last one flush with the edge."""
    def offsets(n: Column) -> Column:
        last = F.greatest(n - size, F.lit(0))
        return F.array_distinct(F.concat(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(stride).cast("long")), F.array(last.cast("long"))))

    rows = shape.select("*", F.posexplode(offsets(F.col("height"))).alias("row_idx", "row_off"))
    both = rows.select("*", F.posexplode(offsets(F.col("width"))).alias("col_idx", "col_off"))
    return both.withColumns({"win_h": F.least(F.lit(size), F.col("height") - F.col("row_off")), "win_w": F.least(F.lit(size), F.col("width") - F.col("col_off"))})


def _windows_at(at: Column, n: Column, size: int, stride: int) -> Column:
    """The windows (idx, off) along one axis that hold position `at`, from its number alone."""
    last = F.greatest(n - size, F.lit(0)).cast("long")
    low = F.greatest(F.ceil((at - size + 1) / stride), F.lit(0)).cast("long")
    high = F.least(F.floor(at / stride), F.floor(last / stride)).cast("long")
    none = F.array().cast("array<struct<idx:bigint,off:bigint>>")
    regular = F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda i: F.struct(i.alias("idx"), (i * stride).alias("off")))).otherwise(none)
    flush = F.when((last % stride != 0) & (at >= last), F.array(F.struct((F.floor(last / stride) + 1).cast("long").alias("idx"), last.alias("off")))).otherwise(none)
    return F.concat(regular, flush)


def tile_pixels(pixels: DataFrame, size: int, stride: int) -> DataFrame:
    """Each pixel once for each window that has it: raster_id, row_idx, col_idx, offsets, row, col (within the window) and the other columns.

    A pixel's windows follow from its row and column, so no window meets a
    pixel that it does not hold.
    """
    shape = pixels.groupBy("raster_id").agg((F.max("row") + 1).alias("__h"), (F.max("col") + 1).alias("__w"))
    own = [c for c in pixels.columns if c not in ("raster_id", "row", "col")]
    cut = pixels.join(shape, "raster_id").withColumn("__r", F.explode(_windows_at(F.col("row"), F.col("__h"), size, stride)))
    cut = cut.withColumn("__c", F.explode(_windows_at(F.col("col"), F.col("__w"), size, stride)))
    return cut.select("raster_id", F.col("__r.idx").alias("row_idx"), F.col("__c.idx").alias("col_idx"), F.col("__r.off").alias("row_off"), F.col("__c.off").alias("col_off"), (F.col("row") - F.col("__r.off")).alias("row"), (F.col("col") - F.col("__c.off")).alias("col"), *own)


def chips(pixels: DataFrame, size: int, stride: int, *, nodata: float = 0) -> DataFrame:
    """Windows with a pixel that is not nodata: key, row_idx, col_idx, offsets, number of such pixels."""
    held = tile_pixels(pixels, size, stride).groupBy("raster_id", "row_idx", "col_idx", "row_off", "col_off")
    return held.agg(F.count_if(F.col("value") != nodata).alias("n_valid")).filter("n_valid > 0")


def mosaic(tiles: DataFrame) -> DataFrame:
    """Tiles back in one raster; where they overlap the highest (row_idx, col_idx) wins."""
    at = ["raster_id", (F.col("row") + F.col("row_off")).alias("row"), (F.col("col") + F.col("col_off")).alias("col")]
    return tiles.groupBy(*at).agg(F.max_by("value", F.struct("row_idx", "col_idx")).alias("value"))


def overview(pixels: DataFrame, factor: int) -> DataFrame:
    """Every factor-th pixel of every factor-th row."""
    kept = pixels.filter((F.col("row") % factor == 0) & (F.col("col") % factor == 0))
    return kept.withColumns({"row": F.floor(F.col("row") / factor), "col": F.floor(F.col("col") / factor)})


def _targets(at: Column, n: Column, m: Column) -> Column:
    """Along one axis of n positions resampled to m: struct(t, w) of each target that reads position `at`, and its share of it."""
    spot = lambda t: F.least(F.greatest((t + 0.5) * n / m - 0.5, F.lit(0.0)), n - 1.0)
    # The targets about the position, one more on either side against rounding, then those that read it.
    low = F.when(at <= 0, 0).otherwise(F.greatest(F.floor((at - 0.5) * m / n - 0.5) - 1, F.lit(0)))
    high = F.when(at >= n - 1, m - 1).otherwise(F.least(F.ceil((at + 1.5) * m / n - 0.5) + 1, m - 1))
    near = F.transform(F.sequence(low.cast("long"), F.greatest(low, high).cast("long")), lambda t: F.struct(t.alias("t"), spot(t).alias("y")))
    share = lambda s: F.when(F.floor(s["y"]) == at, 1 - (s["y"] - F.floor(s["y"]))).otherwise(0.0) + F.when(F.least(F.floor(s["y"]) + 1, n - 1) == at, s["y"] - F.floor(s["y"])).otherwise(0.0)
    reads = F.filter(near, lambda s: (F.floor(s["y"]) == at) | (F.least(F.floor(s["y"]) + 1, n - 1) == at))
    return F.transform(reads, lambda s: F.struct(s["t"].alias("t"), share(s).alias("w")))


def resampled(pixels: DataFrame, scale: float, key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Bilinear resampling to round(n * scale) rows and columns, by pixel centres.

    Each pixel is sent to the targets that read it, so no grid of targets
    stands by itself and is joined.
    """
    k = list(key)
    shape = pixels.groupBy(*k).agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w"))
    shape = shape.withColumns({"new_h": F.greatest(F.bround(F.col("h") * scale), F.lit(1)).cast("long"), "new_w": F.greatest(F.bround(F.col("w") * scale), F.lit(1)).cast("long")})
    # An outer join, in which the planner can't take the pixels for the smaller side and broadcast them.
    sent = pixels.dropna(subset=[*k, "row", "col"]).select(*k, "row", "col", "value").join(shape, k, "left")
    sent = sent.withColumn("__r", F.explode(_targets(F.col("row"), F.col("h"), F.col("new_h")))).withColumn("__c", F.explode(_targets(F.col("col"), F.col("w"), F.col("new_w"))))
    return sent.groupBy(*k, F.col("__r.t").alias("row"), F.col("__c.t").alias("col")).agg(F.sum(F.col("value") * F.col("__r.w") * F.col("__c.w")).alias("value"))


def otsu(cells: DataFrame, key: Sequence[str] = ("pair_id",), value: str = "change") -> DataFrame:
    """Otsu's threshold of values in [0, 1] over 256 bins: the centre of the first best bin."""
    k = list(key)
    bins = cells.filter(F.col(value).between(0, 1)).withColumn("bin", F.least(F.floor(F.col(value) * 256), F.lit(255)).cast("int")).groupBy(*k, "bin").agg(F.count(F.lit(1)).cast("double").alias("n"))
    every = bins.select(*k).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(255))))
    full = every.join(bins, [*k, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0.0))).withColumn("c", (F.col("bin") + 0.5) / 256)
    up = Window.partitionBy(*k).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beyond = Window.partitionBy(*k).orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    s = full.select(*k, "bin", "c", F.sum("n").over(up).alias("w1"), F.sum("n").over(beyond).alias("w2"), F.sum(F.col("n") * F.col("c")).over(up).alias("s1"), F.sum(F.col("n") * F.col("c")).over(beyond).alias("s2")).filter("bin < 255")
    m1, m2 = F.col("s1") / F.greatest("w1", F.lit(1e-12)), F.col("s2") / F.greatest("w2", F.lit(1e-12))
    between = F.round(F.col("w1") * F.col("w2") * (m1 - m2) * (m1 - m2), 6)
    return s.groupBy(*k).agg(F.max_by("c", F.struct(between, -F.col("bin"))).alias("threshold"))


def morphology(mask: DataFrame, key: Sequence[str] = ("pair_id",)) -> DataFrame:
    """Opening, then closing, with a 3 x 3 square; outside counts as not set. `mask` has value 0 or 1."""
    def step(df: DataFrame, erode: bool) -> DataFrame:
        near = F.coalesce("near", F.lit(0))
        return neighbours(df, key, border="none").groupBy(*key, "row", "col").agg((F.min(near) if erode else F.max(near)).alias("value"))

    return step(step(step(step(mask, True), False), False), True)
