"""From scenes to tiles: bands, radiometry, tile records, the filtered manifest, and what is exported of them.

Rasters are long (raster_id, row, col, band, value); tile tables have a row a
tile. Files are written by the sources, so a tile is pixels plus a record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skysift.functions.scores import decibel
from skysift.operators.raster import gaussian_filter, lee_filter, median_filter, padded, polarisation_ratio, stretch, windows


def chosen_bands(pixels: DataFrame, bands: Sequence[int] = (0, 1, 2), key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """The wanted bands (from 0) as bands 0, 1, 2; a number beyond the last band means the last, so one band is given three times."""
    k = list(key)
    n = pixels.groupBy(*k).agg((F.max("band") + 1).alias("__n"))
    asked = F.array(*[F.struct(F.lit(i).alias("out"), F.lit(b).alias("source")) for i, b in enumerate(bands)])
    mine = F.filter(asked, lambda x: F.greatest(F.least(x["source"], F.col("__n") - 1), F.lit(0)) == F.col("band"))
    # An outer join, in which the planner can't take the pixels for the smaller side and broadcast them.
    held = pixels.dropna(subset=k).join(n, k, "left")
    return held.withColumn("__band", F.explode(mine)).withColumn("band", F.col("__band.out")).drop("__n", "__band")


def normalised(pixels: DataFrame, bands: Sequence[int] = (0, 1, 2), key: Sequence[str] = ("raster_id",), *, nodata: float | None = None) -> DataFrame:
    """The chosen bands, each between its percentiles as 0 to 255."""
    return stretch(chosen_bands(pixels, bands, key), [*key, "band"], nodata=nodata)


def radar_to_byte(pixels: DataFrame, key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """One radar band (value): decibels, speckle filter, percentiles as 0 to 255."""
    logged = pixels.withColumn("value", 10 * F.log10(F.greatest(F.col("value").cast("double"), F.lit(1e-6))))
    return stretch(lee_filter(logged, key).withColumnRenamed("filtered", "value"), list(key))


def selected(pixels: DataFrame, bands: Sequence[int] = (1, 2, 3), key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Three bands (counted from 1) for a viewer: radar where a raster has one band, else each between its percentiles."""
    k = list(key)
    single = pixels.groupBy(*k).agg(F.max("band").alias("m")).filter("m = 0").select(*k)
    radar = radar_to_byte(pixels.join(single, k, "left_semi"), key).select(*k, "row", "col", F.explode(F.array(*map(F.lit, range(3)))).alias("band"), "stretched")
    optical = normalised(pixels.join(single, k, "left_anti"), [b - 1 for b in bands], key).select(*k, "row", "col", "band", "stretched")
    return optical.unionByName(radar)


def reference_band(pixels: DataFrame, key: Sequence[str] = ("raster_id",)) -> DataFrame:
    """The band that alignment works on: the mean of the first three, or the first where there are fewer."""
    three = F.count_if(F.col("band") < 3) == 3
    value = F.when(three, F.avg(F.when(F.col("band") < 3, F.col("value")))).otherwise(F.max(F.when(F.col("band") == 0, F.col("value"))).cast("double"))
    return pixels.groupBy(*key, "row", "col").agg(value.alias("value"))


def window_transform(transform: Column, row_off: Column, col_off: Column) -> Column:
    """The six affine numbers (a … f) of a window of a raster."""
    a, b, c, d, e, f = (transform[i] for i in range(6))
    return F.array(a, b, c + a * col_off + b * row_off, d, e, f + d * col_off + e * row_off)


def _bounds(transform: Column, width: Column, height: Column) -> Column:
    """[least x, least y, largest x, largest y] of a window of that size."""
    at = lambda i, x, y: transform[i] * x + transform[i + 1] * y + transform[i + 2]
    corners = [(F.lit(0), F.lit(0)), (width, F.lit(0)), (F.lit(0), height), (width, height)]
    x, y = ([at(i, *c) for c in corners] for i in (0, 3))
    return F.array(F.least(*x), F.least(*y), F.greatest(*x), F.greatest(*y))


def tile_records(scenes: DataFrame, size: int = 512, stride: int = 384) -> DataFrame:
    """The manifest: a row a tile of each scene (raster_id, source_raster, height, width, transform, crs).

    `world_bounds` is of the window itself, `padded_bounds` of the tile with its
    padding at the bottom and right.
    """
    w = windows(scenes, size, stride).withColumns({"row_idx": F.col("row_idx").cast("int"), "col_idx": F.col("col_idx").cast("int")})
    stem = F.regexp_replace(F.element_at(F.split("source_raster", "/"), -1), r"\.[^.]*$", "")
    w = w.withColumns({"filename": F.concat(stem, F.lit("_r"), F.col("row_idx"), F.lit("_c"), F.col("col_idx"), F.lit(".tif")), "transform": window_transform(F.col("transform"), F.col("row_off"), F.col("col_off"))})
    t = F.col("transform")
    return w.select("raster_id", "source_raster", "crs", "filename", "row_idx", "col_idx", "row_off", "col_off", "win_h", "win_w", (size - F.col("win_h")).alias("pad_bottom"), (size - F.col("win_w")).alias("pad_right"), "transform", _bounds(t, F.col("win_w"), F.col("win_h")).alias("world_bounds"), _bounds(t, F.lit(size), F.lit(size)).alias("padded_bounds"))


def finished_tiles(tiles: DataFrame, size: int, *, bands: Sequence[int] = (0, 1, 2), nodata: float | None = None, mode: str = "constant") -> DataFrame:
    """Tile pixels (raster_id, row_idx, col_idx, row, col, band, value) with chosen bands, stretched and padded to `size`."""
    key = ["raster_id", "row_idx", "col_idx"]
    done = normalised(tiles, bands, key, nodata=nodata).select(*key, "band", "row", "col", F.col("stretched").alias("value"))
    return padded(done, size, [*key, "band"], mode=mode)


def kept_tiles(tiles: DataFrame, verdicts: DataFrame, key: Sequence[str] = ("filename",), *, most: int | None = None) -> DataFrame:
    """The valid tiles in the order of their place, the first `most` of them where that is asked for."""
    kept = tiles.join(verdicts.filter("is_valid").select(*key), list(key), "left_semi").orderBy("row_idx", "col_idx", *key)
    return kept if most is None else kept.limit(most)


def rejected_tiles(tiles: DataFrame, verdicts: DataFrame, key: Sequence[str] = ("filename",)) -> DataFrame:
    """(key, reason) of the tiles that are not valid."""
    return tiles.select(*key).join(verdicts.filter("not is_valid").select(*key, "reason"), list(key))


def without_stale(results: DataFrame, again: DataFrame, key: str = "source_raster") -> DataFrame:
    """The results of rasters that are not tiled again."""
    return results.join(again.select(key).distinct(), key, "left_anti")


def grid_export(tiles: DataFrame) -> DataFrame:
    """Tiles with their corners and area in the square unit of their reference system."""
    b = F.col("world_bounds")
    return tiles.select("filename", "crs", *[b[i].alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))], ((b[2] - b[0]) * (b[3] - b[1])).alias("area_crs2"))


def needs_resampling(gsd: Column, target: float = 0.5, tolerance: float = 0.05) -> Column:
    """Whether a mean ground sampling distance is far enough from the target."""
    return F.abs(gsd - target) > tolerance


def tile_overview(tiles: DataFrame, most: int = 10) -> DataFrame:
    """Size, reference system and bounds of the first tiles, for a look."""
    return tiles.orderBy("filename").select("filename", "win_w", "win_h", "crs", "world_bounds").limit(most)


def comparable_pairs(patches: DataFrame) -> DataFrame:
    """(pair_id, height, width) of the pairs of which both times (t 0 and 1) exist with the same size."""
    size = patches.groupBy("pair_id", "t").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    both = size.groupBy("pair_id", "height", "width").agg(F.count_distinct("t").alias("n"))
    return both.filter("n = 2").select("pair_id", "height", "width")


def change_summary(polygons: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: pairs processed, polygons found, and as JSON the polygons of each label, by label."""
    labels = polygons.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("label", "n")))
    text = F.concat(F.lit("{"), F.array_join(F.transform(listed, lambda x: F.concat(F.lit('"'), x["label"], F.lit('":'), x["n"])), ","), F.lit("}"))
    found = labels.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_polygons"), text.alias("by_label"))
    return found.withColumn("n_pairs", pairs.select(F.count_distinct("pair_id")).scalar()).select("n_pairs", "n_polygons", "by_label")




def radar_scene(pixels: DataFrame, key: Sequence[str] = ("raster_id",), *, gain: float = 1e-4, dual: bool = False, speckle: str | None = None) -> DataFrame:
    """A radar scene in decibels: band 0, and where `dual` is asked for and there are two bands band 1 and the ratio of both as band 2.

    `speckle` is 'median', 'gaussian', or anything else for none.
    """
    k = list(key)
    bands = pixels.filter(F.col("band") < (2 if dual else 1)).select(*k, "band", "row", "col", decibel(F.col("value").cast("double"), gain).alias("value"))
    smooth = {"median": median_filter, "gaussian": gaussian_filter}.get(speckle or "")
    if smooth is not None:
        bands = smooth(bands, [*k, "band"]).select(*k, "band", "row", "col", F.col("filtered").alias("value"))
    if not dual:
        return bands
    both = [F.max(F.when(F.col("band") == i, F.col("value"))).alias(f"b{i}") for i in (0, 1)]
    ratio = bands.groupBy(*k, "row", "col").agg(*both).filter("b1 is not null").select(*k, F.lit(2).alias("band"), "row", "col", polarisation_ratio(F.col("b0"), F.col("b1")).alias("value"))
    return bands.unionByName(ratio)
