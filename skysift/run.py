"""Detection on one raster from its file to a detection layer.

    spark-submit skysift/run.py --input scene.tif --results /shared/scene --model stub --profile aviation_assets

Tiles are cut and judged, the model runs on those without a result, and the
boxes become typed geometry in the raster's reference system. Without
`--skip-tiling` earlier results of the raster are cleared first; with it the
manifest in the results folder is used again and the run goes on where it ended.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.functions.boxes import ring_box
from skysift.operators import evaluation, polygons, raster, tiling
from skysift.plans.tables import written
from skysift.sources import adapters, geotiff, prompts, vectors

_KEY = ["raster_id", "row_idx", "col_idx"]


def tiled(spark: SparkSession, source: str, size: int = 512, stride: int = 384) -> tuple[DataFrame, DataFrame]:
    """(tile records, verdicts) of a raster file."""
    scenes = geotiff.scan(spark, source).select(F.lit(0).cast("long").alias("raster_id"), F.col("path").alias("source_raster"), "height", "width", "transform", F.concat(F.lit("EPSG:"), "epsg").alias("crs"))
    pixels = geotiff.long_pixels(geotiff.read_pixels(spark, source)).withColumn("raster_id", F.lit(0).cast("long"))
    return tiling.tile_records(scenes, size, stride), raster.tile_quality(raster.tile_pixels(pixels, size, stride), _KEY)


def _cleared(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def detections(tiles: DataFrame, found: DataFrame) -> DataFrame:
    """Raw results with an id, and the ring of each box by its tile's transform; written once, so that ids stay."""
    rows, _ = adapters.collected(tiles.select("filename", "source_raster", "transform", "crs"), found)
    ringed = polygons.placed(rows, [F.col("transform")[i] for i in range(6)]).withColumnRenamed("filename", "tile_filename")
    return written(ringed.withColumn("det_id", F.monotonically_increasing_id()), "detections")


def run(spark: SparkSession, source: str, results: str, *, model: str, targets: list[str], size: int = 512, stride: int = 384, most: int | None = None, skip_tiling: bool = False, acquired: str = "Unknown") -> DataFrame:
    """The detection layer of a raster. An error where no tile has a result or the manifest is of another raster."""
    manifest = f"{results}/manifest"
    if not skip_tiling:
        tiles, verdicts = tiled(spark, source, size, stride)
        _cleared(spark, results)
        verdicts = verdicts.select(*_KEY, "is_valid", "reason")
        tiles.join(verdicts, _KEY).write.parquet(manifest)
    tiles = spark.read.parquet(manifest)
    other = tiles.filter(~F.col("source_raster").endswith(source.rsplit("/", 1)[-1])).select("source_raster").first()
    if other is not None:
        raise ValueError(f"the manifest is of {other[0]}, not of {source}")
    usable = tiling.kept_tiles(tiles.drop("is_valid", "reason"), tiles, most=most)
    adapters.run_pending(usable, f"{results}/found", model, targets)
    done = spark.read.parquet(f"{results}/found/done")
    if usable.join(done, "filename", "left_semi").first() is None:
        raise ValueError("no tile has a result")
    found = detections(usable, spark.read.parquet(f"{results}/found/detections"))
    return polygons.detection_layer(found, prompt=", ".join(targets), acquired=acquired)


def location_report(truth: DataFrame, layer: DataFrame) -> DataFrame:
    """The evaluation of a layer by place alone; truth has xmin, ymin, xmax, ymax in map units."""
    box = dict(zip(("xmin", "ymin", "xmax", "ymax"), ring_box(F.col("ring")), strict=True))
    gt, pred = (evaluation.location_only(d).withColumn("det_id", F.monotonically_increasing_id()) for d in (truth, layer.withColumns(box)))
    return evaluation.report(gt, pred, evaluation.matches(gt, pred, ("label",)))


def main() -> None:
    ask = argparse.ArgumentParser(description="Detection on one raster, end to end.")
    ask.add_argument("--input", required=True, help="a GeoTIFF, or its name in --raw")
    ask.add_argument("--raw", default="data/raw")
    ask.add_argument("--results", required=True, help="a folder that driver and executors share")
    ask.add_argument("--model", required=True)
    ask.add_argument("--profile", choices=sorted(prompts.PROFILES), default="disaster_response")
    ask.add_argument("--acquisition-date", default="Unknown")
    ask.add_argument("--max-tiles", type=int, default=0)
    ask.add_argument("--skip-tiling", action="store_true")
    ask.add_argument("--export", help="a GeoPackage on the driver's disk; Parquet in the results folder otherwise")
    given = ask.parse_args()
    spark = SparkSession.builder.appName("skysift").getOrCreate()
    source = adapters.resolved_input(spark, given.input, given.raw)
    layer = run(spark, source, given.results, model=given.model, targets=prompts.PROFILES[given.profile], most=given.max_tiles or None, skip_tiling=given.skip_tiling, acquired=given.acquisition_date)
    if given.export:
        epsg = spark.read.parquet(f"{given.results}/manifest").select(F.substring_index("crs", ":", -1).cast("int")).first()[0]
        vectors.write_layer(layer, given.export, srs=epsg)
    else:
        layer.write.mode("overwrite").parquet(f"{given.results}/layer")


if __name__ == "__main__":
    main()
