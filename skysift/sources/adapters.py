"""Detectors as plug-ins: one tile in, any number of detections out; and resumable runs.

A model is a class with `predict(tile, targets) -> list of (bbox, label,
confidence)`. It is built once in each worker, on first use. No model is part
of the library; `Stub` makes detections from a hash, for tests.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.catalog import pending

_factories: dict[str, Callable[[], object]] = {}
_built: dict[str, object] = {}


def register(name: str, factory: Callable[[], object]) -> None:
    _factories[name] = factory


def _model(name: str, factory: Callable[[], object]):
    """The model of this worker, built on first use and kept for its next tasks."""
    if name not in _built:
        _built[name] = factory()
    return _built[name]


class Stub:
    """Deterministic boxes from the tile's name; not a model."""

    def predict(self, tile: str, targets: list[str]) -> list[tuple[list[float], str, float]]:
        out = []
        for k, target in enumerate(targets):
            h = zlib.crc32(f"{tile}/{target}".encode())
            if h % 3 == 0:
                x, y = float(h % 400), float(h // 400 % 400)
                out.append(([x, y, x + 20 + h % 60, y + 20 + h // 7 % 60], target, 0.25 + (h % 75) / 100))
        return out


register("stub", Stub)

OUT = "filename string, xmin double, ymin double, xmax double, ymax double, label string, confidence double"


def detect(tiles: DataFrame, name: str, targets: list[str], *, key: str = "filename") -> DataFrame:
    """Detections of all tiles; a tile on which the model fails gives none."""
    factory = _factories[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(name, factory)
        for batch in batches:
            rows = []
            for tile in batch[key]:
                try:
                    found = model.predict(tile, targets)
                except Exception:  # a bad tile must not end the run
                    continue
                rows += [[tile, *bbox, label, float(score)] for bbox, label, score in found]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])

    return tiles.select(key).mapInPandas(run, OUT)


def detect_each(tiles: DataFrame, name: str, targets: list[str], *, key: str = "filename") -> DataFrame:
    """Detections by one call for each tile and target, labelled with the target, for models that take one prompt."""
    factory = _factories[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(name, factory)
        for batch in batches:
            rows = []
            for tile, target in zip(batch[key], batch["target"], strict=True):
                try:
                    found = model.predict(tile, [target])
                except Exception:  # a bad tile must not end the run
                    continue
                rows += [[tile, *bbox, target, float(score)] for bbox, _, score in found]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])

    asked = tiles.select(key, F.explode(F.array(*map(F.lit, targets))).alias("target"))
    return asked.mapInPandas(run, OUT)


def nested_output(raw: DataFrame, *, confidence: float = 1.0) -> DataFrame:
    """Raw output (filename, bboxes, labels) as an array of (bbox, label, confidence) a tile; labels are trimmed."""
    rows = F.transform(F.arrays_zip("bboxes", "labels"), lambda x: F.struct(x["bboxes"].alias("bbox"), F.trim(x["labels"]).alias("label"), F.lit(confidence).alias("confidence")))
    return raw.select("filename", rows.alias("detections"))


def write_profile(spark, path: str, a: float, b: float, temperature: float = 1.0) -> None:
    """A calibration profile as JSON."""
    spark.createDataFrame([(a, b, temperature)], "platt_a double, platt_b double, temperature double").coalesce(1).write.mode("overwrite").json(path)


def read_profile(spark, path: str) -> DataFrame:
    """One row: platt_a, platt_b, temperature; 1, 0 and 1 where the file lacks them."""
    rows = spark.read.schema("platt_a double, platt_b double, temperature double").json(path, multiLine=False)
    return rows.select(*[F.coalesce(c, F.lit(v)).alias(c) for c, v in (("platt_a", 1.0), ("platt_b", 0.0), ("temperature", 1.0))]).limit(1)


def resolved_input(spark, name: str, raw_dir: str = "data/raw") -> str:
    """The path as given, or in the folder of raw scenes; an error where neither exists. Any file system that Spark reads."""
    for path in (name, f"{raw_dir.rstrip('/')}/{name}"):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return path
    raise FileNotFoundError(f"neither {name} nor {raw_dir}/{name}")


def run_pending(tiles: DataFrame, results_path: str, name: str, targets: list[str], *, overwrite: bool = False) -> int:
    """Runs the tiles that have no result yet and appends; the number of tiles run. `done` rows mark tiles without detections."""
    spark = tiles.sparkSession
    try:
        done = spark.read.parquet(f"{results_path}/done")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = tiles.select("filename").limit(0)
    todo = pending(tiles, done, "filename", overwrite=overwrite).select("filename").cache()
    n = todo.count()
    if n:
        mode = "overwrite" if overwrite else "append"
        detect(todo, name, targets).write.mode(mode).parquet(f"{results_path}/detections")
        todo.write.mode(mode).parquet(f"{results_path}/done")
    todo.unpersist()
    return n


def collected(tiles: DataFrame, detections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(detections with their tile's columns, tiles without any result)."""
    return detections.join(tiles, "filename"), tiles.join(detections.select("filename"), "filename", "left_anti")


def unknown_tiles(detections: DataFrame, tiles: DataFrame) -> DataFrame:
    """Detections with an error for each whose tile is not in the manifest."""
    joined = detections.join(tiles.select("filename", F.lit(True).alias("__known")), "filename", "left")
    ok = F.when(F.col("__known"), F.col("filename")).otherwise(F.raise_error(F.concat(F.lit("unknown tile "), F.col("filename"))))
    return joined.withColumn("filename", ok).drop("__known")
