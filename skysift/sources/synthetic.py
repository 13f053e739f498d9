"""A synthetic scene with known objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The objects of the scene, as id, label and pixel box ymin, xmin, ymax, xmax.
OBJECTS = [
    ("tent_0", "tent", 800, 800, 810, 810),
    ("tent_1", "tent", 800, 825, 810, 835),
    ("tent_2", "tent", 825, 800, 835, 810),
    ("trench_0", "trench", 1500, 1200, 1600, 1450),
    ("compound_0", "compound", 2500, 2500, 2600, 2600),
    ("vehicle_0", "vehicle", 2620, 2510, 2626, 2522),
    ("vehicle_1", "vehicle", 2620, 2530, 2626, 2542),
]
#: Rows and columns, corner, pixel size and zone of the scene.
SIZE, ORIGIN, PIXEL, EPSG = 4000, (500000.0, 5300000.0), 0.5, 32636


def ground_truth(spark: SparkSession) -> DataFrame:
    """The objects with their pixel box and their map box (xmin, ymin, xmax, ymax)."""
    rows = [(i, name, float(x0), float(y0), float(x1), float(y1)) for i, name, y0, x0, y1, x1 in OBJECTS]
    df = spark.createDataFrame(rows, "id string, label string, px0 double, py0 double, px1 double, py1 double")
    x = lambda c: ORIGIN[0] + F.col(c) * PIXEL
    y = lambda c: ORIGIN[1] - F.col(c) * PIXEL
    return df.withColumns({"xmin": x("px0"), "ymin": y("py1"), "xmax": x("px1"), "ymax": y("py0")})


def scene(spark: SparkSession, *, size: int = SIZE, bands: int = 3) -> DataFrame:
    """Long pixels: noise of 60 to 139 by hash, and the objects at 200 plus the band."""
    rows = spark.range(size).withColumnRenamed("id", "row")
    grid = rows.withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")))).withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
    noise = 60 + F.pmod(F.xxhash64("row", "col", "band"), F.lit(80)).cast("int")
    inside = F.lit(False)
    for _, _, y0, x0, y1, x1 in OBJECTS:
        inside = inside | (F.col("row").between(y0, y1 - 1) & F.col("col").between(x0, x1 - 1))
    return grid.select(F.lit(0).cast("long").alias("raster_id"), "row", "col", "band", F.when(inside, 200 + F.col("band")).otherwise(noise).alias("value"))
