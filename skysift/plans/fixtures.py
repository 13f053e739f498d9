"""Analytic inputs derived from the driver's tables, in Spark and as SQL.

`det` detections, `pixels` rasters in long form, `emb_series` and `patches`
embeddings, `incidents`, `scenes` and `ctx_boxes`. Integer arithmetic only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = ["tent", "trench line", "military compound", "vehicle", "aircraft"]

SQL = {
    "det": """SELECT event_id AS det_id, (event_id // 3) % 8 AS raster_id, event_id % 3 AS j,
        list_extract(['tent', 'trench line', 'military compound', 'vehicle', 'aircraft'], CAST((event_id // 3) % 5 AS INT) + 1) AS label,
        CASE WHEN event_id % 2 = 0 THEN 'florence2' ELSE 'grounding_dino' END AS model_source,
        CAST(((event_id // 3) * 7919) % 3907 + 2 * (event_id % 3) AS DOUBLE) AS xmin,
        CAST(((event_id // 3) * 6421) % 3911 + 2 * (event_id % 3) AS DOUBLE) AS ymin,
        CAST(((event_id // 3) * 7919) % 3907 + 2 * (event_id % 3) + 8 + ((event_id // 3) * 31) % 92 AS DOUBLE) AS xmax,
        CAST(((event_id // 3) * 6421) % 3911 + 2 * (event_id % 3) + 8 + ((event_id // 3) * 17) % 92 AS DOUBLE) AS ymax,
        CAST((event_id * 37) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence FROM events""",
    "pixels": """SELECT o_orderkey // 4096 AS raster_id, (o_orderkey % 4096) // 64 AS row, o_orderkey % 64 AS col,
        CAST(floor(o_totalprice) AS BIGINT) % 256 AS value FROM orders""",
    "pixels3": """SELECT raster_id, row, col, band, (value + 29 * band + row) % 256 AS value FROM pixels, (VALUES (0), (1), (2)) b(band)""",
    "emb_series": "SELECT vec_id % 10 AS site_id, vec_id // 10 AS seq, embedding FROM embeddings",
    "patches": "SELECT vec_id // 100 AS pair_id, (vec_id // 50) % 2 AS t, (vec_id % 50) // 10 AS row, vec_id % 10 AS col, embedding FROM embeddings",
    "incidents": """SELECT c_custkey AS incident_id, CAST(-180 AS DOUBLE) + CAST((c_custkey * 7919) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) AS lon,
        CAST(-80 AS DOUBLE) + CAST((c_custkey * 6421) % 16000 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat FROM customer""",
    "scenes": """SELECT s_suppkey AS scene_id, CAST((s_suppkey * 977) % 355 - 180 AS DOUBLE) AS x0, CAST((s_suppkey * 613) % 150 - 75 AS DOUBLE) AS y0,
        CAST((s_suppkey * 977) % 355 - 175 AS DOUBLE) AS x1, CAST((s_suppkey * 613) % 150 - 71 AS DOUBLE) AS y1,
        list_extract(['capella_sm_', 'PHR1A_', 'WV03_', 's1_hh_', 'spot7_', 'tile_'], CAST(s_suppkey % 6 AS INT) + 1) || CAST(s_suppkey AS VARCHAR) || '_202401' || lpad(CAST(1 + s_suppkey % 28 AS VARCHAR), 2, '0') || '.tif' AS filename,
        CASE WHEN s_suppkey % 7 = 0 THEN 'Area' ELSE '2024-01-' || lpad(CAST(1 + s_suppkey % 28 AS VARCHAR), 2, '0') END AS ts, 1 + s_suppkey % 4 AS bands FROM supplier""",
    "ctx_boxes": """SELECT p_partkey AS ctx_id, p_partkey % 2 AS kind, CAST((p_partkey * 7919) % 3800 AS DOUBLE) AS x0, CAST((p_partkey * 6421) % 3800 AS DOUBLE) AS y0,
        CAST((p_partkey * 7919) % 3800 + 2 * p_size AS DOUBLE) AS x1, CAST((p_partkey * 6421) % 3800 + 2 * p_size AS DOUBLE) AS y1 FROM part""",
}
_NEEDS = {"pixels3": ["pixels"]}


def with_views(sql: str, *names: str) -> str:
    """`sql` (a SELECT, or further CTEs beginning with a comma) after the named views."""
    order = []
    for n in names:
        order += [x for x in [*_NEEDS.get(n, []), n] if x not in order]
    head = "WITH RECURSIVE " + ", ".join(f"{n} AS ({SQL[n]})" for n in order)
    return head + (sql if sql.lstrip().startswith(",") else " " + sql)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], at) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), at.cast("int") + 1)


def det(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id")
    b, j = F.floor(F.col("event_id") / 3), F.col("event_id") % 3
    x, y = (b * 7919) % 3907 + 2 * j, (b * 6421) % 3911 + 2 * j
    return e.select(
        F.col("event_id").alias("det_id"), (b % 8).alias("raster_id"), j.alias("j"), _pick(LABELS, b % 5).alias("label"),
        F.when(F.col("event_id") % 2 == 0, "florence2").otherwise("grounding_dino").alias("model_source"),
        x.cast("double").alias("xmin"), y.cast("double").alias("ymin"), (x + 8 + (b * 31) % 92).cast("double").alias("xmax"), (y + 8 + (b * 17) % 92).cast("double").alias("ymax"),
        (((F.col("event_id") * 37) % 101).cast("double") / 100).alias("confidence"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").select(F.floor(k / 4096).alias("raster_id"), F.floor((k % 4096) / 64).alias("row"), (k % 64).alias("col"), (F.floor("o_totalprice") % 256).alias("value"))


def pixels3(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = pixels(spark, sf_dir).withColumn("band", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return bands.select("raster_id", "row", "col", "band", ((F.col("value") + 29 * F.col("band") + F.col("row")) % 256).alias("value"))


def emb_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return _table(spark, sf_dir, "embeddings").select((v % 10).alias("site_id"), F.floor(v / 10).alias("seq"), "embedding")


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return _table(spark, sf_dir, "embeddings").select(F.floor(v / 100).alias("pair_id"), (F.floor(v / 50) % 2).alias("t"), F.floor((v % 50) / 10).alias("row"), (v % 10).alias("col"), "embedding")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(k.alias("incident_id"), (-180 + ((k * 7919) % 36000).cast("double") / 100).alias("lon"), (-80 + ((k * 6421) % 16000).cast("double") / 100).alias("lat"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = (k * 977) % 355 - 180, (k * 613) % 150 - 75
    day = F.lpad((1 + k % 28).cast("string"), 2, "0")
    name = F.concat(_pick(["capella_sm_", "PHR1A_", "WV03_", "s1_hh_", "spot7_", "tile_"], k % 6), k.cast("string"), F.lit("_202401"), day, F.lit(".tif"))
    return _table(spark, sf_dir, "supplier").select(
        k.alias("scene_id"), x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + 5).cast("double").alias("x1"), (y + 4).cast("double").alias("y1"),
        name.alias("filename"), F.when(k % 7 == 0, "Area").otherwise(F.concat(F.lit("2024-01-"), day)).alias("ts"), (1 + k % 4).alias("bands"),
    )


def ctx_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    x, y, s = (k * 7919) % 3800, (k * 6421) % 3800, 2 * F.col("p_size")
    return _table(spark, sf_dir, "part").select(k.alias("ctx_id"), (k % 2).alias("kind"), x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + s).cast("double").alias("x1"), (y + s).cast("double").alias("y1"))
