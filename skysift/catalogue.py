"""All registered queries of the library and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skysift.plans import detection_queries, polygon_queries, scene_queries, tiling_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**detection_queries.QUERIES, **scene_queries.QUERIES, **tiling_queries.QUERIES, **polygon_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**detection_queries.SQL, **scene_queries.SQL, **tiling_queries.SQL, **polygon_queries.SQL}
