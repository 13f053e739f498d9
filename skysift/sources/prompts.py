"""The target catalogue, prompt profiles and prompt texts of open-vocabulary detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Key, primary prompt, synonyms, box threshold, text threshold.
TARGETS = [
    ("tents", "refugee tent, humanitarian tent, military encampment tent", ["canvas shelter", "temporary housing tent", "encampment structure", "displaced person shelter"], 0.25, 0.25),
    ("trenchlines", "military trench line, defensive earthworks, zigzag trench, field fortification", ["earthen trench", "defensive ditch", "fortified trench", "excavated trench"], 0.20, 0.20),
    ("damaged_buildings", "damaged building, destroyed structure, collapsed roof, rubble, debris", ["bomb damaged structure", "earthquake damaged building", "partially collapsed building", "ruined building"], 0.30, 0.25),
    ("aircraft", "airplane, fighter jet, cargo aircraft, helicopter, military plane", ["fixed wing aircraft", "rotary wing aircraft", "tarmac airplane", "runway plane"], 0.35, 0.30),
    ("military_compounds", "military base compound, perimeter wall, guard tower, fortified outpost", ["secure compound", "military facility", "walled compound", "command post"], 0.25, 0.25),
    ("guard_towers", "guard tower, observation tower, watchtower, security tower", ["elevated watchtower", "perimeter tower", "surveillance tower"], 0.30, 0.25),
    ("military_vehicles", "armored vehicle, military truck, tank, missile launcher, convoy vehicle", ["armored personnel carrier", "tracked vehicle", "camouflage vehicle"], 0.30, 0.25),
    ("emergency_assets", "emergency response vehicle, ambulance, fire truck, aid supply stack", ["humanitarian aid crate", "disaster response vehicle", "emergency generator"], 0.30, 0.25),
]
#: The prompts of each profile.
PROFILES = {
    "disaster_response": ["damaged building", "destroyed roof", "rubble pile", "emergency tent", "makeshift shelter", "flooded road"],
    "military_infrastructure": ["military vehicle", "guard tower", "trenchline", "bunker", "helipad", "fortified position", "military tent"],
    "aviation_assets": ["helicopter", "cargo plane", "fighter jet", "aircraft hangar"],
}
SCHEMA = "target string, primary_prompt string, synonyms array<string>, box_threshold double, text_threshold double"


def targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TARGETS, SCHEMA)


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, i, q) for p, qs in PROFILES.items() for i, q in enumerate(qs)], "profile string, position int, query string")


def looked_up(queries: DataFrame, catalogue: DataFrame, query: str = "query") -> DataFrame:
    """Each query's target by its key, trimmed and in lower case; else the query itself as a prompt with thresholds 0.25."""
    found = queries.join(F.broadcast(catalogue), F.lower(F.trim(F.col(query))) == F.col("target"), "left")
    return found.select(*queries.columns, F.coalesce("primary_prompt", query).alias("primary_prompt"), F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"), F.coalesce("box_threshold", F.lit(0.25)).alias("box_threshold"), F.coalesce("text_threshold", F.lit(0.25)).alias("text_threshold"))


def with_thresholds(found: DataFrame, box: Column | None = None, text: Column | None = None) -> DataFrame:
    """Thresholds with overrides where they are not null."""
    for name, value in (("box_threshold", box), ("text_threshold", text)):
        if value is not None:
            found = found.withColumn(name, F.coalesce(value, F.col(name)))
    return found


def caption_prompt(token: str = "<CAPTION_TO_PHRASE>", synonyms: bool = False) -> Column:
    """'token primary[, synonyms]' for a phrase-grounding model."""
    words = F.concat(F.array("primary_prompt"), F.col("synonyms")) if synonyms else F.array("primary_prompt")
    return F.trim(F.concat(F.lit(token + " "), F.array_join(words, ", ")))


def dotted_prompt(phrases: Column) -> Column:
    """Phrases joined by ' . ' with a full stop at the end."""
    text = F.array_join(phrases, " . ")
    return F.when(text.endswith("."), text).otherwise(F.concat(text, F.lit(" .")))


def plain_prompt(prefix: Column, query: Column) -> Column:
    return F.when(query == "", prefix).otherwise(F.concat_ws(" ", prefix, query))


def upsert_target(catalogue: DataFrame, new: DataFrame) -> DataFrame:
    new = new.withColumn("target", F.lower(F.trim("target")))
    return catalogue.join(new.select("target"), "target", "left_anti").unionByName(new)


def save(catalogue: DataFrame, path: str) -> None:
    catalogue.write.mode("overwrite").json(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)
