"""Coordinates: distinct places, what a cache lacks, resolving it, joining it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.text import after_last, strip
from vitrine.operators.joins import lookup_join
from vitrine.schemas import GEO_CACHE

CACHE_MAP = "map<string,struct<lat:double,lon:double,normalized:string>>"


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cache kept as Parquet, as lines of JSON (`.jsonl`, read by many tasks) or as one JSON object
    keyed by place (`.json`, one task: for small caches made elsewhere); empty if absent or broken."""
    empty = spark.createDataFrame([], GEO_CACHE)
    try:
        if path.endswith(".jsonl"):
            return spark.read.schema(GEO_CACHE).json(path).where(F.col("location").isNotNull())
        if path.endswith(".json"):
            text = spark.read.text(path, wholetext=True)
            entries = text.select(F.explode(F.from_json("value", CACHE_MAP)).alias("location", "e"))
            return entries.select("location", "e.lat", "e.lon", "e.normalized")
        return spark.read.schema(GEO_CACHE).parquet(path)
    except Exception as error:  # an absent path is reported while the scan is planned
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise


def write_cache(cache: DataFrame, path: str) -> None:
    """Write a new version of the cache, as lines of JSON if `path` ends so; `path` must not be the
    version it was read from."""
    rows = cache.select(*GEO_CACHE.fieldNames()).write.mode("overwrite")
    rows.json(path) if path.endswith(".jsonl") else rows.parquet(path)


def distinct_keys(df: DataFrame, column: str = "localizacao") -> DataFrame:
    return df.where(strip(F.col(column)) != "").select(F.col(column).alias("location")).distinct()


def pending(df: DataFrame, cache: DataFrame, column: str = "localizacao") -> DataFrame:
    """Places the cache does not hold. Distinct first, so the join sees places, not rows."""
    return distinct_keys(df, column).join(cache.select("location"), "location", "left_anti")


def resolve(keys: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Cache entries for places, looked up by full name and then by the city before the comma.

    `gazetteer` is keyed by `name` (`schemas.GAZETTEER`). Places it lacks are left out.
    """
    city = strip(F.substring_index("location", ",", 1))
    parts = ["city", "town", "village", "suburb", "municipality"]
    gazetteer = one_per_place(gazetteer, "name")
    facts = F.struct(*[c for c in gazetteer.columns if c != "name"])
    full = gazetteer.select(F.col("name").alias("location"), facts.alias("_full"))
    by_city = gazetteer.select(F.col("name").alias("_city"), facts.alias("_by_city"))
    found = (
        keys.withColumn("_city", city)
        .join(full, "location", "left")
        .join(by_city, "_city", "left")
        .withColumn("_at", F.coalesce("_full", "_by_city"))
        .where(F.col("_at").isNotNull())
    )
    known = [F.nullif(F.col(f"_at.{p}"), F.lit("")) for p in parts]
    state = F.when(
        F.contains("location", F.lit(",")), strip(after_last(F.col("location"), ","))
    ).otherwise(
        F.coalesce(
            F.nullif(F.col("_at.state_district"), F.lit("")),
            F.nullif(F.col("_at.state"), F.lit("")),
            F.lit("BR"),
        )
    )
    return found.select(
        "location",
        F.col("_at.lat").alias("lat"),
        F.col("_at.lon").alias("lon"),
        F.concat(F.coalesce(*known, F.col("_city")), F.lit(", "), state).alias("normalized"),
    )


def upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """Cache with new entries added; a new entry replaces the old one of its place."""
    columns = GEO_CACHE.fieldNames()
    kept = cache.select(*columns).join(new.select("location"), "location", "left_anti")
    return kept.select(*columns).unionByName(new.select(*columns))


def one_per_place(entries: DataFrame, key: str = "location") -> DataFrame:
    """One entry of each place: the smallest, where a table holds a place twice."""
    rest = F.struct(*[c for c in entries.columns if c != key])
    return entries.groupBy(key).agg(F.min(rest).alias("_e")).select(key, "_e.*")


def enrich(df: DataFrame, cache: DataFrame, column: str = "localizacao") -> DataFrame:
    """Latitude and longitude from the cache; the place becomes its normalized name. No row is
    multiplied by a place that the cache holds twice."""
    order = [c for c in df.columns if c not in ("latitude", "longitude")]
    entries = one_per_place(cache).select(
        F.col("location").alias(column), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"), F.col("normalized").alias("_normalized"),
    )
    joined = lookup_join(
        df.drop("latitude", "longitude"), entries, [column]
    ).withColumn(column, F.coalesce("_normalized", column))
    columns = df.columns if "latitude" in df.columns else [*order, "latitude", "longitude"]
    return joined.select(*columns)
