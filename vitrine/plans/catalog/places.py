"""Coordinates: cache, pending places, resolution, enrichment, new places."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import geo, quality
from vitrine.plans.catalog.registry import (
    BASE_SQL, GOLD_SQL, KEYS, LISTINGS_SQL, base, gold_rows, listings, query, with_tables,
)
from vitrine.sources import tables
from vitrine.sources.tables import KEY


def nation_places(spark, folder):
    """Listings at the nation of their supplier: 'NATION_3, SP'."""
    return base(spark, folder).select(
        *KEY, F.when(F.col("cls") != 7, F.concat(F.col("n_name"), F.lit(", "), F.col("uf")))
        .otherwise(F.lit(" ")).alias("localizacao"),
    )


_PLACES = BASE_SQL + f""", places AS (
  SELECT {KEYS}, CASE WHEN cls <> 7 THEN n_name || ', ' || uf ELSE ' ' END AS localizacao FROM base)"""
_STATE = "['SP', 'MG', 'SP', 'SP', 'SP'][n_nationkey % 5 + 1]"


def cache(spark, folder):
    """Coordinates of the nations 0 to 14."""
    key = F.col("n_nationkey")
    states = F.array(*[F.lit(state) for _, state in tables.PLACES])
    name = F.concat(F.col("n_name"), F.lit(", "), F.get(states, key % 5))
    return tables.table(spark, folder, "nation").where(key < 15).select(
        name.alias("location"), key.cast("double").alias("lat"), (-key).cast("double").alias("lon"),
        F.initcap(F.replace(name, F.lit("_"), F.lit(" "))).alias("normalized"),
    )


_NORMAL = f"'Nation ' || n_nationkey || ', ' || upper(left({_STATE}, 1)) || lower(right({_STATE}, 1))"
_CACHE = f""", cache AS (
  SELECT n_name || ', ' || {_STATE} AS location, CAST(n_nationkey AS DOUBLE) AS lat,
         CAST(-n_nationkey AS DOUBLE) AS lon, {_NORMAL} AS normalized FROM nation WHERE n_nationkey < 15)"""


def gazetteer(spark, folder):
    """Nations with their region as district. Even ones are listed by full place name, odd ones
    by bare name; every fifth has no town."""
    nations, regions = (tables.table(spark, folder, t) for t in ("nation", "region"))
    key, none = F.col("n_nationkey"), F.lit(None).cast("string")
    states = F.array(*[F.lit(state) for _, state in tables.PLACES])
    full = F.concat(F.col("n_name"), F.lit(", "), F.get(states, key % 5))
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.when(key % 2 == 0, full).otherwise(F.col("n_name")).alias("name"),
        (key + 0.5).cast("double").alias("lat"), (key - 0.5).cast("double").alias("lon"),
        none.alias("city"),
        F.when(key % 5 != 0, F.concat(F.lit("Town "), key.cast("string"))).alias("town"),
        F.when(key % 5 == 1, F.lit("Village")).alias("village"),
        none.alias("suburb"), none.alias("municipality"),
        F.col("r_name").alias("state_district"), none.alias("state"),
    )


@query("q_distinct_locations", with_tables(_PLACES, """
SELECT DISTINCT localizacao AS location FROM places WHERE trim(localizacao) <> ''"""))
def q_distinct_locations(spark, folder):
    return geo.distinct_keys(nation_places(spark, folder))


@query("q_pending_locations", with_tables(_PLACES + _CACHE, """
SELECT DISTINCT localizacao AS location FROM places
WHERE trim(localizacao) <> '' AND localizacao NOT IN (SELECT location FROM cache)"""))
def q_pending_locations(spark, folder):
    return geo.pending(nation_places(spark, folder), cache(spark, folder))


@query("q_geo_enrich", with_tables(_PLACES + _CACHE, f"""
SELECT {KEYS}, coalesce(normalized, localizacao) AS localizacao, lat AS latitude, lon AS longitude
FROM places LEFT JOIN cache ON location = localizacao"""))
def q_geo_enrich(spark, folder):
    return geo.enrich(nation_places(spark, folder), cache(spark, folder))


_RESOLVED = f""", resolved AS (
  SELECT n_name || ', ' || {_STATE} AS location, n_nationkey + 0.5::DOUBLE AS lat,
         n_nationkey - 0.5::DOUBLE AS lon,
         CASE WHEN n_nationkey % 5 <> 0 THEN 'Town ' || n_nationkey ELSE n_name END || ', ' || {_STATE}
         AS normalized FROM nation)"""


@query("q_geo_resolve", with_tables(_PLACES + _CACHE + _RESOLVED, """
SELECT * FROM resolved WHERE location NOT IN (SELECT location FROM cache)
AND location IN (SELECT localizacao FROM places)"""))
def q_geo_resolve(spark, folder):
    missing = geo.pending(nation_places(spark, folder), cache(spark, folder))
    return geo.resolve(missing, gazetteer(spark, folder))


@query("q_geo_resolve_bare", with_tables(BASE_SQL, """
SELECT n_name AS location, n_nationkey + 0.5::DOUBLE AS lat, n_nationkey - 0.5::DOUBLE AS lon,
       CASE WHEN n_nationkey % 5 <> 0 THEN 'Town ' || n_nationkey ELSE n_name END || ', ' || r_name AS normalized
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey % 2 = 1 AND n_nationkey IN (SELECT n_nationkey FROM base)"""))
def q_geo_resolve_bare(spark, folder):
    """Places without a state take it from the gazetteer; full-name entries do not match."""
    bare = base(spark, folder).select(F.col("n_name").alias("localizacao"))
    return geo.resolve(geo.distinct_keys(bare), gazetteer(spark, folder))


@query("q_geo_upsert", with_tables("n AS (SELECT 1)" + _CACHE + _RESOLVED, """
SELECT location, lat, lon, normalized FROM resolved WHERE location NOT IN (SELECT location FROM cache)
UNION ALL SELECT location, lat, lon, normalized FROM cache"""))
def q_geo_upsert(spark, folder):
    """What the cache lacks is resolved and added."""
    known = cache(spark, folder)
    states = F.array(*[F.lit(state) for _, state in tables.PLACES])
    every = tables.table(spark, folder, "nation").select(
        F.concat(F.col("n_name"), F.lit(", "), F.get(states, F.col("n_nationkey") % 5)).alias("localizacao")
    )
    return geo.upsert(known, geo.resolve(geo.pending(every, known), gazetteer(spark, folder)))


@query("q_new_locations", with_tables(_PLACES, """
SELECT DISTINCT localizacao FROM places
WHERE localizacao NOT IN (SELECT n_name || ', SP' FROM nation WHERE n_nationkey < 12)"""))
def q_new_locations(spark, folder):
    earlier = tables.table(spark, folder, "nation").where(F.col("n_nationkey") < 12).select(
        F.concat(F.col("n_name"), F.lit(", SP")).alias("localizacao")
    )
    return quality.new_values(nation_places(spark, folder), earlier)


@query("q_coords_coverage", with_tables(LISTINGS_SQL, """
SELECT count(*) AS total, count(latitude) AS com_coordenadas, count(*) - count(latitude) AS sem_latitude
FROM listings"""))
def q_coords_coverage(spark, folder):
    return quality.coords(listings(spark, folder))


@query("q_gold_places", with_tables(GOLD_SQL, f"""
SELECT {KEYS}, regexp_replace(localizacao, '^(.*), (..)$', '\\1 (\\2)') AS localizacao,
       CAST(-length(localizacao) AS DOUBLE) AS latitude, CAST(-2 * length(localizacao) AS DOUBLE) AS longitude FROM gold"""))
def q_gold_places(spark, folder):
    """Gold rows enriched last, from a cache of all their places."""
    rows = gold_rows(spark, folder).select(*KEY, "localizacao", "latitude", "longitude")
    place = F.concat_ws(", ", "cidade", "uf")
    known = base(spark, folder).select(
        place.alias("location"), (-F.length(place)).cast("double").alias("lat"), (-2 * F.length(place)).cast("double").alias("lon"),
        F.concat(F.col("cidade"), F.lit(" ("), F.col("uf"), F.lit(")")).alias("normalized"),
    ).distinct()
    return geo.enrich(rows, known)
