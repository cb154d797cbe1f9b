"""What is written and read back: delimited text, runs of a layer, the place cache, the profile, the export.

Each query writes below the session's shared folder, in a folder of its own.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators import geo, profile
from vitrine.plans.catalog.places import _CACHE, cache
from vitrine.plans.catalog.registry import (
    BASE_SQL, KEYS, LISTINGS_SQL, base, listings, near, query, with_tables,
)
from vitrine.session import shared_folder
from vitrine.sources import layers, tables
from vitrine.sources.tables import KEY


def new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_CSV = T.StructType([
    *[T.StructField(c, T.IntegerType() if c == "l_linenumber" else T.LongType()) for c in KEY],
    T.StructField("marca", T.StringType()), T.StructField("nota", T.StringType()),
    T.StructField("km", T.LongType()), T.StructField("preco", T.DoubleType()),
])


@query("q_csv_roundtrip", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, marca, modelo || '; "' || marca || '",' || chr(10) || versao AS nota, km, preco FROM listings"""))
def q_csv_roundtrip(spark, folder):
    """Texts with quotes, separators and line ends, and numbers with gaps."""
    note = F.concat("modelo", F.lit('; "'), "marca", F.lit('",\n'), "versao")
    path = new_folder(spark, "csv")
    layers.write_csv(listings(spark, folder).select(*KEY, "marca", note.alias("nota"), "km", "preco"), path)
    return layers.read_layer(spark, path, _CSV)


_FIRST, _SECOND = datetime(2026, 1, 1, 8), datetime(2026, 1, 2, 8)


@query("q_snapshot_rerun", with_tables(BASE_SQL, f"""
SELECT '{_FIRST.strftime(layers.STAMP)}' AS run_ts, {KEYS}, marca FROM base WHERE l_linenumber <= 3
UNION ALL SELECT '{_SECOND.strftime(layers.STAMP)}', {KEYS}, marca FROM base WHERE l_linenumber > 2"""))
def q_snapshot_rerun(spark, folder):
    """Two runs of a layer; the second is written, then written again with other rows."""
    rows, root = base(spark, folder).select(*KEY, "marca"), new_folder(spark, "runs")
    line = F.col("l_linenumber")
    for kept, run in ((line <= 3, _FIRST), (line == 1, _SECOND), (line > 2, _SECOND)):
        layers.append_snapshot(rows.where(kept), root, "bronze", run)
    return layers.snapshots(spark, root, "bronze").select("run_ts", *KEY, "marca")


@query("q_latest_run", with_tables(BASE_SQL, f"SELECT {KEYS}, marca FROM base WHERE l_linenumber > 4"))
def q_latest_run(spark, folder):
    rows, root = base(spark, folder).select(*KEY, "marca"), new_folder(spark, "runs")
    for kept, run in ((F.col("l_linenumber") > 4, _SECOND), (F.col("l_linenumber") <= 4, _FIRST)):
        layers.append_snapshot(rows.where(kept), root, "bronze", run)
    return layers.latest_snapshot(spark, root, "bronze").drop("run_ts")


@query("q_export", with_tables(BASE_SQL, f"SELECT {KEYS}, marca FROM base WHERE l_linenumber = 2"))
def q_export(spark, folder):
    """An export that a second run replaces whole."""
    rows, root = base(spark, folder).select(*KEY, "marca"), new_folder(spark, "export")
    for number in (1, 2):
        layers.replace_latest(rows.where(F.col("l_linenumber") == number), root)
    return layers.read_latest(spark, root)


@query("q_cache_roundtrip", with_tables("n AS (SELECT 1)" + _CACHE, """
SELECT form, cache.* FROM cache, (SELECT unnest(['jsonl', 'parquet']) AS form)"""))
def q_cache_roundtrip(spark, folder):
    """The place cache as lines of JSON and as Parquet."""
    known, root = cache(spark, folder), new_folder(spark, "cache")
    forms = {"jsonl": f"{root}/cache.jsonl", "parquet": f"{root}/cache"}
    for path in forms.values():
        geo.write_cache(known, path)
    read = [geo.read_cache(spark, path).select(F.lit(form).alias("form"), "*") for form, path in forms.items()]
    return read[0].unionByName(read[1])


_PROFILE = """dataset_info struct<nome: string, total_registros: long, data_coleta: string, fonte: string>,
  colunas map<string, struct<tipo: string, valores_unicos: long, valores_nulos: long, exemplo: string>>,
  estatisticas struct<numeros: map<string, struct<media: double, mediana: double, min: double, max: double>>>"""


@query("q_profile_document", with_tables(LISTINGS_SQL, f"""
SELECT 'total' AS part, 'Listings/lineitem' AS name, CAST(count(*) AS DOUBLE) AS value FROM listings
UNION ALL SELECT 'unique', 'marca', count(DISTINCT marca) FROM listings
UNION ALL SELECT 'unique', 'preco', count(DISTINCT preco) FROM listings
UNION ALL SELECT 'null', 'km', count(*) - count(km) FROM listings
UNION ALL SELECT 'mean', 'preco', near(avg(preco), 4) FROM listings
UNION ALL SELECT 'median', 'km', median(km) FROM listings
UNION ALL SELECT 'brand', marca, count(*) FROM listings GROUP BY marca"""))
def q_profile_document(spark, folder):
    """The profile as it stands in its files, entry by entry."""
    rows, root = listings(spark, folder), new_folder(spark, "profile")
    rows = rows.select(*KEY, "marca", "preco", "km", F.date_format("l_shipdate", "yyyy-MM-dd").alias("data_coleta"))
    profile.write_profile(rows, root, "Listings", "lineitem", KEY)
    info, columns, numbers = F.col("dataset_info"), F.col("colunas"), F.col("estatisticas.numeros")
    entries = [
        ("total", F.concat_ws("/", info["nome"], info["fonte"]), info["total_registros"]),
        ("unique", F.lit("marca"), columns["marca"]["valores_unicos"]),
        ("unique", F.lit("preco"), columns["preco"]["valores_unicos"]),
        ("null", F.lit("km"), columns["km"]["valores_nulos"]),
        ("mean", F.lit("preco"), near(numbers["preco"]["media"], 4)),
        ("median", F.lit("km"), numbers["km"]["mediana"]),
    ]
    nested = spark.read.schema(_PROFILE).json(f"{root}/profile").select(F.explode(F.array(*[
        F.struct(F.lit(part).alias("part"), name.alias("name"), value.cast("double").alias("value"))
        for part, name, value in entries
    ])).alias("e")).select("e.*")
    brands = spark.read.schema("marca string, n long").json(f"{root}/marcas")
    return nested.unionByName(brands.select(
        F.lit("brand").alias("part"), F.col("marca").alias("name"), F.col("n").cast("double").alias("value")))
