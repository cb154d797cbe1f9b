"""Validation, quality and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import profile, quality
from vitrine.plans.catalog.registry import (
    KEYS, LINES_SQL, LISTINGS_SQL, cards, listings, query, rounded, with_tables,
)
from vitrine.sources.tables import KEY

_VERDICT = """CASE WHEN cls = 0 THEN 'muito curto (2 elementos)' WHEN cls IN (1, 4) THEN 'dados básicos ausentes'
  WHEN cls = 3 THEN 'padrão de ano inválido em ''' || info || '''' ELSE 'valid' END"""


@query("q_card_verdicts", with_tables(LINES_SQL, f"SELECT {KEYS}, {_VERDICT} AS verdict FROM lines"))
def q_card_verdicts(spark, folder):
    return quality.card_verdicts(cards(spark, folder), KEY)


@query("q_validate_cards", with_tables(LINES_SQL + f", verdicts AS (SELECT *, {_VERDICT} AS verdict FROM lines)", f"""
SELECT avg(CASE WHEN verdict = 'valid' THEN 1.0 ELSE 0.0 END) >= 0.8 AS valid,
       near(avg(CASE WHEN verdict = 'valid' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS pass_rate,
       count(*) AS total_cards, count(*) FILTER (verdict = 'valid') AS valid_cards,
       (SELECT string_agg('Card ' || l_orderkey || ': ' || verdict, '|' ORDER BY {KEYS}) FROM
         (SELECT * FROM verdicts WHERE verdict <> 'valid' ORDER BY {KEYS} LIMIT 10)) AS errors
FROM verdicts"""))
def q_validate_cards(spark, folder):
    result = quality.validate_cards(cards(spark, folder), KEY)
    return rounded(result, 6, "pass_rate").withColumn("errors", F.array_join("errors", "|"))


_REPORT = """SELECT count(*) AS total_registros, count(preco) AS registros_com_preco, count(km) AS registros_com_km,
  count(ano_fabricacao) AS registros_com_ano, count(localizacao) AS registros_com_localizacao,
  count(DISTINCT marca) AS marcas_unicas,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM listings GROUP BY modelo, versao, ano_fabricacao))
  AS duplicatas, near(count(preco) * 100.0::DOUBLE / count(*), 6) AS perc_preco,
  near(count(km) * 100.0::DOUBLE / count(*), 6) AS perc_km,
  near(count(ano_fabricacao) * 100.0::DOUBLE / count(*), 6) AS perc_ano,
  near(count(localizacao) * 100.0::DOUBLE / count(*), 6) AS perc_local FROM listings"""


@query("q_quality_report", with_tables(LISTINGS_SQL, _REPORT))
def q_quality_report(spark, folder):
    return rounded(quality.report(listings(spark, folder)), 6)


@query("q_duplicates", with_tables(LISTINGS_SQL, """
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicatas
FROM (SELECT count(*) AS n FROM listings GROUP BY modelo, versao, ano_fabricacao)"""))
def q_duplicates(spark, folder):
    return quality.duplicates(listings(spark, folder))


@query("q_sla", with_tables(LISTINGS_SQL, """
SELECT near(count(preco) * 100.0::DOUBLE / count(*), 6) AS perc_preco, 90.0::DOUBLE AS target,
       count(preco) * 100.0::DOUBLE / count(*) >= 90 AS met,
       CASE WHEN count(preco) * 100.0::DOUBLE / count(*) >= 90 THEN 'SLA atendido' ELSE 'SLA não atendido' END AS verdict
FROM listings"""))
def q_sla(spark, folder):
    return rounded(quality.sla(quality.report(listings(spark, folder))), 6)


@query("q_basic_stats", with_tables(LISTINGS_SQL, """
SELECT count(*) AS total_carros, count(DISTINCT marca) AS marcas_unicas, near(avg(preco), 4) AS preco_medio,
       min(preco) AS preco_min, max(preco) AS preco_max, near(avg(km), 4) AS km_medio,
       near(avg(ano_fabricacao), 4) AS ano_medio FROM listings"""))
def q_basic_stats(spark, folder):
    return rounded(profile.basic_stats(listings(spark, folder)))


def _top_sql(column: str, n: int) -> str:
    return with_tables(LISTINGS_SQL, f"""
SELECT {column}, count(*) AS n FROM listings WHERE {column} IS NOT NULL GROUP BY {column}
ORDER BY n DESC, {column} LIMIT {n}""")


@query("q_top_brands", _top_sql("marca", 5))
def q_top_brands(spark, folder):
    return profile.top_values(listings(spark, folder), "marca", 5)


@query("q_top_locations", _top_sql("localizacao", 3))
def q_top_locations(spark, folder):
    return profile.top_values(listings(spark, folder), "localizacao", 3)


@query("q_brand_counts", with_tables(LISTINGS_SQL, "SELECT marca, count(*) AS n FROM listings GROUP BY marca"))
def q_brand_counts(spark, folder):
    return profile.value_counts(listings(spark, folder), "marca")


_PROFILED = {
    **{k: "int" if k == "l_linenumber" else "bigint" for k in KEY}, "id": "bigint", "marca": "string", "modelo": "string", "versao": "string", "ano_fabricacao": "int",
    "ano_modelo": "int", "km": "bigint", "localizacao": "string", "compra_online": "string", "preco": "double", "l_shipdate": "timestamp_ntz",
    "latitude": "double", "longitude": "double", "faixa_preco": "string", "faixa_km": "string", "idade_veiculo": "int",
    "preco_por_km": "double",
}
# Doubles are printed differently; their examples are compared as whole thousandths.
_SHOWN = {c: f"CAST(CAST(floor({c} * 1000) AS BIGINT) AS VARCHAR)" if kind == "double" else f"CAST({c} AS VARCHAR)" for c, kind in _PROFILED.items()}


@query("q_column_profile", with_tables(LISTINGS_SQL, " UNION ALL ".join(f"""
SELECT '{c}' AS coluna, '{kind}' AS tipo, count(DISTINCT {c}) AS valores_unicos,
       count(*) - count({c}) AS valores_nulos,
       (SELECT {_SHOWN[c]} FROM listings WHERE {c} IS NOT NULL ORDER BY {KEYS} LIMIT 1) AS exemplo
FROM listings""" for c, kind in _PROFILED.items())))
def q_column_profile(spark, folder):
    """Every column of the listings."""
    found = profile.columns(listings(spark, folder), KEY)
    number = F.floor(F.expr("try_cast(exemplo as double)") * 1000).cast("string")
    return found.withColumn("exemplo", F.when(F.col("tipo") == "double", number).otherwise(F.col("exemplo")))


@query("q_numeric_stats", with_tables(LISTINGS_SQL, " UNION ALL ".join(f"""
SELECT '{c}' AS coluna, near(avg({c}), 4) AS media, near(median({c})::DOUBLE, 4) AS mediana,
       min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, near(stddev_samp({c}), 4) AS desvio_padrao
FROM listings""" for c in ("preco", "km"))))
def q_numeric_stats(spark, folder):
    return rounded(profile.numeric_stats(listings(spark, folder)))


@query("q_dataset_header", with_tables(LISTINGS_SQL, f"""
SELECT 'Listings' AS nome, count(*) AS total_registros,
       (SELECT strftime(l_shipdate, '%Y-%m-%d') FROM listings ORDER BY {KEYS} LIMIT 1) AS data_coleta,
       'lineitem' AS fonte FROM listings"""))
def q_dataset_header(spark, folder):
    rows = listings(spark, folder).withColumn("data_coleta", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return profile.header(rows, "Listings", "lineitem", KEY)
