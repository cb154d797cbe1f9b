"""Registration of queries, and the inputs they share in DataFrame and in SQL form."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.operators import gold, silver
from vitrine.sources import tables
from vitrine.sources.tables import KEY

AS_OF = datetime(2026, 1, 1)
KEYS = ", ".join(KEY)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
STATEMENTS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows (None: not expressible)."""
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            STATEMENTS[name] = expand_near(sql)
        return function

    return add


# Both sides round with the same arithmetic. The offset is just below a half, so a mean that
# ends in an exact 5 is not decided by the order in which a sum was added up.
OFFSET = 0.4997


def near(value: Column, digits: int) -> Column:
    scale = 10.0**digits
    return F.floor(value * scale + OFFSET) / scale


def expand_near(sql: str) -> str:
    """`near(expression, digits)` in a statement to plain SQL."""
    while (start := sql.find("near(")) >= 0:
        depth, end = 1, start + 5
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        expression, digits = sql[start + 5 : end - 1].rsplit(",", 1)
        scale = f"1e{int(digits)}"
        sql = f"{sql[:start]}floor(({expression}) * {scale} + {OFFSET}e0) / {scale}{sql[end:]}"
    return sql


def rounded(df: DataFrame, digits: int = 4, *columns: str) -> DataFrame:
    """Round the named (default: all double) columns so that summation order does not show."""
    names = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: near(F.col(c), digits) for c in names})


# ------------------------------------------------------------------- DataFrame inputs
def base(spark: SparkSession, folder: str) -> DataFrame:
    return tables.listing_base(spark, folder)


def cards(spark: SparkSession, folder: str) -> DataFrame:
    return tables.listing_cards(spark, folder)


def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver.build(cards(spark, folder), AS_OF, keep=KEY)


def gold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return gold.build(silver_rows(spark, folder), keep=KEY)


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Gold-like rows with gaps: no price in class 2, no year in class 3, no mileage in class 5,
    no place in class 6. Stands for a stored Gold table."""
    kind = F.col("cls")
    gaps = base(spark, folder).select(
        *KEY, "id", "marca", F.col("nome").alias("modelo"), "versao",
        F.when(kind != 3, F.col("ano_fabricacao")).alias("ano_fabricacao"), "ano_modelo",
        F.when(kind != 5, F.col("km")).alias("km"),
        F.when(kind != 6, F.concat_ws(", ", "cidade", "uf")).alias("localizacao"),
        "compra_online", F.when(kind != 2, F.col("preco")).alias("preco"), "l_shipdate",
        F.when(F.col("n_nationkey") < 15, F.col("n_nationkey").cast("double")).alias("latitude"),
        F.when(F.col("n_nationkey") < 15, -F.col("n_nationkey").cast("double")).alias("longitude"),
    )
    derived = silver.derive(gaps, AS_OF)
    return derived.withColumn("faixa_preco", gold.tier_label(F.col("faixa_preco")))


# -------------------------------------------------------------------------- SQL inputs
_CITIES = "[" + ", ".join(f"'{city}'" for city, _ in tables.PLACES) + "]"
_STATES = "[" + ", ".join(f"'{state}'" for _, state in tables.PLACES) + "]"


def sql_tier(column: str, edges, labels, lowest: str = ">=") -> str:
    """CASE over right-closed bins."""
    steps = " ".join(
        f"WHEN {column} <= {upper} THEN '{label}'" for upper, label in zip(edges[1:], labels)
    )
    return f"CASE WHEN {column} {lowest} {edges[0]} THEN CASE {steps} ELSE '{labels[-1]}' END END"


def sql_price_tier(column: str = "preco", lowest: str = ">=") -> str:
    return sql_tier(column, lookups.PRICE_EDGES, lookups.PRICE_LABELS, lowest)


def sql_km_tier(column: str = "km", lowest: str = ">=") -> str:
    return sql_tier(column, lookups.KM_EDGES, lookups.KM_LABELS, lowest)


PRICE_LABELS_IN_CURRENCY = [
    "Até R$ 30k", "R$ 30k - R$ 50k", "R$ 50k - R$ 80k", "R$ 80k - R$ 120k", "R$ 120k+",
]


def sql_price_label(column: str = "preco") -> str:
    return sql_tier(column, lookups.PRICE_EDGES, PRICE_LABELS_IN_CURRENCY)


MONEY_SQL = "translate(format('{:,.2f}', preco), '.,', ',.')"
KM_SQL = "replace(format('{:,}', km), ',', '.')"

BASE_SQL = f"""base AS (
  SELECT {KEYS}, l_orderkey * 8 + l_linenumber AS id, p_brand AS marca, p_name AS nome,
         p_type || ' ' || p_size AS versao, l_extendedprice AS preco,
         (l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 160000 AS km,
         CAST(year(l_shipdate) AS INTEGER) AS ano_fabricacao,
         CAST(year(l_shipdate) + l_linenumber % 2 AS INTEGER) AS ano_modelo,
         {_CITIES}[n_nationkey % 5 + 1] AS cidade, {_STATES}[n_nationkey % 5 + 1] AS uf,
         n_nationkey, n_name, s_name,
         CASE WHEN l_linenumber % 2 = 0 THEN 'Sim' ELSE 'Não' END AS compra_online,
         CAST((l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 50 AS INTEGER) AS cls, l_shipdate
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey)"""

# Lines of the rendered cards, by name; class 0 keeps two of them and class 1 three.
LINES_SQL = BASE_SQL + f""", lines AS (
  SELECT *, CASE WHEN cls = 4 THEN '' ELSE marca || ' ' || nome END AS titulo,
         CASE WHEN cls = 3 THEN 'sem ano' ELSE ano_fabricacao || '/' || ano_modelo END
           || ' • ' || {KM_SQL} || ' KM • ' || cidade || ', ' || uf AS info,
         CASE WHEN cls = 2 THEN 'Consulte' ELSE 'R$ ' || {MONEY_SQL} END AS linha_preco,
         'Entrada + parcelas a partir de R$ ' || (km % 900 + 100) || '*' AS termos,
         'COMPRA_ONLINE: ' || compra_online AS flag
  FROM base)"""

# What a parse of the cards must give back.
SILVER_SQL = LINES_SQL + f""", parsed AS (
  SELECT {KEYS}, id, CASE WHEN cls <> 4 THEN marca END AS marca, titulo AS modelo, versao,
         CASE WHEN cls <> 3 THEN ano_fabricacao END AS ano_fabricacao,
         CASE WHEN cls <> 3 THEN ano_modelo END AS ano_modelo, km,
         cidade || ', ' || uf AS localizacao,
         CASE WHEN cls IN (1, 2) THEN '' ELSE 'R$ ' || {MONEY_SQL} END AS preco_bruto,
         CASE WHEN cls = 1 THEN '' ELSE termos END AS condicoes,
         titulo || ' ' || versao || ' ' || info || CASE WHEN cls = 1 THEN '' ELSE
           ' ' || linha_preco || ' ' || termos || ' ' || flag END AS texto_completo,
         CASE WHEN cls NOT IN (1, 2) THEN preco END AS preco,
         CASE WHEN cls <> 1 THEN compra_online END AS compra_online, nome
  FROM lines WHERE cls <> 0),
silver AS (
  SELECT *, {sql_price_tier()} AS faixa_preco, {sql_km_tier()} AS faixa_km,
         CAST(2026 - ano_fabricacao AS INTEGER) AS idade_veiculo,
         CASE WHEN km > 0 THEN preco / km END AS preco_por_km
  FROM parsed)"""

GOLD_SQL = SILVER_SQL + f""", gold AS (
  SELECT {KEYS}, id, marca, nome AS modelo, versao, ano_fabricacao, ano_modelo, km, localizacao,
         compra_online, preco AS preco_bruto, preco, {sql_price_label()} AS faixa_preco, faixa_km,
         idade_veiculo, preco_por_km,
         trim(regexp_replace(replace(texto_completo, '•', ''), ' +', ' ', 'g')) AS texto_completo
  FROM silver WHERE marca IS NOT NULL AND preco IS NOT NULL)"""

LISTINGS_SQL = BASE_SQL + f""", gaps AS (
  SELECT {KEYS}, id, marca, nome AS modelo, versao,
         CASE WHEN cls <> 3 THEN ano_fabricacao END AS ano_fabricacao, ano_modelo,
         CASE WHEN cls <> 5 THEN km END AS km,
         CASE WHEN cls <> 6 THEN cidade || ', ' || uf END AS localizacao, compra_online,
         CASE WHEN cls <> 2 THEN preco END AS preco, l_shipdate,
         CASE WHEN n_nationkey < 15 THEN CAST(n_nationkey AS DOUBLE) END AS latitude,
         CASE WHEN n_nationkey < 15 THEN -CAST(n_nationkey AS DOUBLE) END AS longitude
  FROM base), listings AS (
  SELECT *, {sql_price_label()} AS faixa_preco, {sql_km_tier()} AS faixa_km,
         CAST(2026 - ano_fabricacao AS INTEGER) AS idade_veiculo,
         CASE WHEN km > 0 THEN preco / km END AS preco_por_km
  FROM gaps)"""


def with_tables(prefix: str, select: str) -> str:
    """`WITH` the given tables; a select that opens with a comma adds tables of its own."""
    return f"WITH {prefix} {select}"


