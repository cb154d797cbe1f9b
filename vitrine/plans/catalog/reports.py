"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.operators import report
from vitrine.plans.catalog.registry import (
    GOLD_SQL, KEYS, LISTINGS_SQL, PRICE_LABELS_IN_CURRENCY, gold_rows, listings, query, rounded,
    with_tables,
)
from vitrine.sources.tables import KEY


@query("q_kpis", with_tables(GOLD_SQL, """
SELECT count(id) AS total_carros, near(avg(preco), 4) AS preco_medio, near(avg(km), 4) AS km_medio FROM gold"""))
def q_kpis(spark, folder):
    return rounded(report.kpis(gold_rows(spark, folder)))


@query("q_brand_means", with_tables(GOLD_SQL, """
SELECT marca, count(*) AS n, near(avg(preco), 4) AS preco_medio, near(avg(idade_veiculo), 4) AS idade_media
FROM gold GROUP BY marca"""))
def q_brand_means(spark, folder):
    return rounded(report.brand_means(gold_rows(spark, folder)))


@query("q_brand_bars", with_tables(LISTINGS_SQL, "SELECT marca, count(id) AS n FROM listings GROUP BY marca"))
def q_brand_bars(spark, folder):
    return report.by_brand(listings(spark, folder))


@query("q_location_map", with_tables(LISTINGS_SQL, """
SELECT localizacao, count(*) AS n, near(sum(preco), 2) AS preco_total, near(avg(preco), 4) AS preco_medio
FROM listings GROUP BY localizacao"""))
def q_location_map(spark, folder):
    return rounded(rounded(report.by_location(listings(spark, folder)), 2, "preco_total"), 4, "preco_medio")


@query("q_price_histogram", with_tables(LISTINGS_SQL, """
, b AS (SELECT min(preco) AS low, (max(preco) - min(preco)) / 20.0::DOUBLE AS width FROM listings),
c AS (SELECT CAST(least(floor((preco - low) / width), 19) AS INTEGER) AS bin, count(*) AS n
      FROM listings, b WHERE preco IS NOT NULL GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, near(low + i * width, 4) AS de, near(low + (i + 1) * width, 4) AS ate,
       coalesce(n, 0) AS n FROM range(20) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = i"""))
def q_price_histogram(spark, folder):
    return rounded(report.histogram(listings(spark, folder), "preco", 20))


@query("q_scatter", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, km, preco, idade_veiculo FROM listings WHERE km IS NOT NULL AND preco IS NOT NULL"""))
def q_scatter(spark, folder):
    return report.scatter(listings(spark, folder), KEY)


@query("q_boxplot", with_tables(LISTINGS_SQL, """
SELECT marca, min(preco) AS minimo, near(quantile_cont(preco, 0.25), 4) AS q1, near(median(preco), 4) AS mediana,
       near(quantile_cont(preco, 0.75), 4) AS q3, max(preco) AS maximo FROM listings GROUP BY marca"""))
def q_boxplot(spark, folder):
    return rounded(report.boxplot(listings(spark, folder)))


@query("q_slicer_values", with_tables(LISTINGS_SQL, " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS campo, {c} AS valor FROM listings WHERE {c} IS NOT NULL"
    for c in ("marca", "faixa_preco", "faixa_km"))))
def q_slicer_values(spark, folder):
    return report.slicer_values(listings(spark, folder))


@query("q_slice", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, marca, preco FROM listings WHERE faixa_preco = '{PRICE_LABELS_IN_CURRENCY[2]}'
AND faixa_km IN ('{lookups.KM_LABELS[0]}', '{lookups.KM_LABELS[1]}')"""))
def q_slice(spark, folder):
    cut = report.slice_by(
        listings(spark, folder), faixa_preco=PRICE_LABELS_IN_CURRENCY[2], faixa_km=lookups.KM_LABELS[:2]
    )
    return cut.select(*KEY, "marca", "preco")


@query("q_correlations", with_tables(LISTINGS_SQL, " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, near(corr({a}, {b}), 6) AS corr FROM listings"
    for a, b in (("preco", "km"), ("preco", "ano_fabricacao"), ("km", "ano_fabricacao")))))
def q_correlations(spark, folder):
    return rounded(report.correlations(listings(spark, folder)), 6)


@query("q_tier_counts", with_tables(LISTINGS_SQL, """
SELECT faixa_preco, count(*) AS n FROM listings WHERE faixa_preco IS NOT NULL GROUP BY faixa_preco"""))
def q_tier_counts(spark, folder):
    return report.tier_counts(listings(spark, folder))


@query("q_by_year", with_tables(LISTINGS_SQL, """
SELECT ano_fabricacao, count(*) AS n, near(avg(preco), 4) AS preco_medio, near(avg(km), 4) AS km_medio
FROM listings WHERE ano_fabricacao IS NOT NULL GROUP BY ano_fabricacao"""))
def q_by_year(spark, folder):
    return rounded(report.by_year(listings(spark, folder)))


@query("q_hierarchy_rollup", with_tables(LISTINGS_SQL, """
SELECT marca, modelo, versao, CAST(grouping_id(marca, modelo, versao) AS INTEGER) AS nivel, count(*) AS n,
       near(avg(preco), 4) AS preco_medio FROM listings GROUP BY ROLLUP (marca, modelo, versao)"""))
def q_hierarchy_rollup(spark, folder):
    return rounded(report.hierarchy(listings(spark, folder)))


@query("q_place_hierarchy", with_tables(LISTINGS_SQL, """
, p AS (SELECT trim(split_part(localizacao, ',', -1)) AS estado, trim(split_part(localizacao, ',', 1)) AS cidade,
        preco FROM listings)
SELECT estado, cidade, CAST(grouping_id(estado, cidade) AS INTEGER) AS nivel, count(*) AS n,
       near(avg(preco), 4) AS preco_medio FROM p GROUP BY ROLLUP (estado, cidade)"""))
def q_place_hierarchy(spark, folder):
    """Listings without a place stand under a place that is null."""
    return rounded(report.hierarchy(report.place_parts(listings(spark, folder)), ["estado", "cidade"]))


@query("q_brand_location", with_tables(LISTINGS_SQL, """
SELECT marca, localizacao, count(*) AS n, near(avg(preco), 4) AS preco_medio FROM listings
GROUP BY marca, localizacao"""))
def q_brand_location(spark, folder):
    return rounded(report.cross(listings(spark, folder)))


_HEAT = ["km_ate_30k", "km_30k_60k", "km_60k_100k", "km_100k_150k", "km_150k"]


@query("q_tier_heatmap", with_tables(LISTINGS_SQL, "SELECT ano_fabricacao, " + ", ".join(
    f"near(avg(preco) FILTER (faixa_km = '{label}'), 4) AS {name}" for label, name in zip(lookups.KM_LABELS, _HEAT)
) + " FROM listings GROUP BY ano_fabricacao"))
def q_tier_heatmap(spark, folder):
    return rounded(report.tier_heatmap(listings(spark, folder), lookups.KM_LABELS, _HEAT))


@query("q_best_locations", with_tables(LISTINGS_SQL, """
SELECT localizacao, count(*) AS n, near(avg(preco), 4) AS preco_medio,
       near(avg(CASE WHEN idade_veiculo <= 26 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS novos
FROM listings WHERE localizacao IS NOT NULL GROUP BY localizacao ORDER BY avg(preco), localizacao LIMIT 3"""))
def q_best_locations(spark, folder):
    best = report.offers(listings(spark, folder), 3, new_age=26)
    return rounded(rounded(best, 4, "preco_medio"), 6, "novos")


@query("q_opportunity", with_tables(LISTINGS_SQL, f"""
, e AS (SELECT *, avg(preco) OVER (PARTITION BY marca, ano_fabricacao) AS esperado FROM listings
        WHERE preco IS NOT NULL AND ano_fabricacao IS NOT NULL)
SELECT {KEYS}, marca, ano_fabricacao, preco, near(esperado, 4) AS preco_esperado,
       near((esperado - preco) / esperado, 6) AS desvalorizacao FROM e"""))
def q_opportunity(spark, folder):
    gaps = report.opportunity(listings(spark, folder), KEY)
    return rounded(rounded(gaps, 4, "preco_esperado"), 6, "desvalorizacao")
