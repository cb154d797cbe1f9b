"""Bronze, Silver and Gold steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.functions.numbers import format_count, format_currency, money, tier
from vitrine.operators import bronze, gold, lookup, quality, runlog, silver
from vitrine.plans.catalog.registry import (
    AS_OF, BASE_SQL, GOLD_SQL, KEYS, LINES_SQL, LISTINGS_SQL, MONEY_SQL, SILVER_SQL, base, cards,
    gold_rows, listings, near, query, rounded, silver_rows, sql_km_tier, sql_price_label, sql_price_tier,
    with_tables,
)
from vitrine.schemas import BRONZE_TEXT_COLUMNS
from vitrine.sources import layers, pages, tables
from vitrine.sources.tables import KEY

# ------------------------------------------------------------------------------ Bronze
_FULL = "CASE WHEN cls IN (0, 1) THEN '' ELSE {} END"


@query("q_bronze", with_tables(LINES_SQL, f"""
SELECT {KEYS}, id, titulo AS marca_modelo, versao, CASE WHEN cls = 0 THEN '' ELSE info END AS info_line,
       {_FULL.format('linha_preco')} AS preco_bruto, {_FULL.format('termos')} AS condicoes,
       {_FULL.format('flag')} AS detalhes, '' AS extra1, '' AS extra2, '' AS extra3, '' AS extra4
FROM lines"""))
def q_bronze(spark, folder):
    named = bronze.from_cards(cards(spark, folder), AS_OF, KEY)
    return named.select(*KEY, "id", *BRONZE_TEXT_COLUMNS)


_SOURCE = f"SELECT {KEYS}, marca AS source FROM base"


@query("q_cap_per_source", with_tables(BASE_SQL, f"""
{_SOURCE} QUALIFY row_number() OVER (PARTITION BY marca ORDER BY {KEYS}) <= 40"""))
def q_cap_per_source(spark, folder):
    return bronze.cap_per_source(cards(spark, folder), 40, KEY).select(*KEY, "source")


@query("q_cap_overall", with_tables(BASE_SQL, f"{_SOURCE} ORDER BY {KEYS} LIMIT 1000"))
def q_cap_overall(spark, folder):
    return bronze.cap_overall(cards(spark, folder), 1000, KEY).select(*KEY, "source")


@query("q_union_sources", with_tables(BASE_SQL, f"""
{_SOURCE} UNION ALL SELECT {KEYS}, s_name AS source FROM base"""))
def q_union_sources(spark, folder):
    """Every listing under its brand and again under its dealer."""
    rows = base(spark, folder)
    return bronze.union_sources([
        rows.select(*KEY, F.col("marca").alias("source")),
        rows.select(F.col("s_name").alias("source"), *KEY),
    ])


def listing_pages(spark, folder):
    """A page per listing: its card, the same card to reserve online, and one outside a link."""
    lines = F.transform("lines", lambda line: F.concat(F.lit("<p>"), line, F.lit("</p>")))
    inner = F.array_join(F.slice(lines, 1, 4), "")
    link = F.lit('<a href="/carro"><card class="c">')
    html = F.concat(
        F.lit("<html><body>"), link, inner, F.lit("</card></a>\n"),
        link, inner, F.lit("<button>Reservar online</button></card></a>"),
        F.lit("<card>"), inner, F.lit("</card></body></html>"),
    )
    return cards(spark, folder).select(*KEY, "source", html.alias("html"))


@query("q_cards_from_pages", with_tables(LINES_SQL, f"""
SELECT {KEYS}, card, array_to_string([x for x in [titulo, versao,
         CASE WHEN cls <> 0 THEN info END, CASE WHEN cls NOT IN (0, 1) THEN linha_preco END,
         CASE WHEN card = 1 THEN 'Reservar online' END,
         'COMPRA_ONLINE: ' || CASE WHEN card = 1 THEN 'Sim' ELSE 'Não' END]
         if x IS NOT NULL AND x <> ''], '|') AS lines
FROM lines, (SELECT CAST(unnest([0, 1]) AS INTEGER) AS card)"""))
def q_cards_from_pages(spark, folder):
    found = pages.cards_from_pages(listing_pages(spark, folder), tuple(KEY))
    return found.select(*KEY, "card", F.array_join("lines", "|").alias("lines"))


@query("q_structure_check", with_tables(BASE_SQL, """
SELECT marca AS source, CAST(2 * count(*) AS BIGINT) AS cards, true AS ok FROM base GROUP BY marca
UNION ALL SELECT 'pages', 0, false"""))
def q_structure_check(spark, folder):
    plain = tables.table(spark, folder, "pages").select(F.lit("pages").alias("source"), "html")
    return quality.structure_check(
        listing_pages(spark, folder).select("source", "html").unionByName(plain)
    )


@query("q_latest_snapshot", """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS run_ts, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)""")
def q_latest_snapshot(spark, folder):
    runs = tables.table(spark, folder, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("run_ts"), *KEY
    )
    return layers.latest(runs)


# ------------------------------------------------------------------------------ Silver
@query("q_parse_cards", with_tables(SILVER_SQL, f"""
SELECT {KEYS}, marca, modelo, versao, ano_fabricacao, ano_modelo, km, localizacao, preco_bruto,
       condicoes, texto_completo, compra_online FROM parsed"""))
def q_parse_cards(spark, folder):
    return silver.parse(cards(spark, folder), keep=KEY).drop("id")


@query("q_silver", with_tables(SILVER_SQL, f"""
SELECT {KEYS}, id, marca, modelo, versao, ano_fabricacao, ano_modelo, km, localizacao, preco_bruto,
       condicoes, texto_completo, preco, faixa_preco, faixa_km, idade_veiculo,
       near(preco_por_km, 6) AS preco_por_km, compra_online FROM silver"""))
def q_silver(spark, folder):
    return rounded(silver_rows(spark, folder).drop("data_coleta"), 6, "preco_por_km")


@query("q_brand_prefix", with_tables(BASE_SQL, f"SELECT {KEYS}, marca FROM base"))
def q_brand_prefix(spark, folder):
    # 'Brand#1' opens 'brand#13 ...' as well: the longer name has priority.
    brands = tables.table(spark, folder, "part").select(F.col("p_brand").alias("name")).distinct()
    names = brands.withColumn("priority", F.struct(-F.length("name"), "name"))
    titles = base(spark, folder).select(*KEY, F.lower(F.concat_ws(" ", "marca", "nome")).alias("titulo"))
    found = lookup.first_match(titles, "titulo", names)
    return found.select(*KEY, F.col("entry.name").alias("marca"))


@query("q_conditions", with_tables(SILVER_SQL, f"SELECT {KEYS}, condicoes FROM parsed"))
def q_conditions(spark, folder):
    usable = silver.valid_cards(cards(spark, folder))
    return usable.select(*KEY, silver.conditions(F.col("lines")).alias("condicoes"))


@query("q_price_numeric", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE WHEN cls <> 2 THEN preco END AS preco_bruto FROM base"""))
def q_price_numeric(spark, folder):
    kind = F.col("cls")
    text = F.when(kind == 2, F.lit("Consulte")).otherwise(
        F.concat(tables.money_text(F.col("preco")), F.when(kind == 3, F.lit(" à vista")).otherwise(F.lit("")))
    )
    once = gold.price_raw_numeric(base(spark, folder).select(*KEY, text.alias("preco_bruto")))
    return gold.price_raw_numeric(once)


@query("q_money_text", with_tables(BASE_SQL, f"SELECT {KEYS}, preco FROM base"))
def q_money_text(spark, folder):
    rows = base(spark, folder)
    return rows.select(*KEY, money(tables.money_text(F.col("preco"))).alias("preco"))


@query("q_coerce", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE WHEN cls <> 1 THEN km END AS km, CASE WHEN cls <> 2 THEN ano_fabricacao END AS ano_fabricacao,
       ano_modelo FROM base"""))
def q_coerce(spark, folder):
    kind = F.col("cls")
    text = base(spark, folder).select(
        *KEY,
        F.when(kind == 1, F.lit("n/d")).otherwise(tables.thousands(F.col("km"))).alias("km"),
        F.when(kind == 2, F.lit("")).otherwise(F.col("ano_fabricacao").cast("string"))
        .alias("ano_fabricacao"),
        F.col("ano_modelo").cast("string").alias("ano_modelo"),
    )
    return silver.coerce(text)


@query("q_price_tier", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, preco, {sql_price_tier()} AS faixa_preco FROM listings"""))
def q_price_tier(spark, folder):
    label = tier(F.col("preco"), lookups.PRICE_EDGES, lookups.PRICE_LABELS)
    return listings(spark, folder).select(*KEY, "preco", label.alias("faixa_preco"))


@query("q_km_tier", with_tables(LISTINGS_SQL, f"SELECT {KEYS}, km, {sql_km_tier()} AS faixa_km FROM listings"))
def q_km_tier(spark, folder):
    label = tier(F.col("km"), lookups.KM_EDGES, lookups.KM_LABELS)
    return listings(spark, folder).select(*KEY, "km", label.alias("faixa_km"))


@query("q_age", with_tables(LISTINGS_SQL, f"SELECT {KEYS}, idade_veiculo FROM listings"))
def q_age(spark, folder):
    rows = listings(spark, folder)
    return rows.select(*KEY, silver.age(F.col("ano_fabricacao"), AS_OF).alias("idade_veiculo"))


@query("q_price_per_km", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, near(preco_por_km, 6) AS preco_por_km FROM listings"""))
def q_price_per_km(spark, folder):
    ratio = silver.price_per_km(F.col("preco"), F.col("km"))
    return listings(spark, folder).select(*KEY, near(ratio, 6).alias("preco_por_km"))


@query("q_reparse_text", with_tables(SILVER_SQL, f"""
SELECT {KEYS}, ano_fabricacao, ano_modelo, CASE WHEN ano_fabricacao IS NOT NULL THEN km END AS km,
       CASE WHEN ano_fabricacao IS NOT NULL THEN faixa_km END AS faixa_km, idade_veiculo FROM silver"""))
def q_reparse_text(spark, folder):
    again = silver.reparse_text(silver_rows(spark, folder), AS_OF)
    return again.select(*KEY, "ano_fabricacao", "ano_modelo", "km", "faixa_km", "idade_veiculo")


@query("q_split_address", with_tables(BASE_SQL, f"""
SELECT {KEYS}, ano_fabricacao, ano_modelo, km, uf AS estado,
       CASE cidade WHEN 'Belo Horizonte' THEN 'Belo' WHEN 'São José do Rio Preto' THEN 'São'
            ELSE cidade END AS cidade,
       CASE cidade WHEN 'Belo Horizonte' THEN 'Horizonte ' WHEN 'São José do Rio Preto' THEN
            'José do Rio Preto ' ELSE '' END || 'Vila ' || split_part(nome, ' ', 1) AS bairro FROM base"""))
def q_split_address(spark, folder):
    place = F.concat("cidade", F.lit(" Vila "), F.substring_index("nome", " ", 1), F.lit(", "), "uf")
    info = F.concat(
        F.concat_ws("/", F.col("ano_fabricacao").cast("string"), F.col("ano_modelo").cast("string")),
        F.lit(" • "), tables.thousands(F.col("km")), F.lit(" KM • "), place,
    )
    text = F.concat_ws("\n", F.col("nome"), info, tables.money_text(F.col("preco")))
    rows = base(spark, folder).select(*KEY, "preco", text.alias("texto_completo"))
    split = silver.split_address(rows, AS_OF)
    return split.select(*KEY, "ano_fabricacao", "ano_modelo", "km", "estado", "cidade", "bairro")


@query("q_legacy_layout", with_tables(BASE_SQL, f"""
SELECT {KEYS}, marca, marca || ' ' || nome AS modelo, versao,
       CASE WHEN cls <> 3 THEN ano_fabricacao END AS ano_fabricacao,
       CASE WHEN cls <> 3 THEN ano_modelo END AS ano_modelo, km, cidade || ', ' || uf AS localizacao,
       CASE WHEN cls = 5 THEN 0.0 ELSE preco END AS preco,
       CASE WHEN cls <> 5 THEN {sql_price_tier(lowest='>')} END AS faixa_preco,
       {sql_km_tier(lowest='>')} AS faixa_km,
       CASE WHEN cls <> 3 THEN CAST(2026 - ano_fabricacao AS INTEGER) END AS idade_veiculo
FROM base WHERE cls <> 1"""))
def q_legacy_layout(spark, folder):
    kind = F.col("cls")
    years = F.concat_ws("/", F.col("ano_fabricacao").cast("string"), F.col("ano_modelo").cast("string"))
    info = F.concat(
        F.when(kind == 3, F.lit("sem ano")).otherwise(F.concat(F.lit("Ano/Modelo "), years)),
        F.lit(" • "), tables.thousands(F.col("km")), F.lit(" KM • "), F.concat_ws(", ", "cidade", "uf"),
    )
    price = F.when(kind == 5, F.lit("R$ 0")).otherwise(tables.money_text(F.col("preco")))
    whole = F.array(F.concat_ws(" ", "marca", "nome"), F.col("versao"), info, price)
    lines = F.slice(whole, F.lit(1), F.when(kind == 1, 3).otherwise(4))
    old = base(spark, folder).select(*KEY, "id", F.explode(F.array(lines)).alias("lines"))
    return silver.parse_legacy(old, AS_OF, keep=KEY).select(
        *KEY, "marca", "modelo", "versao", "ano_fabricacao", "ano_modelo", "km", "localizacao",
        "preco", "faixa_preco", "faixa_km", "idade_veiculo",
    )


# -------------------------------------------------------------------------------- Gold
@query("q_gold", with_tables(GOLD_SQL, f"""
SELECT {KEYS}, id, marca, modelo, versao, ano_fabricacao, ano_modelo, km, localizacao, compra_online,
       preco_bruto, preco, faixa_preco, faixa_km, idade_veiculo, near(preco_por_km, 6) AS preco_por_km,
       texto_completo FROM gold"""))
def q_gold(spark, folder):
    rows = gold_rows(spark, folder).drop(
        "data_coleta", "latitude", "longitude", "execucao_tempo_seg", "execucao_memoria_mb",
        "execucao_data_hora",
    )
    return rounded(rows, 6, "preco_por_km")


def _decorated(spark, folder):
    """Places with sales words around them."""
    kind = F.col("cls") % 4
    place = F.concat_ws(", ", "cidade", "uf")
    return base(spark, folder).select(
        *KEY, "cidade", "uf",
        F.when(kind == 0, F.concat(F.lit("BAIXO KM  "), place))
        .when(kind == 1, F.concat(place, F.lit(" ipva 2026 pago , - ")))
        .when(kind == 2, F.concat(F.lit("• Oferta especial "), place, F.lit(" ÚNICO  DONO •")))
        .otherwise(place).alias("localizacao"),
    )


@query("q_strip_junk", with_tables(BASE_SQL, f"SELECT {KEYS}, cidade || ', ' || uf AS localizacao FROM base"))
def q_strip_junk(spark, folder):
    return _decorated(spark, folder).select(
        *KEY, gold.strip_junk(F.col("localizacao")).alias("localizacao")
    )


@query("q_location_text", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE cls % 4 WHEN 0 THEN 'Contagem, MG' WHEN 1 THEN cidade || ', ' || uf
       WHEN 2 THEN cidade || ', ' || uf ELSE 'sem lugar' END AS localizacao FROM base"""))
def q_location_text(spark, folder):
    kind = F.col("cls") % 4
    lead = F.concat(tables.thousands(F.col("km")), F.lit(" KM "))
    tail = F.concat(F.lit(" R$ "), F.col("km").cast("string"))
    place = F.concat(F.col("cidade"), F.lit(" Centro, "), F.lower("uf"))
    text = (
        F.when(kind == 0, F.concat(lead, F.lit("• Auto Shopping Portal, MG"), tail))
        .when(kind == 1, F.concat(F.lit("BAIXO KM só "), lead, F.lit("• "), F.concat_ws(", ", "cidade", "uf"), tail))
        .when(kind == 2, F.concat(lead, F.lit("• "), place, F.lit(" OFERTA"), tail))
        .otherwise(F.lit("texto sem lugar"))
    )
    # Only listed cities lose the rest of the address, so the test city list holds all five.
    cities = [city for city, _ in tables.PLACES]
    rows = base(spark, folder).select(
        *KEY, text.alias("texto_completo"), F.lit("sem lugar").alias("localizacao")
    )
    return gold.location_from_text(rows, cities).select(*KEY, "localizacao")


@query("q_dealer_lookup", with_tables(BASE_SQL, f"SELECT {KEYS}, cidade, uf FROM base"))
def q_dealer_lookup(spark, folder):
    suppliers = tables.table(spark, folder, "supplier")
    index = (F.col("s_nationkey") % 5).cast("int")
    dealers = suppliers.select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("priority"),
        F.get(F.array(*[F.lit(c) for c, _ in tables.PLACES]), index).alias("cidade"),
        F.get(F.array(*[F.lit(s) for _, s in tables.PLACES]), index).alias("uf"),
    )
    places = base(spark, folder).select(
        *KEY, F.concat(F.lit("Auto "), F.upper("s_name"), F.lit(" loja, BR")).alias("place")
    )
    found = lookup.first_match(places, "place", dealers, contained=True)
    return found.select(*KEY, F.col("entry.cidade").alias("cidade"), F.col("entry.uf").alias("uf"))


_TOWNS = "[" + ", ".join(f"'{city}, {state}'" for _, city, state, _ in lookups.DEALERS) + "]"


@query("q_dealer_names", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE WHEN cls < 32 THEN {_TOWNS}[cls % 16 + 1] END AS localizacao FROM base"""))
def q_dealer_names(spark, folder):
    names = F.array(*[F.lit(name) for name, *_ in lookups.DEALERS])
    name = F.when(F.col("cls") < 32, F.get(names, F.col("cls") % 16)).otherwise(F.lit("Loja Central"))
    place = F.concat(F.lit("loja "), F.upper(name), F.lit(" - box, SP"))
    return base(spark, folder).select(*KEY, gold.dealer_lookup(place).alias("localizacao"))


@query("q_normalize_location", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE cls % 5 WHEN 0 THEN cidade || ', ' || uf WHEN 1 THEN cidade || ', ' || uf
       WHEN 2 THEN 'Itu, ' || uf WHEN 3 THEN 'Itu' ELSE 'Limeira, SP' END AS localizacao FROM base"""))
def q_normalize_location(spark, folder):
    kind = F.col("cls") % 5
    place = (
        F.when(kind == 0, F.concat(F.upper("cidade"), F.lit(" Centro, x"), F.lower("uf")))
        .when(kind == 1, F.concat(F.lit("loja "), F.lower("cidade"), F.lit(", "), "uf"))
        .when(kind == 2, F.concat(F.lit("Auto Shopping Itu Av. Brasil 10, "), "uf"))
        .when(kind == 3, F.lit(" Itu "))
        .otherwise(F.lit("Limeira Campinas, SP"))
    )
    cities = [city for city, _ in tables.PLACES] + ["Limeira"]
    return gold.normalize_location(base(spark, folder).select(*KEY, place.alias("localizacao")), cities)


@query("q_changed_rows", with_tables(BASE_SQL, """
SELECT CAST(count(*) FILTER (cls % 4 <> 3) AS BIGINT) AS changed FROM base"""))
def q_changed_rows(spark, folder):
    place = F.col("localizacao")
    return quality.changed_rows(_decorated(spark, folder), place, gold.strip_junk(place))


@query("q_fix_model", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE cls % 4 WHEN 2 THEN marca ELSE nome END AS modelo FROM base"""))
def q_fix_model(spark, folder):
    kind = F.col("cls") % 4
    model = (
        F.when(kind == 0, F.concat_ws(" ", F.upper("marca"), "nome"))
        .when(kind == 1, F.concat_ws(" ", "marca", F.lower("marca"), "nome"))
        .when(kind == 2, F.col("marca")).otherwise(F.concat(F.lit(" "), "nome"))
    )
    return base(spark, folder).select(*KEY, gold.fix_model(model, F.col("marca")).alias("modelo"))


@query("q_fix_version", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CASE cls % 3 WHEN 1 THEN nome ELSE versao END AS versao FROM base"""))
def q_fix_version(spark, folder):
    kind = F.col("cls") % 3
    version = (
        F.when(kind == 0, F.concat(F.upper("nome"), F.lit(" - • "), "versao"))
        .when(kind == 1, F.col("nome")).otherwise(F.col("versao"))
    )
    return base(spark, folder).select(*KEY, gold.fix_version(version, F.col("nome")).alias("versao"))


@query("q_tier_label", with_tables(LISTINGS_SQL, f"SELECT {KEYS}, {sql_price_label()} AS faixa_preco FROM listings"))
def q_tier_label(spark, folder):
    plain = tier(F.col("preco"), lookups.PRICE_EDGES, lookups.PRICE_LABELS)
    once = gold.tier_label(plain)
    return listings(spark, folder).select(*KEY, gold.tier_label(once).alias("faixa_preco"))


@query("q_clean_text", "SELECT doc_id, trim(regexp_replace(text, '[ \n]+', ' ', 'g')) AS text FROM documents")
def q_clean_text(spark, folder):
    docs = tables.table(spark, folder, "documents")
    bulleted = F.replace(F.col("text"), F.lit("\n"), F.lit(" •\n • "))
    return docs.select("doc_id", gold.clean_text(bulleted).alias("text"))


@query("q_required_fields", with_tables(SILVER_SQL, f"""
SELECT {KEYS}, marca, modelo, preco FROM silver WHERE marca IS NOT NULL AND marca <> ''
AND modelo <> '' AND preco IS NOT NULL"""))
def q_required_fields(spark, folder):
    return gold.required_fields(silver_rows(spark, folder)).select(*KEY, "marca", "modelo", "preco")


@query("q_audit_columns", with_tables(BASE_SQL, f"""
SELECT {KEYS}, CAST(12.35 AS DOUBLE) AS execucao_tempo_seg, CAST(NULL AS DOUBLE) AS execucao_memoria_mb,
       '01/01/2026 00:00:00' AS execucao_data_hora FROM base"""))
def q_audit_columns(spark, folder):
    return runlog.with_audit(base(spark, folder).select(*KEY), 12.3456, None, AS_OF)


# ------------------------------------------------------------------------ number formats
@query("q_format_currency", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, coalesce('R$ ' || {MONEY_SQL}, 'N/A') AS preco FROM listings"""))
def q_format_currency(spark, folder):
    return listings(spark, folder).select(*KEY, format_currency(F.col("preco")).alias("preco"))


@query("q_format_number", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, coalesce(format('{{:,}}', km), 'N/A') AS km,
       coalesce(format('{{:,.2f}}', preco), 'N/A') AS preco FROM listings"""))
def q_format_number(spark, folder):
    return listings(spark, folder).select(
        *KEY, format_count(F.col("km")).alias("km"), format_count(F.col("preco"), 2).alias("preco")
    )
