from __future__ import annotations

import math

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.functions.numbers import format_count, format_currency, money, tier
from vitrine.operators import bronze, silver
from vitrine.schemas import BRONZE_TEXT_COLUMNS, SILVER

ONIX = [
    "Chevrolet Onix Joy", "1.0 Flex", "2017/2018 • 64.310 KM • Curitiba, PR", "R$ 51.900",
    "Parcelas de R$ 1.350 por mês", "COMPRA_ONLINE: Sim",
]
ARGO = [
    "Fiat Argo Drive", "1.3 Firefly", "2021/2021 • 38.420 KM • Recife, PE", "R$ 69.500",
    "Financiamento em 36 meses",
]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_whole_card(cards):
    row = one(silver.build(cards([ONIX]), AS_OF))
    assert (row.marca, row.ano_fabricacao, row.ano_modelo, row.km) == ("Chevrolet", 2017, 2018, 64310)
    assert (row.localizacao, row.preco_bruto, row.preco) == ("Curitiba, PR", "R$ 51.900", 51900.0)
    assert row.condicoes == "Parcelas de R$ 1.350 por mês"
    assert row.compra_online == "Sim"
    assert (row.faixa_preco, row.faixa_km, row.idade_veiculo) == ("50k-80k", "60k-100k km", 9)
    assert math.isclose(row.preco_por_km, 51900 / 64310)
    assert row.texto_completo == " ".join(ONIX)


def test_layer_has_its_schema(cards):
    built = silver.build(cards([ONIX, ARGO]), AS_OF)
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in SILVER]
    assert sorted(r.id for r in built.collect()) == [1, 2]


def test_short_and_blank_cards_are_dropped_and_ids_keep_gaps(cards):
    batch = [["incompleto"], ONIX, ["   ", "1.0", "x"], ["", "1.0", "2020/2021"], ARGO, []]
    rows = {r.id: r for r in silver.build(cards(batch), AS_OF).collect()}
    assert sorted(rows) == [2, 4, 5]
    assert rows[4].marca is None and rows[4].modelo == ""


@pytest.mark.parametrize("title, wanted", [
    ("Ferrari F8", "Ferrari"), ("BMW X3", "BMW"), ("volkswagen gol", "Volkswagen"),
    ("Mercedes-Benz C180", "Mercedes-Benz"), ("Mercedes C180", "Mercedes"),
    ("CAOA CHERY Tiggo", "Caoa Chery"), ("Lada Niva", "Lada"), ("", None),
])
def test_brand(spark, title, wanted):
    df = spark.createDataFrame([(title,)], "t string")
    assert one(df.select(silver.brand(F.col("t")).alias("b"))).b == wanted


@pytest.mark.parametrize("text, wanted", [
    ("64.310 KM • São Paulo", 64310), ("0 KM • Cotia", 0), ("500 KM", 500),
    ("1.064.310 KM", 1064310), ("64310KM", 64310), ("45 km", None), ("sem km", None),
])
def test_mileage(spark, text, wanted):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df.select(silver.km(F.col("t")).alias("k"))).k == wanted


@pytest.mark.parametrize("line, wanted", [
    ("• São Paulo, SP", "São Paulo, SP"), ("2020/2021 • 64.310 KM • São Paulo, SP", "São Paulo, SP"),
    ("2020/2021 • 0 KM • Cotia", "Cotia"), ("2020/2021 • 64.310 KM", None), ("nada", None),
    ("• Cotia ,SP", "Cotia, SP"),
])
def test_location(spark, line, wanted):
    df = spark.createDataFrame([([line],)], "lines array<string>")
    assert one(df.select(silver.location_raw(F.col("lines")).alias("p"))).p == wanted


def test_location_comes_from_the_first_line_that_has_one(cards):
    card = ["Fiat Uno", "1.0", "2018/2019 • 45.000 KM", "• Itu, SP", "• Cotia, SP"]
    assert one(silver.build(cards([card]), AS_OF)).localizacao == "Itu, SP"


def test_instalment_is_not_the_price(cards):
    card = [*ONIX[:3], "Consulte", "Entrada de R$ 829"]
    row = one(silver.build(cards([card]), AS_OF))
    assert row.preco_bruto == "" and row.preco is None and row.faixa_preco is None


@pytest.mark.parametrize("text, wanted", [
    ("R$ 1.234,56", 1234.56), ("R$45.000", 45000.0), ("", None), ("Consulte", None),
    ("R$ 829 à vista", 829.0), (None, None),
])
def test_money(spark, text, wanted):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df.select(money(F.col("t")).alias("m"))).m == wanted


def test_tier_edges(spark):
    values = [-1.0, 0.0, 30000.0, 30000.01, 120000.0, 120000.01, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    closed = tier(F.col("v"), lookups.PRICE_EDGES, lookups.PRICE_LABELS)
    opened = tier(F.col("v"), lookups.PRICE_EDGES, lookups.PRICE_LABELS, include_lowest=False)
    rows = df.select("i", closed.alias("c"), opened.alias("o")).orderBy("i").collect()
    assert [r.c for r in rows] == [None, "Até 30k", "Até 30k", "30k-50k", "80k-120k", "120k+", None, None]
    assert [r.o for r in rows][:3] == [None, None, "Até 30k"]


def test_dirty_rows_are_cleaned(spark):
    df = spark.createDataFrame(
        [("R$ 47.500", "64.310", "2020", "64.310 KM • São Paulo, SP"), ("R$ 32.900", "x", "n/d", "0 KM • Cotia")],
        "preco_bruto string, km string, ano_fabricacao string, localizacao string",
    )
    first, second = silver.clean(df).collect()
    assert (first.preco, first.km, first.ano_fabricacao, first.localizacao) == (47500.0, 64310, 2020, "São Paulo, SP")
    assert (second.km, second.ano_fabricacao, second.localizacao) == (None, None, "Cotia")


def test_derived_columns(spark):
    df = spark.createDataFrame(
        [(47500, 64310, 2020), (33000, 41000, 2018), (1, 0, 2018), (1, None, None)],
        "preco int, km int, ano_fabricacao int",
    )
    rows = silver.derive(df, AS_OF).collect()
    assert [r.faixa_preco for r in rows[:2]] == ["30k-50k", "30k-50k"]
    assert [r.faixa_km for r in rows[:3]] == ["60k-100k km", "30k-60k km", "Até 30k km"]
    assert [round(r.preco_por_km, 4) for r in rows[:2]] == [0.7386, 0.8049]
    assert rows[2].preco_por_km is None and rows[3].idade_veiculo is None


def test_bronze_pads_and_cuts(cards):
    long = [str(i) for i in range(14)]
    rows = bronze.from_cards(cards([ONIX, long, ["só"]]), AS_OF).orderBy("id").collect()
    assert [rows[0][c] for c in BRONZE_TEXT_COLUMNS] == [*ONIX, "", "", "", ""]
    assert [rows[1][c] for c in BRONZE_TEXT_COLUMNS] == long[:10]
    assert rows[2].versao == "" and rows[2].data_coleta == AS_OF


def test_legacy_layout(cards):
    card = ["Fiat Uno", "1.0", "Ano/Modelo 2018/2019 • 45.000 KM • Itu, SP", "R$ 0", "Entrada"]
    row = one(silver.parse_legacy(cards([card, card[:3]]), AS_OF))
    assert (row.marca, row.ano_fabricacao, row.ano_modelo, row.km) == ("Fiat", 2018, 2019, 45000)
    assert (row.preco, row.faixa_preco, row.faixa_km, row.idade_veiculo) == (0.0, None, "30k-60k km", 8)
    assert row.texto_completo == "\n".join(card)


def test_split_address(spark):
    texts = [
        "Gol\n2020/2021 • 64.310 KM • São Paulo Vila Carrão, SP\nR$ 1", "Gol\n2020/2021 • 1 KM • Cotia, SP\nx",
        "Gol\n2020/2021 • 1 KM • Cotia\nx", "curto", "Gol\nsem lugar\nx",
    ]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "i int, texto_completo string, preco double")
    rows = silver.split_address(df, AS_OF).orderBy("i").collect()
    assert [(r.cidade, r.bairro, r.estado) for r in rows] == [
        ("São Paulo", "Vila Carrão", "SP"), ("Cotia", "", "SP"), ("Cotia", "", ""),
        (None, None, None), ("", "", ""),
    ]
    assert (rows[0].ano_fabricacao, rows[0].km, rows[3].km) == (2020, 64310, None)


def test_number_texts(spark):
    df = spark.createDataFrame([(1234.5,), (None,), (float("nan"),)], "v double")
    rows = df.select(format_currency(F.col("v")).alias("c"), format_count(F.col("v"), 1).alias("n")).collect()
    assert [(r.c, r.n) for r in rows] == [("R$ 1.234,50", "1,234.5"), ("N/A", "N/A"), ("N/A", "N/A")]


def test_result_does_not_depend_on_partitioning(cards):
    batch = [ONIX, ARGO, ["", "1.0", "2020/2021"], ["Lada", "x", "sem ano", "R$ 9"]] * 25
    wanted = sorted(map(tuple, silver.build(cards(batch), AS_OF).collect()), key=str)
    for n in (1, 7, 64):
        again = silver.build(cards(batch).repartition(n), AS_OF).collect()
        assert sorted(map(tuple, again), key=str) == wanted
