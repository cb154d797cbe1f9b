from __future__ import annotations

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.operators import gold, silver
from vitrine.plans.catalog.registry import silver_rows
from vitrine.schemas import GOLD


def value(spark, text, expression):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(expression(F.col("x")).alias("y")).collect()[0].y


@pytest.mark.parametrize("text, wanted", [
    ("BAIXO KM Cotia, SP", "Cotia, SP"), ("• Cotia, SP - ", "Cotia, SP"),
    ("Cotia IPVA 2026 PAGO, SP", "Cotia , SP"), ("único dono Itu", "Itu"), ("licenciado", ""),
])
def test_junk(spark, text, wanted):
    assert value(spark, text, gold.strip_junk) == wanted


def test_site_name_is_junk_when_given(spark):
    assert value(spark, "ACME Carros Cotia, SP", lambda x: gold.strip_junk(x, ["ACME Carros"])) == "Cotia, SP"


@pytest.mark.parametrize("text, wanted", [
    ("Auto Shopping Portal, MG", "Contagem, MG"), ("loja AUTO SHOPPING NATAL box 2", "Natal, RN"),
    ("Auto Shopping Shopping Car", "Rio de Janeiro, RJ"), ("Loja", None), (None, None),
])
def test_dealers(spark, text, wanted):
    assert value(spark, text, gold.dealer_lookup) == wanted


def places(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, localizacao string")
    return [r.localizacao for r in gold.normalize_location(df, **options).orderBy("i").collect()]


def test_normalized_places(spark):
    texts = [
        "são paulo Butantã, sp", "Cotia, xSP", "Auto Shopping Itu Rua A, SP", " Cotia ", "", None,
        "São José do Rio Preto, SP", "São Paulo Vila Campo Grande, SP", "centro de Campinas, SP",
    ]
    assert places(spark, texts) == [
        "São Paulo, SP", "Cotia, SP", "Itu, SP", "Cotia", "", None,
        "São José do Rio Preto, SP", "São Paulo, SP", "Campinas, SP",
    ]


def test_strict_order_takes_the_first_listed_city(spark):
    texts = ["São José do Rio Preto, SP", "Vitória da Conquista, BA", "Aparecida de Goiânia, GO"]
    assert places(spark, texts, strict_order=True) == ["São José, SP", "Vitória, BA", "Goiânia, GO"]


def test_location_from_text(spark):
    rows = [
        ("2020 82.817 KM • São Paulo, SP R$ 1", "x"), ("BAIXO KM 10 KM • Cotia, sp R$ 1", "x"),
        ("10 KM Auto Shopping Portal, MG R$ 1", "x"), ("nada", "Itu, SP"), ("nada", "None"),
        ("nada", None), (None, "Itu, SP"), ("10 KM São José do Rio Preto Centro, SP R$ 9", "x"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, texto_completo string, localizacao string")
    out = [r.localizacao for r in gold.location_from_text(df).orderBy("i").collect()]
    assert out == [
        "São Paulo, SP", "Cotia, SP", "Contagem, MG", "Itu, SP", "None", None, "Itu, SP",
        "São José do Rio Preto, SP",
    ]


def test_model_and_version(spark):
    df = spark.createDataFrame(
        [("Fiat", "FIAT Fiat Uno", "Uno - 1.0"), ("Fiat", "Fiat", "1.0"), ("Fiat", None, None), (None, "Uno", "uno")],
        "b string, m string, v string",
    )
    fixed = df.select(gold.fix_model(F.col("m"), F.col("b")).alias("m"), "v").select(
        "m", gold.fix_version(F.col("v"), F.col("m")).alias("v")
    )
    # A null brand leaves the model alone.
    assert [tuple(r) for r in fixed.collect()] == [("Uno", "1.0"), ("Fiat", "1.0"), (None, None), ("Uno", "uno")]


def test_tier_labels_are_stable(spark):
    for plain in lookups.PRICE_LABELS:
        once = value(spark, plain, gold.tier_label)
        assert "R$" in once and value(spark, once, gold.tier_label) == once
    assert value(spark, "30k-50k", gold.tier_label) == "R$ 30k - R$ 50k"
    assert value(spark, "Até 30k", gold.tier_label) == "Até R$ 30k"
    assert value(spark, "120k+", gold.tier_label) == "R$ 120k+"


def test_clean_text(spark):
    assert value(spark, " a\n\n• b \t c • d ", gold.clean_text) == "a b c d"


def test_gold_conforms_and_is_idempotent(spark, folder):
    once = gold.build(silver_rows(spark, folder))
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in GOLD]
    first = sorted(map(tuple, once.collect()), key=str)
    twice = sorted(map(tuple, gold.build(once).collect()), key=str)
    assert first == twice and len(first) > 5000


def test_rows_without_required_fields_leave(cards):
    info = "2020/2021 • 1 KM • Cotia, SP"
    batch = [["Fiat Uno", "1.0", info, "R$ 10"], ["Fiat Uno", "1.0", info, "Consulte"], ["", "1.0", info, "R$ 10"]]
    assert [r.id for r in gold.build(silver.build(cards(batch), AS_OF)).collect()] == [1]


def test_tiers_partition_the_rows(spark, folder):
    rows = gold.build(silver_rows(spark, folder))
    counted = {r.faixa_preco: r["count"] for r in rows.groupBy("faixa_preco").count().collect()}
    assert None not in counted and sum(counted.values()) == rows.count()


def test_refinement_needs_no_shuffle(cards):
    plan = gold.build(silver.build(cards([["Fiat Uno", "1.0", "x"]]), AS_OF))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
