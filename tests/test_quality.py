from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import profile, quality, report

GOOD = [
    ["Jeep Renegade", "2.0", "2016/2017 • 91000 KM • MG", "R$ 58000", "Revisado"],
    ["Honda Fit", "1.5", "2014/2015 • 77000 KM • BA", "R$ 49000", "Único dono"],
]


def test_good_batch(cards):
    row = quality.validate_cards(cards(GOOD)).collect()[0]
    assert (row.valid, row.pass_rate, row.total_cards, row.valid_cards, row.errors) == (True, 1.0, 2, 2, [])


def test_bad_batch(cards):
    row = quality.validate_cards(cards([["Jeep"], ["Honda Fit", "1.5", "ano a combinar"], []])).collect()[0]
    assert row.valid is False and row.pass_rate < 0.5
    assert row.errors == [
        "Card 0: muito curto (1 elementos)", "Card 1: dados básicos ausentes",
        "Card 2: muito curto (0 elementos)",
    ]


def test_verdict_order_and_message_limit(cards):
    bad = [["a", "b", "sem ano", "R$ 1"]] * 30
    row = quality.validate_cards(cards(bad + [None])).collect()[0]
    assert len(row.errors) == 10 and row.total_cards == 31
    assert row.errors[0] == "Card 0: padrão de ano inválido em 'sem ano'"
    verdicts = quality.card_verdicts(cards([None])).collect()
    assert verdicts[0].verdict == "não é uma lista"


def test_empty_batch(cards):
    row = quality.validate_cards(cards([])).collect()[0]
    assert (row.valid, row.pass_rate, row.errors) == (False, 0.0, ["Lista vazia"])


def listing_frame(spark, rows):
    return spark.createDataFrame(
        rows, "id long, marca string, modelo string, versao string, ano_fabricacao int, km long, "
        "preco double, localizacao string, data_coleta string"
    )


ROWS = [
    (1, "Fiat", "Uno", None, 2018, 10, 10.0, "Itu", "d1"), (2, "Fiat", "Uno", None, 2018, None, 30.0, None, "d2"),
    (3, "VW", "Uno", None, 2018, 30, None, "Itu", "d3"), (4, None, "Gol", "1", None, 40, 20.0, "Cotia", "d4"),
]


def test_report_counts_nulls_as_equal_duplicates(spark):
    row = quality.report(listing_frame(spark, ROWS)).collect()[0]
    assert (row.total_registros, row.registros_com_preco, row.marcas_unicas, row.duplicatas) == (4, 3, 2, 2)
    assert (row.perc_preco, row.perc_ano) == (75.0, 75.0)
    assert quality.duplicates(listing_frame(spark, ROWS)).collect()[0].duplicatas == 2


def test_empty_report(spark):
    row = quality.report(listing_frame(spark, [])).collect()[0]
    assert (row.total_registros, row.perc_preco, row.duplicatas) == (0, 0.0, 0)
    assert quality.sla(quality.report(listing_frame(spark, []))).collect()[0].met is False


def test_changed_rows_and_new_values_treat_null_as_a_value(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, None), (None, "x")], "x string, y string")
    assert quality.changed_rows(df, F.col("x"), F.col("y")).collect()[0].changed == 2
    known = spark.createDataFrame([("a",), (None,)], "localizacao string")
    seen = df.select(F.col("y").alias("localizacao"))
    assert sorted(r[0] for r in quality.new_values(seen, known).collect()) == ["b", "x"]


def test_column_profile(spark):
    df = listing_frame(spark, ROWS)
    for approximate in (False, True):
        rows = {r.coluna: r for r in profile.columns(df, approximate=approximate).collect()}
        assert (rows["marca"].valores_unicos, rows["marca"].valores_nulos, rows["marca"].exemplo) == (2, 1, "Fiat")
        assert (rows["versao"].valores_nulos, rows["versao"].exemplo) == (3, "1")
        assert rows["km"].tipo == "bigint" and rows["preco"].exemplo == "10.0"


def test_profile_document(spark, tmp_path):
    profile.write_json(profile.document(listing_frame(spark, ROWS), "Listings", "loja"), str(tmp_path / "p"))
    row = spark.read.json(str(tmp_path / "p")).collect()[0]
    assert row.dataset_info.total_registros == 4 and row.dataset_info.data_coleta == "d1"
    assert row.colunas.marca.valores_unicos == 2
    assert row.estatisticas.numeros.preco.mediana == 20.0
    assert row.estatisticas.marcas.Fiat == 2 and len(row.insights_recomendados) == 5


def test_histogram_of_a_constant_and_of_nothing(spark):
    same = spark.createDataFrame([(5.0,)] * 3, "preco double")
    assert [r.n for r in report.histogram(same, bins=4).orderBy("bin").collect()] == [3, 0, 0, 0]
    none = spark.createDataFrame([], "preco double")
    assert [r.n for r in report.histogram(none, bins=2).collect()] == [0, 0]


def test_profile_in_files(spark, tmp_path):
    rows = listing_frame(spark, ROWS)
    profile.write_profile(rows, str(tmp_path), "Listings", "loja")
    nested = spark.read.json(str(tmp_path / "profile")).first()
    assert nested.dataset_info.total_registros == len(ROWS) and "marcas" not in nested.estatisticas.asDict()
    brands = {r.marca: r.n for r in spark.read.json(str(tmp_path / "marcas")).collect()}
    assert brands == {r.marca: r.n for r in profile.value_counts(rows).collect()}


def test_profile_deals_out_numbers(spark):
    """Integers and doubles stand for themselves or 64 bits; nulls, both zeros and equal numbers of other columns keep apart."""
    rows = [(1, 1, 0.0, "a", None), (2, 1, -0.0, "", None), (3, None, 0.5, None, None), (4, 2, None, "a", None)]
    df = spark.createDataFrame(rows, "id long, n int, x double, t string, none string")
    found = profile.columns(df)
    got = {r.coluna: (r.tipo, r.valores_unicos, r.valores_nulos, r.exemplo) for r in found.collect()}
    assert got == {"id": ("bigint", 4, 0, "1"), "n": ("int", 2, 1, "1"), "x": ("double", 3, 1, "0.0"),
                   "t": ("string", 2, 1, "a"), "none": ("string", 0, 4, None)}
    numbers = profile.columns(df.select("id", "n", "x"))
    assert "reverse(" not in numbers._jdf.queryExecution().optimizedPlan().toString()
