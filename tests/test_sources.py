from __future__ import annotations

from datetime import datetime

from conftest import AS_OF
from test_silver import ONIX, ARGO

from vitrine.operators import geo, gold, quality, silver
from vitrine.plans import refine
from vitrine.schemas import GAZETTEER, GEO_CACHE, GOLD, SILVER
from vitrine.sources import layers, pages
from vitrine.streaming import ingest


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_csv_round_trip(cards, spark, tmp_path):
    odd = ['Lada "Niva", azul', "1.0", "2020/2021 • 1 KM • Cotia, SP", "R$ 10"]
    built = silver.build(cards([ONIX, ARGO, odd]), AS_OF)
    layers.write_csv(built, str(tmp_path / "s"))
    again = layers.read_layer(spark, str(tmp_path / "s"), SILVER)
    blank = lambda rows: [tuple(None if v == "" else v for v in r) for r in rows]
    assert sorted(blank(rows_of(again)), key=str) == sorted(blank(rows_of(built)), key=str)


def test_csv_strings(spark, tmp_path):
    layers.write_csv(spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double"), str(tmp_path / "x"))
    out = layers.read_strings(spark, str(tmp_path / "x"))
    assert [k for _, k in out.dtypes] == ["string"] * 3 and rows_of(out) == [("1", "", "2.5")]


def test_snapshots_keep_earlier_runs(spark, tmp_path):
    root = str(tmp_path)
    layers.append_snapshot(spark.range(3), root, "gold", datetime(2026, 1, 1))
    layers.append_snapshot(spark.range(5), root, "gold", datetime(2026, 1, 2))
    assert layers.snapshots(spark, root, "gold").count() == 8
    newest = layers.latest_snapshot(spark, root, "gold")
    assert newest.count() == 5 and newest.first().run_ts == "20260102_000000"
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_ts" in plan
    for n in (2, 4):
        layers.replace_latest(spark.range(n), f"{root}/final")
        assert layers.read_latest(spark, f"{root}/final").count() == n


PAGE = """<html><a href='x'> <card class="k"><h2>Fiat Uno</h2><p>1.0</p><p>2018/2019 &bull; 1 KM</p>
<button>reservar ONLINE</button></card></a><a><card><div>VW <b>Gol</b></div><br/>1.6 &amp; 1.8</card></a>
<card><p>solto</p></card><a>nada</a></html>"""


def test_cards_from_pages(spark):
    df = spark.createDataFrame([(1, "a", PAGE), (2, "b", "<html></html>"), (3, "b", None)], "page_id int, source string, html string")
    rows = {(r.page_id, r.card): r.lines for r in pages.cards_from_pages(df).collect()}
    assert rows == {
        (1, 0): ["Fiat Uno", "1.0", "2018/2019 &bull; 1 KM", "reservar ONLINE", "COMPRA_ONLINE: Sim"],
        (1, 1): ["VW Gol", "1.6 & 1.8", "COMPRA_ONLINE: Não"],
    }
    checked = {r.source: (r.cards, r.ok) for r in quality.structure_check(df).collect()}
    assert checked["a"] == (2, True) and checked["b"][1] is False


def test_whole_run(cards, spark, tmp_path):
    batch = cards([ONIX, ARGO, ["curto"]])
    cache = spark.createDataFrame([("Curitiba, PR", -23.5, -46.6, "Curitiba, PR")], GEO_CACHE)
    run = refine.refine(batch, AS_OF, cache, seconds=3.0)
    refine.save(run, str(tmp_path), datetime(2026, 1, 1, 12))
    final = layers.read_latest(spark, f"{tmp_path}/gold_final")
    assert final.columns == GOLD.fieldNames() and final.count() == 2
    known = {r.localizacao: r.latitude for r in final.collect()}
    assert known == {"Curitiba, PR": -23.5, "Recife, PE": None}
    assert [r.location for r in run.pending.collect()] == ["Recife, PE"]
    assert layers.latest_snapshot(spark, str(tmp_path), "bronze").count() == 3
    assert layers.latest_snapshot(spark, str(tmp_path), "silver").count() == 2


def test_a_run_keeps_its_places_and_repeats(cards, spark, tmp_path):
    gazetteer = spark.createDataFrame([
        ("Curitiba", -23.5, -46.6, "Curitiba", None, None, None, None, None, None),
        ("Recife", -22.9, -43.2, "Recife", None, None, None, None, None, None)], GAZETTEER)
    root, first, second = str(tmp_path), datetime(2026, 1, 1), datetime(2026, 1, 2)
    out = refine.complete(cards([ONIX, ["curto"]]), root, first, AS_OF, gazetteer).collect()[0]
    assert (out.total_registros, out.com_coordenadas, out.locais_novos, out.primeiros_locais_novos) == (1, 1, 1, ["Curitiba, PR"])
    for _ in range(2):
        out = refine.complete(cards([ONIX, ARGO]), root, second, AS_OF, gazetteer).collect()[0]
        assert (out.total_registros, out.com_coordenadas, out.locais_novos, out.primeiros_locais_novos) == (2, 2, 1, ["Recife, PE"])
        assert out.sla_atendido is True
        assert [layers.snapshot(spark, root, n, "20260102_000000").count() for n in ("bronze", "silver", "gold", "geo_cache")] == [2, 2, 2, 2]
        assert layers.snapshots(spark, root, "gold").count() == 3
    final = layers.read_latest(spark, f"{root}/gold_final")
    assert geo.pending(final, layers.latest_snapshot(spark, root, "geo_cache")).count() == 0


def test_the_same_snapshot_twice_and_the_newest_without_a_scan(spark, tmp_path):
    root = str(tmp_path)
    for day, n in ((1, 4), (2, 5), (2, 3)):
        layers.append_snapshot(spark.range(n), root, "x", datetime(2026, 1, day))
    assert layers.runs(spark, root, "x") == ["20260101_000000", "20260102_000000"] and layers.runs(spark, root, "none") == []
    assert layers.snapshots(spark, root, "x").count() == 7
    newest = layers.latest_snapshot(spark, root, "x")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert newest.count() == 3 and "max(run_ts" not in plan and "20260102_000000" in plan


def test_a_source_of_null_pages_is_flagged(spark):
    df = spark.createDataFrame([("n", None)], "source string, html string")
    assert [tuple(r) for r in quality.structure_check(df).collect()] == [("n", 0, False)]


def test_stream_equals_batch(cards, spark, tmp_path):
    inbox, out, marks = (str(tmp_path / name) for name in ("in", "out", "marks"))
    cards([ONIX]).write.mode("append").parquet(inbox)
    stream = lambda: ingest.start(ingest.refine(ingest.arriving_cards(spark, inbox), AS_OF), out, marks)
    stream().awaitTermination(120)
    cards([ARGO]).write.mode("append").parquet(inbox)
    stream().awaitTermination(120)
    wanted = gold.build(silver.build(spark.read.parquet(inbox), AS_OF))
    assert rows_of(spark.read.schema(GOLD).parquet(out)) == rows_of(wanted)
