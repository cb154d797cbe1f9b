from __future__ import annotations

import random
from contextlib import contextmanager

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from vitrine.functions import dictionary
from vitrine.operators import bronze, fleet, geo, lookup, ordered, runlog
from vitrine.operators.joins import lookup_join
from vitrine.operators.ordered import ranks
from vitrine.schemas import GAZETTEER, GEO_CACHE


@contextmanager
def without_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_a_frequent_key_is_split(spark):
    """Nine rows of ten share a key; adaptive execution splits its partition, and nothing runs early."""
    left = spark.range(60_000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    right = spark.createDataFrame([("hot", 1), ("70", 2), ("x", 3)], "k string, v int")
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        with without_broadcast(spark):
            joined = lookup_join(left, right, ["k"])
            assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
            assert joined.where("v = 1").count() == 54_000 and joined.count() == 60_000
            rows = joined.selectExpr("count(payload) as n", "sum(v) as s")
            assert tuple(rows.collect()[0]) == (60_000, 54_002)
            assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("contained", [False, True])
@pytest.mark.parametrize("size", [0, 1, 40, 5_000])
def test_long_dictionary_equals_a_loop(spark, contained, size):
    draw = random.Random(size)
    word = lambda n: "".join(draw.choice("abA.+ ") for _ in range(n))
    names = [word(draw.randint(1, 12)) for _ in range(size)]
    texts = [word(draw.randint(0, 30)) for _ in range(150)]
    made = (dictionary.first_contained if contained else dictionary.first_prefix)(F.col("t"), names)
    got = {r.t: r.e for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", made.alias("e")).collect()}
    for text in texts:
        test = (lambda n: n.lower() in text.lower()) if contained else (lambda n: text.lower().startswith(n.lower()))
        wanted = next((n for n in names if test(n)), None)
        assert (got[text] or "").lower() == (wanted or "").lower() and (got[text] is None) == (wanted is None)


def test_places_held_twice_multiply_nothing(spark):
    rows = spark.createDataFrame([(1, "Itu, SP")], "id int, localizacao string")
    cache = spark.createDataFrame([("Itu, SP", 2.0, 2.0, "b"), ("Itu, SP", 1.0, 1.0, "a")], GEO_CACHE)
    assert [(r.latitude, r.localizacao) for r in geo.enrich(rows, cache).collect()] == [(1.0, "a")]


@pytest.mark.parametrize("kind", ["long", "string", "timestamp"])
def test_cap_holds_for_a_hot_source(spark, monkeypatch, kind):
    rows = spark.range(20_000).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("position") if kind == "string" else F.col("id").cast(kind).alias("position"),
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") < 30, "short").alias("source"), "id",
    ).repartition(7)
    ranked = []
    monkeypatch.setattr(bronze, "ranks", lambda df, *a: ranked.append(df.count()) or ranks(df, *a))
    kept = bronze.cap_per_source(rows, 6_000).collect()
    sources = {"hot": [i for i in range(20_000) if i % 3 < 2], "short": list(range(2, 30, 3)), None: list(range(32, 20_000, 3))}
    for source, wanted in sources.items():
        assert sorted(r.id for r in kept if r.source == source) == wanted[:6_000]
    # Little beyond what is kept is ranked.
    assert ranked[0] < len(kept) * 1.05
    assert bronze.cap_per_source(rows, 0).count() == 0


def test_cap_with_absent_and_repeated_places(spark):
    rows = [(None, "a", 0), (float("nan"), "a", 1), (-1.0, "a", 2), (-1.0, "a", 3), (5.0, "a", 4), (0.0, "a", 5)]
    df = spark.createDataFrame(rows, "position double, source string, id int")
    for limit, wanted in ((1, [0]), (3, [0, 2, 3]), (4, [0, 2, 3, 5]), (5, [0, 2, 3, 4, 5]), (9, [0, 1, 2, 3, 4, 5])):
        assert sorted(r.id for r in bronze.cap_per_source(df, limit).collect()) == wanted
    assert bronze.cap_per_source(df.limit(0), 3).count() == 0
    by_two = bronze.cap_per_source(spark.range(100).selectExpr("id div 50 as p", "id % 50 as q", "'s' as source"), 60, ("p", "q"))
    assert sorted((r.p, r.q) for r in by_two.collect()) == [(0, q) for q in range(50)] + [(1, q) for q in range(10)]


def test_cap_overall_and_union(spark):
    rows = spark.range(100).select(F.col("id").alias("position"), "id").repartition(5)
    assert sorted(r.id for r in bronze.cap_overall(rows, 7).collect()) == list(range(7))
    assert bronze.union_sources([rows, rows.select("id")]).count() == 200


@pytest.mark.parametrize("contained", [False, True])
def test_lookup_equals_brute_force(spark, contained):
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abA") for _ in range(n))
    names = [(word(draw.randint(1, 4)), i) for i in range(25)]
    texts = [word(draw.randint(0, 9)) for _ in range(200)]
    found = lookup.first_match(
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(999, None)], "i int, t string"), "t",
        spark.createDataFrame(names, "name string, priority int"), contained,
    )
    got = {r.i: r.entry for r in found.collect()}
    assert len(got) == 201 and got[999] is None
    for i, text in enumerate(texts):
        test = (lambda n: n.lower() in text.lower()) if contained else (lambda n: text.lower().startswith(n.lower()))
        wanted = next(((p, n) for n, p in names if test(n)), None)
        assert (None if got[i] is None else (got[i].priority, got[i].name)) == wanted


@pytest.mark.parametrize("contained", [False, True])
def test_many_names_and_long_texts(spark, contained):
    """5,000 names against texts of 10,000 characters: equal to a loop, and few names come up for a text."""
    draw = random.Random(8)
    word = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyzáé") for _ in range(n))
    names = [(word(draw.randint(2, 24)), i) for i in range(4_990)] + [("the same lead " + word(9), 5_000 + i) for i in range(10)]
    texts = []
    for _ in range(20):
        body = word(10_000)
        held = [draw.choice(names)[0].upper() for _ in range(draw.randint(0, 3))]
        texts.append("".join([*held, body[:5_000], *held[::-1], body[5_000:]]))
    texts += ["", "a", names[7][0], "the same lead " + "x" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    table = spark.createDataFrame(names, "name string, priority int")
    got = {r.i: r.entry for r in lookup.first_match(df, "t", table, contained).collect()}
    for i, text in enumerate(texts):
        test = (lambda n: n in text.lower()) if contained else (lambda n: text.lower().startswith(n))
        wanted = min(((p, n) for n, p in names if test(n)), default=None)
        assert (None if got[i] is None else (got[i].priority, got[i].name)) == wanted
    pairs = lookup.candidates(lookup._keyed(df, "t"), "t", table, contained).count()
    assert pairs < (1_200 if contained else 20) * len(texts)


def test_cache_forms(spark, tmp_path):
    assert geo.read_cache(spark, str(tmp_path / "absent.json")).count() == 0
    text = '{"Cotia, SP": {"lat": -23.6, "lon": -46.9, "normalized": "Cotia, SP"}, "Itu, SP": {"lat": 1.0, "lon": 2.0, "normalized": "Itu"}}'
    (tmp_path / "cache.json").write_text(text, encoding="utf8")
    cache = geo.read_cache(spark, str(tmp_path / "cache.json"))
    assert sorted(map(tuple, cache.collect())) == [("Cotia, SP", -23.6, -46.9, "Cotia, SP"), ("Itu, SP", 1.0, 2.0, "Itu")]
    (tmp_path / "broken.json").write_text("{not json", encoding="utf8")
    assert geo.read_cache(spark, str(tmp_path / "broken.json")).count() == 0
    for name in ("v2", "v2.jsonl"):
        geo.write_cache(cache, str(tmp_path / name))
        assert sorted(map(tuple, geo.read_cache(spark, str(tmp_path / name)).collect())) == sorted(map(tuple, cache.collect()))
    assert geo.read_cache(spark, str(tmp_path / "absent.jsonl")).count() == 0


def test_places_from_pending_to_enriched(spark):
    rows = spark.createDataFrame([(1, "Cotia, SP"), (2, "Itu, SP"), (3, " "), (4, None), (5, "Nada"), (6, "Itu, SP")], "id int, localizacao string")
    cache = spark.createDataFrame([("Cotia, SP", 1.0, 2.0, "Cotia (SP)")], GEO_CACHE)
    gazetteer = spark.createDataFrame([
        ("Itu", 3.0, 4.0, "", None, "Vila Itu", None, None, "Interior", None),
        ("Nada", 5.0, 6.0, None, None, None, None, None, None, None),
    ], GAZETTEER)
    missing = geo.pending(rows, cache)
    assert sorted(r.location for r in missing.collect()) == ["Itu, SP", "Nada"]
    resolved = geo.resolve(missing, gazetteer)
    assert sorted(map(tuple, resolved.collect())) == [("Itu, SP", 3.0, 4.0, "Vila Itu, SP"), ("Nada", 5.0, 6.0, "Nada, BR")]
    merged = geo.upsert(cache, resolved)
    placed = {r.id: r for r in geo.enrich(rows, merged).collect()}
    assert len(placed) == 6
    assert (placed[1].localizacao, placed[6].latitude, placed[4].latitude) == ("Cotia (SP)", 3.0, None)
    replaced = geo.upsert(merged, spark.createDataFrame([("Nada", 0.0, 0.0, "N")], GEO_CACHE))
    assert sorted(r.normalized for r in replaced.collect()) == ["Cotia (SP)", "N", "Vila Itu, SP"]


def test_stage_durations(spark):
    marks = spark.createDataFrame([
        ("r", 1, "bronze", "2024-01-01 00:00:10"), ("r", 2, "silver", "2024-01-01 00:00:40"),
        ("r", 3, "gold", "2024-01-03 00:00:00"), ("s", 1, "only", "2024-01-01 12:00:00"),
    ], "run string, seq long, name string, ts string").withColumn("ts", F.to_timestamp("ts"))
    runs = spark.createDataFrame([("r", "2024-01-01 00:00:00", "2024-01-03 00:01:00"), ("s", "2024-01-01 11:59:00", None)],
                                 "run string, start string, end string")
    runs = runs.select("run", F.to_timestamp("start").alias("start"), F.to_timestamp("end").alias("end"))
    out = {(r.run, r.stage): r.seconds for r in runlog.stage_durations(marks, runs).collect()}
    assert out == {
        ("r", "inicio → bronze"): 10.0, ("r", "bronze → silver"): 30.0, ("r", "silver → gold"): 172760.0,
        ("r", "gold → fim"): 60.0, ("s", "inicio → only"): 60.0,
    }


def test_one_run_with_all_checkpoints_is_spread(spark):
    """One run holds all checkpoints, many at one time: eight ranges of about equal size, and no stage lost."""
    n = 40_000
    marks = spark.range(n).select(
        F.lit("hot").alias("run"), F.col("id").alias("seq"), F.concat(F.lit("s"), F.col("id") % 7).alias("name"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 3)).alias("ts")).repartition(5)
    dealt = ordered.ranges(marks, ["run", "ts", "seq"], 8)
    sizes = [r["count"] for r in dealt.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 8
    runs = spark.createDataFrame([("hot", 1_699_999_990, 1_700_020_000)], "run string, a long, b long").select(
        "run", F.timestamp_seconds("a").alias("start"), F.timestamp_seconds("b").alias("end"))
    out = {r.seq: (r.stage, r.seconds) for r in runlog.stage_durations(marks, runs, 8).collect()}
    want = {i: (f"s{(i - 1) % 7} → s{i % 7}" if i else "inicio → s0", float(i % 3 == 0) if i else 10.0) for i in range(n)}
    want[None] = (f"s{(n - 1) % 7} → fim", float(20_000 - (n - 1) // 3))
    assert out == want


def test_ranks_of_a_vocabulary_with_one_lead(spark):
    """A million labels that begin alike: ranges stay small, the codes are those of a sort."""
    labels = spark.range(1_000_000).select(F.concat(F.lit("same prefix "), F.sha2(F.col("id").cast("string"), 256)).alias("w"))
    dealt = ordered.ranges(labels, ["w"], 16)
    sizes = [r["count"] for r in dealt.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 1_000_000 / 16
    codes = fleet.encoders(labels.limit(50_000), ["w"])["w"].collect()
    assert {r.w: r.code for r in codes} == {w: i for i, w in enumerate(sorted(r.w for r in codes))}


def test_audit(spark):
    row = runlog.with_audit(spark.range(1), 1.239, 10.0, AS_OF).collect()[0]
    assert (row.execucao_tempo_seg, row.execucao_memoria_mb, row.execucao_data_hora) == (1.24, 10.0, "01/01/2026 00:00:00")
