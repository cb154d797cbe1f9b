from __future__ import annotations

import numpy as np
import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from vitrine.operators import bins, demand, fleet, predict
from vitrine.plans.catalog.registry import listings
from vitrine.sources.tables import KEY


def counts(spark, groups):
    rows = [(g, f"2024-01-{i + 1:02d} 00:00:00", int(n)) for g, values in groups.items() for i, n in enumerate(values)]
    return spark.createDataFrame(rows, "g string, period string, n long").withColumn("period", F.to_timestamp("period"))


def test_fit_equals_least_squares(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(5, 60, 30)
    out = demand.fit(counts(spark, {"a": values}), ["g"]).collect()[0]
    scaled = (values - values.min()) / (values.max() - values.min())
    x = np.array([[1.0, *scaled[i:i + 7]] for i in range(23)])
    weights, *_ = np.linalg.lstsq(x, scaled[7:], rcond=None)
    assert np.allclose(out.weights, weights, atol=1e-8)
    assert out.loss == pytest.approx(np.mean((x @ weights - scaled[7:]) ** 2))
    nxt = demand.forecast(counts(spark, {"a": values}), ["g"]).collect()[0]
    span = values.max() - values.min()
    wanted = (weights @ [1.0, *scaled[-7:]]) * span + values.min()
    assert nxt.forecast == pytest.approx(wanted) and nxt.status == "ok"


def test_systems_are_solved_in_the_engine(spark):
    rng = np.random.default_rng(4)
    rows, want = [], []
    for k in range(30):
        x = rng.normal(size=(40, 5))
        if k % 3 == 0:
            x[:, 3] = 2 * x[:, 1]  # depends on a term before it
        y = rng.normal(size=40)
        rows.append((k, 40, np.column_stack((x.T @ x, x.T @ y)).tolist()))
        used = [0, 1, 2, 4] if k % 3 == 0 else list(range(5))
        w = np.zeros(5)
        w[used] = np.linalg.lstsq(x[:, used], y, rcond=None)[0]
        want.append(w)
    df = spark.createDataFrame(rows, "g int, rows int, m array<array<double>>")
    solved = demand.solve(df, "m", 5)
    assert "Python" not in solved._jdf.queryExecution().executedPlan().toString()
    got = {r.g: r.weights for r in solved.collect()}
    assert all(np.allclose(got[k], want[k], atol=1e-8) for k in range(30))


def test_a_kept_forecaster_predicts_the_same(spark, tmp_path):
    rng = np.random.default_rng(2)
    history = counts(spark, {"a": rng.integers(5, 60, 30), "b": rng.integers(5, 60, 25)})
    model = demand.fit(history, ["g"])
    for _ in range(2):
        demand.save(model, str(tmp_path / "m"))
    again = demand.load(spark, str(tmp_path / "m"))
    one, two = (sorted(map(tuple, demand.predict_next(history, m, ["g"]).collect())) for m in (model, again))
    assert one == two and len(one) == 2


def test_short_constant_and_single_series(spark):
    out = {r.g: r for r in demand.forecast(
        counts(spark, {"short": range(7), "flat": [4] * 20, "one": [3], "line": range(1, 21)}), ["g"]
    ).collect()}
    assert (out["short"].status, out["short"].forecast) == ("insufficient_history", None)
    assert out["one"].status == "insufficient_history"
    assert out["flat"].forecast == pytest.approx(4.0)
    assert out["line"].forecast == pytest.approx(21.0)


def test_forecast_without_groups(spark):
    whole = counts(spark, {"a": range(1, 21)}).drop("g")
    row = demand.forecast(whole).collect()[0]
    assert row.forecast == pytest.approx(21.0)


def test_series_drops_bad_times(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01 11:00:00",), ("lixo",), (None,)], "data_coleta string")
    assert [(str(r.period), r.n) for r in demand.series(df).collect()] == [("2024-01-01 00:00:00", 2)]


def test_encoder_is_alphabetical_and_unknown_is_minus_one(spark):
    words = ["b", "a", "abcz", "abca", "c", None, "B", "ábc"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    codes = fleet.encoders(df, ["w"])["w"]
    known = sorted({w for w in words if w is not None})
    assert {r.w: r.code for r in codes.collect()} == {w: i for i, w in enumerate(known)}
    fresh = spark.createDataFrame([("a",), ("zz",), (None,)], "w string")
    assert [r.c for r in fleet.encode(fresh, "w", codes, "c").collect()] == [known.index("a"), -1, -1]


def test_split_repeats_under_any_partitioning(spark):
    df = spark.range(10000)
    learn, test = fleet.split(df, ["id"])
    again = fleet.split(df.repartition(13), ["id"])[1]
    assert learn.count() + test.count() == 10000
    assert {r.id for r in test.collect()} == {r.id for r in again.collect()}
    assert 0.17 < test.count() / 10000 < 0.23


def test_reload_without_the_year(spark, folder, tmp_path):
    rows = listings(spark, folder)
    model, _ = fleet.train(rows, KEY, rounds=3, with_year=False)
    model.save(str(tmp_path / "m"))
    loaded = fleet.FleetModel.load(spark, str(tmp_path / "m"))
    assert loaded.numbers == model.numbers == ("km", "preco")
    both = loaded.score(model.score(rows, "a"), "b")
    assert both.where("a <> b").count() == 0


def test_train_save_load_score(spark, folder, tmp_path):
    rows = listings(spark, folder)
    model, metrics = fleet.train(rows, KEY, rounds=8)
    result = metrics.collect()[0]
    assert result.n > 500 and result.r2 > 0.9 and result.mae < 1.0
    model.save(str(tmp_path / "m"))
    loaded = fleet.FleetModel.load(spark, str(tmp_path / "m"))
    fresh = rows.limit(50).withColumn("modelo", F.lit("nunca visto"))
    a = [r.p for r in model.score(fresh, "p").orderBy(*KEY).collect()]
    b = [r.p for r in loaded.score(fresh, "p").orderBy(*KEY).collect()]
    assert a == b and len(a) == 50
    forecast = spark.createDataFrame([(12.0, 0.5)], "forecast double, loss double")
    out = predict.table(model.score(rows, "Aging_Predicted"), forecast, metrics, AS_OF).first()
    assert out.Predicted_Demand_Next_Period == 12.0
    assert out.Model_Metrics == f"Fleet R2: {result.r2:.2f} | Demand Loss: 0.5000"
    assert out.Fleet_Health_Score is None or out.Fleet_Health_Score >= 0


def plain_tree(x, y, depth):
    """Squares regression tree over {name: values}; None is tried on both sides of every cut, low side first."""
    total = ((y - y.mean()) ** 2).sum()
    best = (1e-9, None)
    for column in x.T:
        known = np.array([v is not None for v in column])
        values = np.array([0.0 if v is None else v for v in column])
        for absent_left in (True, False):
            cuts = sorted(set(values[known]))
            middles = [(a + b) / 2 for a, b in zip(cuts, cuts[1:])]
            if not known.all():
                middles = [-1e17, *middles] if absent_left else [*middles, 1e17]
            for cut in middles:
                left = np.where(known, values <= cut, absent_left)
                if not 0 < left.sum() < len(y):
                    continue
                gain = total - sum(((p - p.mean()) ** 2).sum() for p in (y[left], y[~left]))
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, left)
    out = np.full(len(y), y.mean())
    if depth and best[1] is not None:
        for side in (best[1], ~best[1]):
            out[side] = plain_tree(x[side], y[side], depth - 1)
    return out


def plain_boost(x, y, rounds, rate, depth):
    """Predictions for the training rows. The engine's squared loss has the slope 2 (y - p)."""
    fitted = plain_tree(x, y, depth)
    for _ in range(rounds - 1):
        fitted = fitted + rate * plain_tree(x, 2 * (y - fitted), depth)
    return fitted


def test_absent_numbers_choose_their_side(spark):
    """Equal to a plain search in which absent numbers go left or right, whichever is better, split by split."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        km, preco = int(rng.integers(0, 12)), float(rng.integers(0, 12))
        # Without mileage a car is old (high km is), without a price it is new.
        age = km + 0.37 * preco + rng.normal() * 0.1
        if i % 5 == 0:
            km, age = None, 14.0 + rng.normal() * 0.1
        if i % 7 == 0:
            preco, age = None, age - 3.3
        rows.append((i, "a", "b", None, km, preco, float(age)))
    schema = "id long, marca string, modelo string, ano_fabricacao int, km int, preco double, idade_veiculo double"
    df = spark.createDataFrame(rows, schema)
    model, _ = fleet.train(df, rounds=4, depth=3, with_year=False)
    learn, _ = fleet.split(df, ["id"])
    got = {r.id: r.p for r in model.score(learn, "p").collect()}
    used = [r for r in rows if r[0] in got]
    x = np.array([[r[4], r[5]] for r in used], dtype=object)
    want = plain_boost(x, np.array([r[6] for r in used]), 4, 0.1, 3)
    assert np.allclose([got[r[0]] for r in used], want, atol=1e-9)


def test_model_without_the_year_does_not_see_the_answer(spark, folder):
    rows = listings(spark, folder)
    _, metrics = fleet.train(rows, KEY, rounds=2, with_year=False)
    assert metrics.collect()[0].r2 < 0.5


def test_a_short_vocabulary_is_broadcast(spark):
    """Rows are not dealt out by their few labels, however many rows there are."""
    rows = spark.range(2000).select("id", F.concat(F.lit("m"), F.col("id") % 3).alias("marca"))
    coded = fleet.encode(rows, "marca", fleet.encoders(rows, ["marca"])["marca"], "code")
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert {(r.marca, r.code) for r in coded.collect()} == {("m0", 0), ("m1", 1), ("m2", 2)}


def plain_points(values, bins=32):
    """Split points of a sorted list of values, one value after the other."""
    kinds, counts = np.unique(values, return_counts=True)
    if len(kinds) <= bins:
        return [(a + b) / 2 for a, b in zip(kinds, kinds[1:])]
    share, points, below, target = len(values) / bins, [], counts[0], len(values) / bins
    for i in range(1, len(kinds)):
        before, below = below, below + counts[i]
        if abs(before - target) < abs(below - target):
            points.append((kinds[i - 1] + kinds[i]) / 2)
            target += share
    return points


def test_split_points_come_from_all_rows(spark):
    rng = np.random.default_rng(5)
    n = 6000
    columns = {
        "few": rng.integers(1990, 2020, n).astype(float), "whole": rng.integers(0, 160_000, n).astype(float),
        "price": np.round(rng.lognormal(10, 1, n), 2), "near": 1e9 + rng.integers(0, 500, n),
        "signed": rng.normal(size=n), "heavy": np.where(rng.random(n) < 0.6, 7.0, rng.normal(size=n)),
        "far": np.where(rng.random(n) < 0.01, 1e300, rng.random(n) * 1e-300), "one": np.full(n, 3.0),
    }
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], [*columns])
    gaps = frame.withColumn("price", F.when(F.col("whole") > 5000, F.col("price"))).union(
        spark.createDataFrame([(float("nan"),) * len(columns)], frame.schema))
    found = bins.split_points(gaps, [*columns])
    columns["price"] = columns["price"][columns["whole"] > 5000]
    for name, values in columns.items():
        assert found[name] == plain_points(values), name
    infinite = spark.createDataFrame([(float(x),) for x in ("-inf", 1, 2, "inf")], "v double")
    points = bins.split_points(infinite, ["v"])
    assert [r._v for r in bins.binned(infinite, points).orderBy("v").collect()] == [0, 1, 2, 3]


def test_a_bin_ends_with_its_split_point(spark):
    frame = spark.createDataFrame([(x,) for x in (1, 2, 3, None)], "v int")
    at = {r.v: r._v for r in bins.binned(frame, {"v": [1.5, 2.0]}).collect()}
    assert at == {1: 0, 2: 1, 3: 2, None: None}
    assert {r._v for r in bins.binned(frame, {"v": []}).collect()} == {0, None}


def listing_rows(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        "id", F.concat(F.lit("m"), i % 3).alias("marca"), F.lit("a").alias("modelo"), F.lit(None).cast("int").alias("ano_fabricacao"),
        F.when(i % 11 != 0, (i % 7).cast("int")).alias("km"), (i % 5).cast("double").alias("preco"),
        ((i % 7) * 2 + (i % 5) * (i % 3) + i % 2).cast("double").alias("idade_veiculo"))


def test_rounds_pass_over_cells_not_rows(spark, monkeypatch):
    """The trees get a row for each set of bins, with the number of rows, and are those of the rows themselves."""
    given, fit = [], fleet.GBTRegressor.fit
    monkeypatch.setattr(fleet.GBTRegressor, "fit", lambda self, df, *a: given.append(df) or fit(self, df, *a))
    rows = listing_rows(spark, 6000)
    model, _ = fleet.train(rows, rounds=4, depth=3)
    learn, _ = fleet.split(rows, ["id"])
    sets = learn.select("marca", "km", "preco").distinct().count()
    assert given[0].count() == sets < 200
    assert given[0].agg(F.sum("n")).first()[0] == learn.count()
    plain = fit(fleet.GBTRegressor(labelCol="idade_veiculo", maxIter=4, stepSize=0.1, maxDepth=3, seed=42),
                fleet.features(learn, model.codes))
    both = plain.transform(fleet.features(rows, model.codes)).select("id", "prediction").join(model.score(rows, "p"), "id")
    assert both.where("abs(prediction - p) > 1e-9").count() == 0


def test_trees_see_every_cell(spark):
    """One cell among more than the trees would draw."""
    i = F.col("id")
    rows = spark.range(25_000).select(
        "id", F.lit("m").alias("marca"), F.when(i % 5000 == 17, "z").otherwise("a").alias("modelo"),
        F.when(i % 5000 != 17, (i % 30).cast("int")).alias("ano_fabricacao"),
        F.when(i % 5000 != 17, F.floor(i / 30) % 30).alias("km"),
        F.when(i % 5000 != 17, (F.floor(i / 900) % 30).cast("double")).alias("preco"),
        F.when(i % 5000 == 17, 1e6).otherwise(3.0).alias("idade_veiculo"))
    model, _ = fleet.train(rows, rounds=1, depth=2)
    assert {r.p for r in model.score(rows.where("modelo = 'z'"), "p").collect()} == {1e6}


def test_a_model_kept_without_split_points_is_loaded(spark, tmp_path):
    rows = listing_rows(spark, 300)
    codes = fleet.encoders(rows)
    trees = fleet.GBTRegressor(labelCol="idade_veiculo", maxIter=2, maxDepth=2).fit(fleet.features(rows, codes))
    model = fleet.FleetModel(trees, codes)
    model.save(str(tmp_path / "m"))
    spark.read.parquet(str(tmp_path / "m" / "inputs")).drop("points").write.parquet(str(tmp_path / "inputs"))
    spark.read.parquet(str(tmp_path / "inputs")).write.mode("overwrite").parquet(str(tmp_path / "m" / "inputs"))
    assert fleet.FleetModel.load(spark, str(tmp_path / "m")).points is None
    again = fleet.FleetModel.load(spark, str(tmp_path / "m")).score(model.score(rows, "a"), "b")
    assert again.where("a <> b").count() == 0
