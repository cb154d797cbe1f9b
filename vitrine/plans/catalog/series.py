"""Demand, run log, age model and predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vitrine.operators import demand, fleet, predict, runlog
from vitrine.plans.catalog.registry import (
    AS_OF, KEYS, LISTINGS_SQL, listings, near, query, rounded, with_tables,
)
from vitrine.plans import refine
from vitrine.session import shared_folder
from vitrine.sources import tables
from vitrine.sources.tables import KEY

GROUP = ("event_type",)
_SERIES = """series AS (SELECT event_type, date_trunc('day', ts) AS period, count(*) AS n FROM events GROUP BY 1, 2)"""
_SCALED = _SERIES + """, bounds AS (SELECT *, min(n) OVER g AS low, max(n) OVER g AS high FROM series
  WINDOW g AS (PARTITION BY event_type)),
scaled AS (SELECT *, CASE WHEN high > low THEN (n - low) / (high - low)::DOUBLE ELSE 0.0::DOUBLE END AS s FROM bounds)"""


def daily(spark, folder):
    return demand.series(tables.table(spark, folder, "events"), "ts", "day", GROUP)


def _day(df):
    return df.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@query("q_demand_series", with_tables(_SERIES, "SELECT event_type, strftime(period, '%Y-%m-%d') AS period, n FROM series"))
def q_demand_series(spark, folder):
    return _day(daily(spark, folder))


@query("q_demand_guard", """
SELECT event_type, user_id, count(*) AS periods, CASE WHEN count(*) >= 8 THEN 'ok' ELSE 'insufficient_history' END AS status
FROM (SELECT DISTINCT event_type, user_id, date_trunc('day', ts) FROM events) GROUP BY event_type, user_id""")
def q_demand_guard(spark, folder):
    """Days per type and user: some histories are long enough, most are not."""
    by = ("event_type", "user_id")
    return demand.guard(demand.series(tables.table(spark, folder, "events"), "ts", "day", by), by)


@query("q_minmax", with_tables(_SCALED, """
SELECT event_type, strftime(period, '%Y-%m-%d') AS period, n, low::DOUBLE AS low, high::DOUBLE AS high,
       near(s, 6) AS scaled FROM scaled"""))
def q_minmax(spark, folder):
    return rounded(_day(demand.minmax(daily(spark, folder), GROUP)), 6, "scaled")


_LAGS = ", ".join(f"lag(s, {k}) OVER w AS lag_{k}" for k in range(7, 0, -1))
_LAGS_OUT = ", ".join(f"near(lag_{k}, 6) AS lag_{k}" for k in range(7, 0, -1))


@query("q_lag_windows", with_tables(_SCALED, f"""
SELECT event_type, strftime(period, '%Y-%m-%d') AS period, {_LAGS_OUT}, near(s, 6) AS target
FROM (SELECT *, {_LAGS} FROM scaled WINDOW w AS (PARTITION BY event_type ORDER BY period)) WHERE lag_7 IS NOT NULL"""))
def q_lag_windows(spark, folder):
    rows = demand.lag_windows(demand.minmax(daily(spark, folder), GROUP), GROUP)
    lags = [F.get("lags", F.lit(7 - k)).alias(f"lag_{k}") for k in range(7, 0, -1)]
    return rounded(_day(rows.select("event_type", "period", *lags, "target")), 6)


@query("q_demand_forecast_one_lag", with_tables(_SCALED, """
, pairs AS (SELECT event_type, period, s AS y, lag(s) OVER (PARTITION BY event_type ORDER BY period) AS x,
            low, high FROM scaled),
line AS (SELECT event_type, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs WHERE x IS NOT NULL GROUP BY 1),
loss AS (SELECT event_type, avg((y - a * x - b) ** 2) AS loss FROM pairs JOIN line USING (event_type)
         WHERE x IS NOT NULL GROUP BY 1),
last AS (SELECT event_type, max_by(y, period) AS y, any_value(low) AS low, any_value(high) AS high,
         count(*) AS periods, max(period) AS last_period FROM pairs GROUP BY 1)
SELECT event_type, periods, strftime(last_period, '%Y-%m-%d') AS last_period,
       near((a * y + b) * (high - low) + low, 4) AS forecast, near(loss, 6) AS loss, 'ok' AS status
FROM last JOIN line USING (event_type) JOIN loss USING (event_type)"""))
def q_demand_forecast_one_lag(spark, folder):
    """The forecaster with a window of one period has a closed form in SQL."""
    out = demand.forecast(daily(spark, folder), GROUP, window=1)
    out = out.withColumn("last_period", F.date_format("last_period", "yyyy-MM-dd"))
    return rounded(rounded(out, 4, "forecast"), 6, "loss")


@query("q_demand_fit_optimality", with_tables(_SERIES, """
SELECT event_type, CAST(unnest(range(8)) AS INTEGER) AS term, 0.0::DOUBLE AS gradient
FROM series GROUP BY event_type HAVING count(*) >= 8"""))
def q_demand_fit_optimality(spark, folder):
    """The fit with seven periods: the gradient of the squared error vanishes in every term."""
    counts = daily(spark, folder)
    gradient = demand.optimality(counts, demand.fit(counts, GROUP), GROUP)
    return gradient.withColumn("gradient", near(F.col("gradient"), 6) + 0.0)


_TERMS = ["1.0::DOUBLE", *[f"x{k}" for k in range(7)]]
_MATRIX = "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in [*_TERMS, "y"]) + "]" for a in _TERMS) + "]"


@query("q_demand_forecast", _SCALED.join(["WITH RECURSIVE ", f"""
, rows7 AS (SELECT event_type, period, s AS y, {', '.join(f'lag(s, {7 - k}) OVER w AS x{k}' for k in range(7))} FROM scaled
  WINDOW w AS (PARTITION BY event_type ORDER BY period)),
normal AS (SELECT event_type, count(*) AS n, sum(y * y) AS yy, {_MATRIX} AS m FROM rows7 WHERE x0 IS NOT NULL GROUP BY event_type),
steps AS (SELECT event_type, 1 AS k, m FROM normal
  UNION ALL SELECT event_type, k + 1, list_transform(m, lambda row, i: CASE WHEN i = k THEN list_transform(row, lambda x: x / row[k])
    ELSE list_transform(row, lambda x, j: x - m[k][j] * row[k] / m[k][k]) END) FROM steps WHERE k <= 8),
fitted AS (SELECT event_type, list_transform(m, lambda row: row[9]) AS w FROM steps WHERE k = 9),
loss AS (SELECT event_type, avg((y - w[1] - {' - '.join(f'w[{k + 2}] * x{k}' for k in range(7))}) ** 2) AS loss
  FROM rows7 JOIN fitted USING (event_type) WHERE x0 IS NOT NULL GROUP BY event_type),
last AS (SELECT event_type, count(*) AS periods, max(period) AS last_period, any_value(low) AS low, any_value(high) AS high,
  list(s ORDER BY period DESC)[1:7] AS recent FROM scaled GROUP BY event_type)
SELECT event_type, periods, strftime(last_period, '%Y-%m-%d') AS last_period,
       near((w[1] + {' + '.join(f'w[{k + 2}] * recent[{7 - k}]' for k in range(7))}) * (high - low) + low, 4) AS forecast,
       near(loss, 4) AS loss, 'ok' AS status FROM last JOIN fitted USING (event_type) JOIN loss USING (event_type)"""]))
def q_demand_forecast(spark, folder):
    return rounded(_named_day(demand.forecast(daily(spark, folder), GROUP)), 4)


def _named_day(df):
    return df.withColumn("last_period", F.date_format("last_period", "yyyy-MM-dd"))


@query("q_stage_durations", """
WITH marks AS (SELECT user_id AS run, event_id AS seq, event_type AS name, ts,
  lag(ts) OVER w AS before, lag(event_type) OVER w AS before_name FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
runs AS (SELECT user_id AS run, date_trunc('day', min(ts)) AS start, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS fim
  FROM events GROUP BY 1)
SELECT run, seq, coalesce(before_name, 'inicio') || ' → ' || name AS stage,
       near(date_diff('microsecond', coalesce(before, start), ts) / 1000000.0::DOUBLE, 6) AS seconds
FROM marks JOIN runs USING (run)
UNION ALL
SELECT run, NULL, max_by(event_type, (ts, event_id)) || ' → fim',
       near(date_diff('microsecond', max(ts), any_value(fim)) / 1000000.0::DOUBLE, 6)
FROM events JOIN runs ON user_id = run GROUP BY run""")
def q_stage_durations(spark, folder):
    events = tables.table(spark, folder, "events")
    marks = events.select(
        F.col("user_id").alias("run"), F.col("event_id").alias("seq"), F.col("event_type").alias("name"), "ts"
    )
    day = F.expr("interval 1 day")
    runs = marks.groupBy("run").agg(
        F.date_trunc("day", F.min("ts")).alias("start"), (F.date_trunc("day", F.max("ts")) + day).alias("end")
    )
    return rounded(runlog.stage_durations(marks, runs), 6)


# --------------------------------------------------------------------------- age model
@query("q_label_encode", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, CAST(dense_rank() OVER (ORDER BY marca) - 1 AS INTEGER) AS marca_code,
       CAST(dense_rank() OVER (ORDER BY modelo) - 1 AS INTEGER) AS modelo_code FROM listings"""))
def q_label_encode(spark, folder):
    rows = listings(spark, folder).select(*KEY, "marca", "modelo")
    codes = fleet.encoders(rows)
    out = fleet.encode(rows, "marca", codes["marca"], "marca_code")
    out = fleet.encode(out, "modelo", codes["modelo"], "modelo_code")
    return out.select(*KEY, "marca_code", "modelo_code")


@query("q_label_encode_unseen", with_tables(LISTINGS_SQL, f"""
, codes AS (SELECT modelo, dense_rank() OVER (ORDER BY modelo) - 1 AS code FROM
            (SELECT DISTINCT modelo FROM listings WHERE modelo < 'm'))
SELECT {KEYS}, CAST(coalesce(code, -1) AS INTEGER) AS modelo_code FROM listings LEFT JOIN codes USING (modelo)"""))
def q_label_encode_unseen(spark, folder):
    rows = listings(spark, folder).select(*KEY, "modelo")
    codes = fleet.encoders(rows.where(F.col("modelo") < "m"), ["modelo"])["modelo"]
    return fleet.encode(rows, "modelo", codes, "modelo_code").select(*KEY, "modelo_code")


@query("q_fleet_features", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, concat_ws('|', dense_rank() OVER (ORDER BY marca) - 1, dense_rank() OVER (ORDER BY modelo) - 1,
       {', '.join(f"CAST(round(coalesce({c}, {sign}1000000000000000000)) AS BIGINT)"
                  for c in fleet.NUMBERS for sign in ("-", ""))}) AS features FROM listings"""))
def q_fleet_features(spark, folder):
    from pyspark.ml.functions import vector_to_array

    rows = listings(spark, folder).select(*KEY, *fleet.LABELS, *fleet.NUMBERS)
    codes = fleet.encoders(rows)
    made = fleet.features(rows, codes)
    text = F.transform(vector_to_array("features"), lambda v: F.round(v).cast("bigint").cast("string"))
    return made.select(*KEY, F.array_join(text, "|").alias("features"))


def _formula(rows):
    """A stand-in for a model: age from price and mileage."""
    guess = 24.0 + F.coalesce("km", F.lit(0)) / 50000.0 + F.coalesce("preco", F.lit(0)) / 40000.0
    return rows.withColumn("prediction", guess)


_FORMULA = "24.0::DOUBLE + coalesce(km, 0) / 50000.0::DOUBLE + coalesce(preco, 0) / 40000.0::DOUBLE"


@query("q_regression_metrics", with_tables(LISTINGS_SQL, f"""
, p AS (SELECT idade_veiculo AS y, {_FORMULA} AS p FROM listings WHERE idade_veiculo IS NOT NULL)
SELECT count(*) AS n, near(avg(abs(y - p)), 6) AS mae,
       near(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM p"""))
def q_regression_metrics(spark, folder):
    return rounded(fleet.evaluate(_formula(listings(spark, folder))), 6)


@query("q_health_score", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, near(abs(idade_veiculo - ({_FORMULA})), 6) AS "Fleet_Health_Score" FROM listings"""))
def q_health_score(spark, folder):
    rows = _formula(listings(spark, folder))
    score = predict.health_score(F.col("idade_veiculo"), F.col("prediction"))
    return rows.select(*KEY, near(score, 6).alias("Fleet_Health_Score"))


@query("q_predictions_table", with_tables(LISTINGS_SQL, f"""
, p AS (SELECT *, {_FORMULA} AS p FROM listings),
m AS (SELECT 1 - sum((idade_veiculo - p) ** 2) / (var_pop(idade_veiculo) * count(*)) AS r2 FROM p
      WHERE idade_veiculo IS NOT NULL),
s AS (SELECT date_trunc('month', l_shipdate) AS period, count(*) AS n FROM listings GROUP BY 1),
z AS (SELECT period, (n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ())::DOUBLE AS y,
      min(n) OVER () AS low, max(n) OVER () AS high FROM s),
x AS (SELECT *, lag(y) OVER (ORDER BY period) AS x FROM z),
f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, max_by(y, period) AS y, any_value(low) AS low,
      any_value(high) AS high FROM x),
e AS (SELECT avg((x.y - a * x - b) ** 2) AS loss FROM x, f WHERE x IS NOT NULL)
SELECT {KEYS}, near(p, 6) AS "Aging_Predicted", near(abs(idade_veiculo - p), 6) AS "Fleet_Health_Score",
       near((a * y + b) * (high - low) + low, 4) AS "Predicted_Demand_Next_Period",
       '01/01/2026 00:00:00' AS "Prediction_Date",
       format('Fleet R2: {{:.2f}} | Demand Loss: {{:.4f}}', r2, loss) AS "Model_Metrics" FROM p, m, f, e"""))
def q_predictions_table(spark, folder):
    """Predictions table around a formula model and a one-lag forecast, both known in SQL."""
    rows = listings(spark, folder)
    scored = _formula(rows).withColumnRenamed("prediction", "Aging_Predicted")
    metrics = fleet.evaluate(scored, prediction="Aging_Predicted")
    forecast = demand.forecast(demand.series(rows, "l_shipdate", "month"), window=1)
    out = predict.table(scored, forecast, metrics, AS_OF).select(
        *KEY, "Aging_Predicted", "Fleet_Health_Score", "Predicted_Demand_Next_Period",
        "Prediction_Date", "Model_Metrics",
    )
    return rounded(rounded(out, 6, "Aging_Predicted", "Fleet_Health_Score"), 4, "Predicted_Demand_Next_Period")


@query("q_fleet_split", with_tables(LISTINGS_SQL, f"""
SELECT {KEYS}, CAST('0x' || substr(md5(concat_ws('|', '42', {KEYS})), 1, 8) AS BIGINT) % 100 < 20 AS held_out FROM listings"""))
def q_fleet_split(spark, folder):
    return listings(spark, folder).select(*KEY, fleet.is_held_out(KEY).alias("held_out"))


@query("q_fleet_quality", with_tables(LISTINGS_SQL, f"""
, s AS (SELECT idade_veiculo AS y, CAST('0x' || substr(md5(concat_ws('|', '42', {KEYS})), 1, 8) AS BIGINT) % 100 < 20 AS held_out FROM listings)
SELECT count(*) FILTER (NOT held_out AND y IS NOT NULL) AS n_train, count(*) FILTER (held_out AND y IS NOT NULL) AS n_test,
       true AS r2_high, true AS mae_low, count(y) AS n_scored, true AS reloaded_equal FROM s"""))
def q_fleet_quality(spark, folder):
    """Trees trained on the listings: sizes of both parts, quality on the part held out, a score of
    every row, and the same predictions after saving and loading."""
    rows = listings(spark, folder)
    model, metrics = fleet.train(rows, tuple(KEY), rounds=10)
    path = f"{shared_folder(spark)}/fleet-{uuid.uuid4().hex}"
    model.save(path)
    again = fleet.FleetModel.load(spark, path).score(model.score(rows, "predicted"), "reloaded")
    score = predict.health_score(F.col("idade_veiculo"), F.col("predicted"))
    counts = again.agg(
        F.count_if(F.col("idade_veiculo").isNotNull() & ~fleet.is_held_out(KEY)).alias("n_train"),
        F.count_if(score == F.abs(F.col("idade_veiculo") - F.col("predicted"))).alias("n_scored"),
        (F.count_if(F.col("predicted") != F.col("reloaded")) == 0).alias("reloaded_equal"),
    )
    found = metrics.select(F.col("n").alias("n_test"), (F.col("r2") > 0.9).alias("r2_high"), (F.col("mae") < 1.0).alias("mae_low"))
    return counts.select("*", *[found.select(c).scalar().alias(c) for c in found.columns])


@query("q_fleet_predictions")
def q_fleet_predictions(spark, folder):
    """Boosted trees trained on the listings, with the month-by-month demand forecast."""
    # What neither the models nor the result hold need not be kept with Gold.
    rows = listings(spark, folder).select(
        *KEY, *fleet.LABELS, *fleet.NUMBERS, fleet.TARGET, F.col("l_shipdate").alias("data_coleta"))
    out = refine.predictions(rows, AS_OF, tuple(KEY), unit="month")
    return out.select(
        *KEY, "idade_veiculo", "Aging_Predicted", "Fleet_Health_Score",
        "Predicted_Demand_Next_Period", "Prediction_Date", "Model_Metrics",
    )
