"""Demand series and its forecast.

A series counts listings per period and group; from then on only periods are handled, never
listings. The forecaster is a linear autoregression on the scaled series: Spark sums the
products of lags per group, and one small system per group is solved by column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.sources import versions

WINDOW = 7


def series(
    df: DataFrame, time: str = "data_coleta", unit: str = "day", group: Sequence[str] = ()
) -> DataFrame:
    """Listings per period (and group). Rows without a usable time are dropped; periods without
    listings are not filled in."""
    stamp = F.col(time)
    if dict(df.dtypes)[time] == "string":
        stamp = F.try_to_timestamp(stamp)
    return (
        df.select(*group, F.date_trunc(unit, stamp).alias("period"))
        .where(F.col("period").isNotNull())
        .groupBy(*group, "period")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _over(group: Sequence[str]):
    return Window.partitionBy(*([*group] or [F.lit(0)]))


def guard(counts: DataFrame, group: Sequence[str] = (), window: int = WINDOW) -> DataFrame:
    """Periods per group, and whether they are enough for one training row."""
    enough = F.when(F.col("periods") >= window + 1, F.lit("ok"))
    return counts.groupBy(*group).agg(F.count(F.lit(1)).alias("periods")).withColumn(
        "status", enough.otherwise(F.lit("insufficient_history"))
    )


def minmax(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Adds `scaled` in 0..1 (0 for a constant series) and the bounds it was scaled by."""
    whole = _over(group)
    span = F.col("high") - F.col("low")
    return (
        counts.withColumns({
            "low": F.min("n").over(whole).cast("double"),
            "high": F.max("n").over(whole).cast("double"),
        })
        .withColumn("scaled", F.coalesce(F.try_divide(F.col("n") - F.col("low"), span), F.lit(0.0)))
    )


def unscale(value: Column, low: Column, high: Column) -> Column:
    return value * (high - low) + low


def lag_windows(
    scaled: DataFrame, group: Sequence[str] = (), window: int = WINDOW, value: str = "scaled"
) -> DataFrame:
    """Rows with a full history: `lags` (oldest first) and the value that follows as `target`."""
    order = _over(group).orderBy("period")
    lags = F.collect_list(value).over(order.rowsBetween(-window, -1))
    return (
        scaled.withColumn("lags", lags)
        .where(F.size("lags") == window)
        .withColumn("target", F.col(value).cast("double"))
    )


#: A pivot below this share of the number of rows says nothing of its own: its weight is 0.
FLAT = 1e-9


def solve(df: DataFrame, matrix: str, terms: int, rows: str = "rows", name: str = "weights") -> DataFrame:
    """Adds the solution of a symmetric system: `matrix` holds its rows, each with the right side last.

    Gauss-Jordan elimination over arrays, one term after another: no Python, one row per group. A
    term whose pivot vanishes depends on those before it and gets the weight 0.
    """
    out = df.withColumn("_m", F.col(matrix))
    for k in range(terms):
        # A column per step, so that each step is computed once.
        pivot = F.get(F.get("_m", F.lit(k)), F.lit(k))
        out = out.withColumn("_p", F.when(F.abs(pivot) > FLAT * F.col(rows), pivot)).withColumn("_r", F.get("_m", F.lit(k)))
        out = out.withColumn("_m", F.transform("_m", lambda row, i: F.when(F.col("_p").isNull(), row).when(
            i == k, F.transform(row, lambda x: x / F.col("_p"))).otherwise(
            F.zip_with(row, "_r", lambda x, r: x - r * F.get(row, F.lit(k)) / F.col("_p")))))
        out = out.withColumn("_free", F.array_append("_free" if k else F.array().cast("array<boolean>"), F.col("_p").isNull()))
    weights = F.transform("_m", lambda row, i: F.when(F.get("_free", i), F.lit(0.0)).otherwise(F.get(row, F.lit(terms))))
    return out.withColumn(name, weights).drop("_m", "_p", "_r", "_free")


def fit(counts: DataFrame, group: Sequence[str] = (), window: int = WINDOW) -> DataFrame:
    """`weights` (intercept first, then lags from the oldest) and mean squared `loss` per group.

    The sums are ordinary aggregates, so any number of groups trains in one shuffle.
    """
    rows = lag_windows(minmax(counts, group), group, window)
    x = [F.lit(1.0)] + [F.get("lags", F.lit(i)) for i in range(window)]
    terms = window + 1
    upper = {(i, j): f"x{i}_{j}" for i in range(terms) for j in range(i, terms)}
    sums = rows.groupBy(*group).agg(
        *[F.sum(x[i] * x[j]).alias(name) for (i, j), name in upper.items()],
        *[F.sum(x[i] * F.col("target")).alias(f"y{i}") for i in range(terms)],
        F.sum(F.col("target") * F.col("target")).alias("yy"),
        F.count(F.lit(1)).alias("rows"),
    ).where(F.col("rows") > 0)
    matrix = F.array(*[
        F.array(*[F.col(upper[min(i, j), max(i, j)]) for j in range(terms)], F.col(f"y{i}")) for i in range(terms)
    ])
    solved = solve(sums.select(*group, "rows", "yy", matrix.alias("xx")), "xx", terms)
    # Squared residuals: y'y - 2 w'x'y + w'x'x w, where each row of the matrix ends in x'y.
    right = F.transform("xx", lambda row: F.get(row, F.lit(terms)))
    fitted = F.transform("xx", lambda row: _dot(F.slice(row, 1, terms), F.col("weights")))
    residual = F.col("yy") - 2 * _dot(F.col("weights"), right) + _dot(F.col("weights"), fitted)
    loss = F.greatest(residual / F.col("rows"), F.lit(0.0))
    return solved.select(*group, "rows", "weights", loss.alias("loss"))


def _dot(one: Column, two: Column) -> Column:
    return F.aggregate(F.zip_with(one, two, lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)


def save(model: DataFrame, root: str) -> None:
    """Keep a fitted model; one that stands below `root` is replaced when this one is complete."""
    versions.replace(model, root)


def load(spark: SparkSession, root: str) -> DataFrame:
    return versions.read(spark, root)


def predict_next(
    counts: DataFrame, model: DataFrame, group: Sequence[str] = (), window: int = WINDOW
) -> DataFrame:
    """Next value of each group on the scale of counts, from its last `window` values.

    A group without enough history keeps its row, with no forecast and a status.
    """
    point = F.struct("period", F.col("scaled").alias("scaled"))
    order = _over(group).orderBy("period")
    recent = (
        minmax(counts, group)
        .withColumn("lags", F.collect_list("scaled").over(order.rowsBetween(-(window - 1), 0)))
        .groupBy(*group)
        .agg(
            F.max_by("lags", "period").alias("lags"),
            F.max(point)["period"].alias("last_period"),
            F.first("low").alias("low"), F.first("high").alias("high"),
            F.count(F.lit(1)).alias("periods"),
        )
    )
    trained = model.select(*group, "weights", "loss")
    if group:
        joined = recent.join(trained, [*group], "left")
    else:
        joined = recent.withColumn("_m", trained.select(F.struct("weights", "loss")).scalar()).select(
            "*", "_m.*"
        )
    terms = F.zip_with(
        F.slice("weights", 2, window), "lags", lambda weight, lag: weight * lag
    )
    scaled = F.get("weights", F.lit(0)) + F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    ready = (F.col("periods") >= window + 1) & F.col("weights").isNotNull()
    return joined.select(
        *group, "periods", "last_period",
        F.when(ready, unscale(scaled, F.col("low"), F.col("high"))).alias("forecast"),
        F.when(ready, F.col("loss")).alias("loss"),
        F.when(ready, F.lit("ok")).otherwise(F.lit("insufficient_history")).alias("status"),
    )


def forecast(counts: DataFrame, group: Sequence[str] = (), window: int = WINDOW) -> DataFrame:
    return predict_next(counts, fit(counts, group, window), group, window)


def optimality(
    counts: DataFrame, model: DataFrame, group: Sequence[str], window: int = WINDOW
) -> DataFrame:
    """Residuals times each input, summed per group: all zero exactly at the least squares fit."""
    rows = lag_windows(minmax(counts, group), group, window).join(
        model.select(*group, "weights"), [*group]
    )
    x = F.concat(F.array(F.lit(1.0)), F.col("lags"))
    fitted = F.aggregate(
        F.zip_with("weights", x, lambda w, v: w * v), F.lit(0.0), lambda a, b: a + b
    )
    each = rows.select(*group, F.posexplode(x).alias("term", "x"), "target", fitted.alias("fitted"))
    return each.groupBy(*group, "term").agg(
        F.sum((F.col("target") - F.col("fitted")) * F.col("x")).alias("gradient")
    )
