"""Exact quantiles without a task that holds a whole group.

The built-in exact percentile keeps every distinct value of a group in one task. Here values
are counted, a monotone bucket of the value gives a short histogram per group, and only the
buckets that hold a wanted rank are ordered, each on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Buckets for each doubling of |value|: each spans about 0.14 % of the value, however near to 0 it lies.
RESOLUTION = 512
# Makes the bucket of the smallest double above 0 positive.
LOWEST = 1_100 * RESOLUTION
# Beyond every bucket.
LAST = 2**62


def _bucket(value: Column) -> Column:
    """A number that never falls as the value grows; 0 has a bucket of its own."""
    size = F.floor(F.log2(F.abs(value)) * RESOLUTION) + F.lit(LOWEST).cast("long")
    return F.when(value < 0, -size).when(value > 0, size).otherwise(F.lit(0).cast("long"))


def place_bucket(df: DataFrame, column: str) -> Column:
    """A number that never falls along the column's ascending order: nulls first, NaN last.

    Numbers and times fall into the buckets of their size, texts into those of their first six
    bytes; other types have one bucket.
    """
    kind, place = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(place.cast("binary"), 1, 6)), 12, "0")
        bucket = F.conv(head, 16, 10).cast("long")
    elif isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        value = place.cast("timestamp").cast("double") if isinstance(kind, T.DateType) else place.cast("double")
        bucket = F.when(F.isnan(value), F.lit(LAST)).otherwise(_bucket(value))
    else:
        bucket = F.lit(0).cast("long")
    return F.when(place.isNull(), F.lit(-LAST)).otherwise(bucket)


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], keys: Sequence[str] = (),
    approximate: int | None = None,
) -> DataFrame:
    """One row per group: `keys` and one column per named probability, linearly interpolated.

    With `approximate`, `percentile_approx` of that accuracy (no interpolation).
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    if approximate:
        return rows.groupBy(*keys).agg(*[
            F.percentile_approx(value, p, approximate).cast("double").alias(name)
            for name, p in probabilities.items()
        ])
    counts = (
        rows.groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b", _bucket(F.col("_v")))
    )
    group = [*keys] or [F.lit(0)]
    upto = Window.partitionBy(*group).orderBy("_b")
    histogram = (
        counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_m"))
        .select(
            *keys, "_b", "_m",
            (F.sum("_m").over(upto) - F.col("_m")).alias("_before"),
            F.sum("_m").over(Window.partitionBy(*group)).alias("_total"),
        )
    )
    places = F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(upper).alias("upper"),
            (F.ceil if upper else F.floor)((F.col("_total") - 1) * F.lit(float(p))).alias("rank"),
        )
        for i, p in enumerate(probabilities.values()) for upper in (False, True)
    ])
    local = F.transform(
        F.filter(
            places,
            lambda x: (x["rank"] >= F.col("_before")) & (x["rank"] < F.col("_before") + F.col("_m")),
        ),
        lambda x: F.struct(
            x["i"].alias("i"), x["upper"].alias("upper"),
            (x["rank"] - F.col("_before")).alias("rank"),
        ),
    )
    wanted = histogram.select(*keys, "_b", "_total", local.alias("_w")).where(F.size("_w") > 0)
    running = Window.partitionBy(*keys, "_b").orderBy("_v")
    picked = (
        counts.join(wanted, [*keys, "_b"])
        .withColumn("_end", F.sum("_n").over(running))
        .withColumn("_w", F.filter(
            "_w",
            lambda x: (x["rank"] >= F.col("_end") - F.col("_n")) & (x["rank"] < F.col("_end")),
        ))
        .where(F.size("_w") > 0)
        .select(*keys, "_v", "_total", F.explode("_w").alias("_w"))
    )

    def at(i: int, upper: bool) -> Column:
        here = (F.col("_w.i") == i) & (F.col("_w.upper") == upper)
        return F.max(F.when(here, F.col("_v")))

    def between(i: int, p: float) -> Column:
        place = (F.max("_total") - 1) * F.lit(float(p))
        low, high = at(i, False), at(i, True)
        return low + (high - low) * (place - F.floor(place))

    return picked.groupBy(*keys).agg(*[
        between(i, p).alias(name) for i, (name, p) in enumerate(probabilities.items())
    ])
