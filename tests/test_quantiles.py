from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators.quantiles import _bucket, quantiles

WANTED = {"lo": 0.0, "q1": 0.25, "m": 0.5, "p99": 0.99, "hi": 1.0}


def samples():
    rng = np.random.default_rng(7)
    return {
        "even": rng.uniform(-100, 100, 400), "one": np.array([3.5]), "hot": np.array([7.0] * 500 + [1.0, 9.0]),
        "wide": 10.0 ** rng.uniform(-6, 12, 300), "tiny": rng.uniform(0, 1e-6, 50), "pair": np.array([1.0, 2.0]),
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_grouped_quantiles_are_exact(spark, parts):
    data = samples()
    rows = [(g, float(v)) for g, values in data.items() for v in values] + [("even", None), ("even", float("nan"))]
    out = quantiles(spark.createDataFrame(rows, "g string, v double").repartition(parts), "v", WANTED, ["g"])
    got = {r.g: r for r in out.collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        for name, p in WANTED.items():
            assert np.isclose(got[g][name], np.quantile(values, p), rtol=1e-12, atol=0), (g, name)


def test_quantiles_of_a_whole_frame(spark):
    values = samples()["even"]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = quantiles(df, "v", WANTED).collect()[0]
    assert [row[n] for n in WANTED] == pytest.approx([np.quantile(values, p) for p in WANTED.values()])
    rough = quantiles(df, "v", {"m": 0.5}, approximate=10000).collect()[0]
    assert abs(rough.m - np.median(values)) < 2


def test_values_near_zero_are_spread(spark):
    """A million ratios below 0.001, of both signs, and zeros: exact, and no bucket holds a hundredth of them."""
    n = 1_000_000
    ratio = F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / F.lit(1.1e9) * F.when(F.col("id") % 5 == 0, -1).otherwise(1)
    df = spark.range(n).select(F.when(F.col("id") % 1000 == 7, 0.0).otherwise(ratio).alias("v"))
    sizes = df.groupBy(_bucket(F.col("v")).alias("b")).agg(F.countDistinct("v").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < n / 100
    wanted = {"p01": 0.01, "q1": 0.25, "median": 0.5, "p99": 0.99}
    row = quantiles(df, "v", wanted).first()
    values = np.array([r[0] for r in df.collect()])
    assert all(abs(row[k] - np.quantile(values, p)) < 1e-15 for k, p in wanted.items())
    tiny = spark.createDataFrame([(5e-324,), (-5e-324,), (0.0,), (1.7e308,), (-1.7e308,)], "v double")
    order = [r.v for r in tiny.orderBy(_bucket(F.col("v"))).collect()]
    assert order == [-1.7e308, -5e-324, 0.0, 5e-324, 1.7e308]
