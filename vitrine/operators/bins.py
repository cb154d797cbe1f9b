"""Split points of columns, out of all rows, and the bins between them.

The rule is that of Spark's trees, which they apply to a sample: a column of few values is split between all
of them, any other at the values where the rows below come closest to each multiple of an equal share. Here every
row counts. A short histogram finds the parts of a column beside a split point, and only those are looked into,
finer with every pass, until the values on both sides are known. The driver sees histograms, never the values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.quantiles import _bucket

#: Bins of a column at most; the trees' own default.
BINS = 32
#: Into how many pieces a pass divides each part that it looks into.
PIECES = 256

#: Rows, lowest and highest value.
Part = tuple[int, float, float]


def rule(parts: Sequence[Part], bins: int = BINS) -> tuple[list[float], list[Part]]:
    """Split points between parts in ascending order, and the parts that must be divided before these are exact."""
    several = [low < high for _, low, high in parts]
    if len(parts) <= bins:
        chosen, unsure = list(range(1, len(parts))), [p for p, many in zip(parts, several) if many]
    else:
        share = sum(n for n, _, _ in parts) / bins
        chosen, below, target = [], parts[0][0], share
        for i in range(1, len(parts)):
            before, below = below, below + parts[i][0]
            if abs(before - target) < abs(below - target):
                chosen.append(i)
                target += share
        unsure = [parts[j] for j in sorted({j for i in chosen for j in (i - 1, i)}) if several[j]]
    # Halves first: the sum of two large numbers has no double.
    return sorted({parts[i - 1][2] / 2 + parts[i][1] / 2 for i in chosen}), unsure


def _parts(values: DataFrame, *place: Column) -> DataFrame:
    return values.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def _inside(values: DataFrame, spans: Sequence[Part]) -> DataFrame:
    """The values inside the spans, with `span`, where theirs begins, and `piece`, their piece of it."""
    ends = {low: high for _, low, high in spans}
    edges = sorted({-math.inf, math.inf, *ends, *(math.nextafter(high, math.inf) for high in ends.values())})
    placed = Bucketizer(splits=edges, inputCol="v", outputCol="at").transform(values)

    def of(find) -> Column:
        known = F.array(*[F.lit(find(e) if e in ends else None).cast("double") for e in edges])
        return F.get(known, F.col("at").cast("int"))

    width = of(lambda e: max((ends[e] - e) / PIECES, sys.float_info.min * sys.float_info.epsilon))
    return placed.withColumns({"span": of(lambda e: e), "width": width}).where("span IS NOT NULL").withColumn(
        "piece", F.floor((F.col("v") - F.col("span")) / F.col("width")))


def split_points(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Ascending split points of each column's values, fewer than `bins`; nulls and NaN have no part in them."""
    far = sys.float_info.max

    def values(column: str) -> DataFrame:
        v = F.col(column).cast("double")
        finite = F.when(v == math.inf, F.lit(far)).when(v == -math.inf, F.lit(-far)).otherwise(v)
        return df.select(finite.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))

    def collected(frames: dict[str, DataFrame]) -> dict[str, list[Part]]:
        named = [f.select(F.lit(c).alias("c"), "n", "low", "high") for c, f in frames.items()]
        found: dict[str, list[Part]] = {c: [] for c in columns}
        for r in reduce(DataFrame.unionByName, named).collect():  # a short histogram of each column
            found[r.c].append((r.n, r.low, r.high))
        return found

    parts = collected({c: _parts(values(c), _bucket(F.col("v"))) for c in columns})
    while True:
        parts = {c: sorted(p, key=lambda x: x[1]) for c, p in parts.items()}
        ruled = {c: rule(p, bins) for c, p in parts.items()}
        unsure = {c: several for c, (_, several) in ruled.items() if several}
        if not unsure:
            return {c: points for c, (points, _) in ruled.items()}
        divided = collected({c: _parts(_inside(values(c), p), F.col("span"), F.col("piece")) for c, p in unsure.items()})
        for c, p in unsure.items():
            parts[c] = [*(set(parts[c]) - set(p)), *divided[c]]


def binned(df: DataFrame, points: dict[str, list[float]]) -> DataFrame:
    """Adds `_<column>`: how many of the column's split points lie below its value. A null stays one, NaN is an error."""
    # Bins of the library are closed below, the sides of a split above. A point that no value passes makes up for none.
    splits = [[-math.inf, *[math.nextafter(p, math.inf) for p in found or [sys.float_info.max / 2]], math.inf]
              for found in points.values()]
    doubles = df.withColumns({f"_in_{c}": F.col(c).cast("double") for c in points})
    return Bucketizer(
        splitsArray=splits, inputCols=[f"_in_{c}" for c in points], outputCols=[f"_{c}" for c in points],
    ).transform(doubles).drop(*[f"_in_{c}" for c in points])
