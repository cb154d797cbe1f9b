"""Age model: label codes, features, boosted trees, held-out metrics, scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.bins import BINS, binned, split_points
from vitrine.operators.joins import lookup_join
from vitrine.operators.ordered import ranks, stored
from vitrine.session import shared_folder

LABELS = ("marca", "modelo")
NUMBERS = ("ano_fabricacao", "km", "preco")
TARGET = "idade_veiculo"
UNKNOWN = -1
#: Stands, with either sign, for a number that is not there.
ABSENT = 1e18
#: Bits that hold the number of a bin, or BINS for an absent number.
BITS = BINS.bit_length()
#: Cells that one task passes over at most, and so keeps.
CELLS_A_TASK = 1_000_000
#: The trees draw the square of their bins from the rows they are given; more would not fit its type.
MOST_BINS = 46_340


def encoders(df: DataFrame, columns: Sequence[str] = LABELS) -> dict[str, DataFrame]:
    """`{column: (column, code)}`: distinct labels numbered from 0 in alphabetical order.

    One pass finds the labels of all columns. They are numbered in ranges between sampled split points,
    each shifted by the labels before it, so a long vocabulary is ordered by many tasks, whatever
    its labels begin with.
    """
    labels = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_label"))
            for c in columns
        ])).alias("e"))
        .select("e._column", "e._label")
        .where(F.col("_label").isNotNull())
        .distinct()
    )
    codes = ranks(labels, ["_label"], ["_column"]).select("_column", "_label", F.col("rank").cast("int").alias("code"))
    # Tables of known size: a short vocabulary is then broadcast, and its rows are not dealt out by a few labels.
    return {
        c: stored(codes.where(F.col("_column") == c).select(F.col("_label").alias(c), "code"), "codes")
        for c in columns
    }


def encode(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Adds the code of the label; a label the codes lack, or a null, becomes -1."""
    joined = lookup_join(df, codes.withColumnRenamed("code", name), [column], "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(UNKNOWN)))


def split(df: DataFrame, key: Sequence[str], seed: int = 42, held_out: int = 20) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row's key: the same rows under any partitioning."""
    test = is_held_out(key, seed, held_out)
    return df.where(~test), df.where(test)


def is_held_out(key: Sequence[str], seed: int = 42, held_out: int = 20) -> Column:
    """Whether a row is in the test part: by the first 32 bits of an MD5 of seed and key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100 < held_out


def evaluate(df: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """Mean absolute error and R² in one pass."""
    both = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sum((y - p) * (y - p)).alias("_rss"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_tss"),
    )
    return sums.select("n", "mae", (1 - F.try_divide("_rss", "_tss")).alias("r2"))


@dataclass
class FleetModel:
    """Trained trees with the label codes and split points they were trained on (None: trees over plain values)."""

    trees: GBTRegressionModel
    codes: dict[str, DataFrame]
    numbers: Sequence[str] = NUMBERS
    points: dict[str, list[float]] | None = None

    def features(self, df: DataFrame) -> DataFrame:
        return features(df, self.codes, self.numbers, self.points)

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        scored = self.trees.transform(self.features(df))
        return scored.select(*df.columns, F.col("prediction").alias(name))

    def save(self, path: str) -> None:
        """Trees, label codes, and which labels and numbers in which order make the features, with their split points."""
        self.trees.write().overwrite().save(f"{path}/trees")
        for column, codes in self.codes.items():
            codes.write.mode("overwrite").parquet(f"{path}/codes_{column}")
        points = self.points or {}
        inputs = [(i, kind, name, points.get(name)) for kind, names in (("label", self.codes), ("number", self.numbers))
                  for i, name in enumerate(names)]
        spark = next(iter(self.codes.values())).sparkSession
        schema = "place int, kind string, name string, points array<double>"
        spark.createDataFrame(inputs, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FleetModel:
        inputs = spark.read.parquet(f"{path}/inputs").orderBy("place").collect()  # one row per feature
        labels, numbers = ([r["name"] for r in inputs if r["kind"] == k] for k in ("label", "number"))
        codes = {c: spark.read.parquet(f"{path}/codes_{c}") for c in labels}
        # Models kept before trees were given bins have no split points.
        points = {r["name"]: list(r["points"]) for r in inputs if "points" in r and r["points"] is not None} or None
        return FleetModel(GBTRegressionModel.load(f"{path}/trees"), codes, tuple(numbers), points)


def features(
    df: DataFrame, codes: dict[str, DataFrame], numbers: Sequence[str] = NUMBERS,
    points: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Adds the `features` vector: label codes, and every number twice; with split points, their bins instead.

    An absent number lies below all others in the first of the two and above all in the second. A
    split on the first sends absent numbers left, on the second right: the trees' search over all
    splits thus learns for each split on which side they belong.
    """
    out = df
    for column, table in codes.items():
        out = encode(out, column, table if points is None else _binned_codes(table, column, points), f"_{column}")
    if points is not None:
        out = binned(out, {c: points[c] for c in numbers})
        return out.withColumn("features", _vector(codes, numbers)).drop(*[f"_{c}" for c in (*codes, *numbers)])
    out = out.withColumns({
        f"_{side}_{c}": F.coalesce(F.col(c).cast("double"), F.lit(value))
        for c in numbers for side, value in (("low", -ABSENT), ("high", ABSENT))
    })
    inputs = [*[f"_{c}" for c in codes], *[f"_{side}_{c}" for c in numbers for side in ("low", "high")]]
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(out)
    return assembled.drop(*inputs)


def _binned_codes(codes: DataFrame, column: str, points: dict[str, list[float]]) -> DataFrame:
    """The label table with bins in place of codes. An unknown label, -1, is on the left of every split, as its code is."""
    return binned(codes, {"code": points[column]}).select(column, F.col("_code").alias("code"))


def _vector(labels: Sequence[str], numbers: Sequence[str]) -> Column:
    """The features out of the bins in `_<name>`, null for an absent number: 0 in the first of the two, the last in the second."""
    both = [x for c in numbers for x in (F.coalesce(F.col(f"_{c}") + 1, F.lit(0)), F.coalesce(F.col(f"_{c}"), F.lit(BINS)))]
    return array_to_vector(F.array(*[x.cast("double") for x in (*[F.col(f"_{c}") for c in labels], *both)]))


def cells(
    coded: DataFrame, labels: Sequence[str], numbers: Sequence[str], points: dict[str, list[float]], target: str,
) -> tuple[DataFrame, int]:
    """`features, n, target`: one row for each set of bins, with its rows and their mean target; and how many there are.

    A tree sees no more of a row than its bins, and what it sums in a node are counts and targets. So it
    is the same over these as over the rows, but there are never more than there are sets of bins.
    """
    names = [*labels, *numbers]
    places = [F.coalesce(F.col(f"_{c}"), F.lit(BINS)).cast("long") for c in names]
    key = sum((F.shiftleft(place, BITS * i) for i, place in enumerate(places)), F.lit(0).cast("long"))
    found = stored(binned(coded, {c: points[c] for c in names}).groupBy(key.alias("_key")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg(target).alias(target)), "cells")
    place = {c: F.shiftright("_key", BITS * i).bitwiseAND(F.lit((1 << BITS) - 1)) for i, c in enumerate(names)}
    size = found.count()
    # An equal share for each core: every round waits for the slowest task.
    dealt = found.repartition(max(found.sparkSession.sparkContext.defaultParallelism, -(-size // CELLS_A_TASK)), "_key")
    bins = dealt.select("n", target, *[F.when(p < BINS, p).alias(f"_{c}") for c, p in place.items()])
    return bins.select(_vector(labels, numbers).alias("features"), "n", target), size


def train(
    df: DataFrame, key: Sequence[str] = ("id",), rounds: int = 100, rate: float = 0.1,
    depth: int = 5, seed: int = 42, target: str = TARGET, with_year: bool = True,
) -> tuple[FleetModel, DataFrame]:
    """Model and its held-out metrics.

    The rows are coded once, and gathered by the bins of their features: every round then passes over
    cells, however many rows there are.

    The target is derived from the manufacture year, so the year gives the answer away; it is
    kept for parity and left out with `with_year=False`.
    """
    shared_folder(df.sparkSession)  # long training cuts its lineage there
    numbers = NUMBERS if with_year else tuple(c for c in NUMBERS if c != "ano_fabricacao")
    needed = list(dict.fromkeys([*key, *LABELS, *numbers, target]))
    rows = df.select(*needed).where(F.col(target).isNotNull())
    codes = encoders(rows)
    coded = rows
    for c, table in codes.items():
        coded = encode(coded, c, table, f"_{c}")
    coded = stored(coded.select(
        *[F.col(f"_{c}").cast("double").alias(c) for c in codes], *[F.col(c).cast("double").alias(c) for c in numbers],
        F.col(target).cast("double").alias("_target"), is_held_out(key, seed).alias("_held_out"),
    ), "coded")
    learn, test = coded.where(~F.col("_held_out")), coded.where("_held_out")
    points = split_points(learn, [*codes, *numbers])
    gathered, size = cells(learn, codes, numbers, points, "_target")
    # With as many bins the trees draw every cell when they look for split points, and find one between all bins.
    bins = max(BINS, min(MOST_BINS, math.isqrt(size) + 1))
    trees = GBTRegressor(
        featuresCol="features", labelCol="_target", predictionCol="prediction", weightCol="n", maxIter=rounds, maxBins=bins,
        stepSize=rate, maxDepth=depth, lossType="squared", seed=seed, checkpointInterval=10,
    ).fit(gathered)
    model = FleetModel(trees, codes, numbers, points)
    held = binned(test, points).withColumn("features", _vector(codes, numbers))
    return model, evaluate(trees.transform(held), "_target")
