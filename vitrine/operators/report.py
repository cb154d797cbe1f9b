"""Dashboard queries over Gold. Each aggregates before anything else moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup_join
from vitrine.operators.quantiles import quantiles


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("id").alias("total_carros"),
        F.avg("preco").alias("preco_medio"),
        F.avg("km").alias("km_medio"),
    )


def by_brand(df: DataFrame) -> DataFrame:
    return df.groupBy("marca").agg(F.count("id").alias("n"))


def by_location(df: DataFrame) -> DataFrame:
    """Listings, total and mean price per place."""
    return df.groupBy("localizacao").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("preco").alias("preco_total"),
        F.avg("preco").alias("preco_medio"),
    )


def histogram(df: DataFrame, column: str = "preco", bins: int = 20) -> DataFrame:
    """Equal-width bins from the lowest to the highest value, the last one closed."""
    known = df.where(F.col(column).isNotNull())
    bounds = known.agg(
        F.struct(
            F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")
        ).alias("b")
    ).scalar()
    low, width = bounds["low"], (bounds["high"] - bounds["low"]) / F.lit(float(bins))
    place = F.coalesce(F.floor(F.try_divide(F.col(column) - low, width)), F.lit(0))
    counted = (
        known.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("de"),
        (low + (F.col("bin") + 1) * width).alias("ate"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"),
    )


def scatter(df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    return df.where(F.col("km").isNotNull() & F.col("preco").isNotNull()).select(
        *keep, "km", "preco", "idade_veiculo"
    )


def boxplot(df: DataFrame, approximate: int | None = None) -> DataFrame:
    """Five numbers of the price per brand."""
    wanted = {"minimo": 0.0, "q1": 0.25, "mediana": 0.5, "q3": 0.75, "maximo": 1.0}
    return quantiles(df, "preco", wanted, ["marca"], approximate)


def slicer_values(
    df: DataFrame, columns: Sequence[str] = ("marca", "faixa_preco", "faixa_km")
) -> DataFrame:
    """Distinct values to filter by, per column, in one pass."""
    tall = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("campo"), F.col(c).alias("valor")) for c in columns
    ])).alias("e")).select("e.campo", "e.valor")
    return tall.where(F.col("valor").isNotNull()).distinct()


def slice_by(df: DataFrame, **values: str | Sequence[str]) -> DataFrame:
    """Rows whose columns have one of the given values."""
    for column, wanted in values.items():
        df = df.where(F.col(column).isin([wanted] if isinstance(wanted, str) else list(wanted)))
    return df


def brand_means(df: DataFrame) -> DataFrame:
    return df.groupBy("marca").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("preco").alias("preco_medio"),
        F.avg("idade_veiculo").alias("idade_media"),
    )


def correlations(
    df: DataFrame, columns: Sequence[str] = ("preco", "km", "ano_fabricacao")
) -> DataFrame:
    """Correlation of every pair of the columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
        for a, b in pairs
    ])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("corr"))
        for a, b in pairs
    ])).alias("e")).select("e.*")


def tier_counts(df: DataFrame, column: str = "faixa_preco") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def by_year(df: DataFrame) -> DataFrame:
    return df.where(F.col("ano_fabricacao").isNotNull()).groupBy("ano_fabricacao").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("preco").alias("preco_medio"),
        F.avg("km").alias("km_medio"),
    )


def hierarchy(df: DataFrame, levels: Sequence[str] = ("marca", "modelo", "versao")) -> DataFrame:
    """Counts and mean price at every level of a hierarchy.

    The leaves are aggregated first: the roll-up repeats leaves, not rows.
    """
    leaves = df.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("preco").alias("_sum"), F.count("preco").alias("_known")
    )
    return leaves.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("nivel"),
        F.sum("_n").cast("bigint").alias("n"),
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("preco_medio"),
    )


def place_parts(df: DataFrame, place: str = "localizacao") -> DataFrame:
    """Adds `estado` and `cidade` for a state > city hierarchy."""
    return df.withColumns({
        "estado": F.trim(F.substring_index(place, ",", -1)),
        "cidade": F.trim(F.substring_index(place, ",", 1)),
    })


def cross(df: DataFrame, rows: str = "marca", columns: str = "localizacao") -> DataFrame:
    return df.groupBy(rows, columns).agg(
        F.count(F.lit(1)).alias("n"), F.avg("preco").alias("preco_medio")
    )


def tier_heatmap(df: DataFrame, values: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Mean price by year and mileage tier, one column per given tier."""
    wide = df.groupBy("ano_fabricacao").pivot("faixa_km", list(values)).agg(F.avg("preco"))
    return wide.select(
        "ano_fabricacao", *[F.col(f"`{v}`").alias(name) for v, name in zip(values, names)]
    )


def offers(df: DataFrame, n: int = 10, new_age: int = 1) -> DataFrame:
    """The n places with the lowest mean price, with their share of nearly new cars."""
    share: Column = F.avg(F.when(F.col("idade_veiculo") <= new_age, 1.0).otherwise(0.0))
    return (
        df.where(F.col("localizacao").isNotNull()).groupBy("localizacao")
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg("preco").alias("preco_medio"),
            share.alias("novos"),
        )
        .orderBy("preco_medio", "localizacao").limit(n)
    )


def opportunity(
    df: DataFrame, keep: Sequence[str] = ("id",),
    market: Sequence[str] = ("marca", "ano_fabricacao"),
) -> DataFrame:
    """Depreciation against the mean price of the listing's market.

    The means are a small table joined back; a window over the market would sort every row of a
    popular brand in one task.
    """
    known = df.where(F.col("preco").isNotNull())
    for column in market:
        known = known.where(F.col(column).isNotNull())
    means = known.groupBy(*market).agg(F.avg("preco").alias("preco_esperado"))
    rows = known.select(*dict.fromkeys([*keep, *market, "preco"]))
    return lookup_join(rows, means, list(market), "inner").select(
        *dict.fromkeys([*keep, *market]), "preco", "preco_esperado",
        F.try_divide(F.col("preco_esperado") - F.col("preco"), F.col("preco_esperado"))
        .alias("desvalorizacao"),
    )
