"""Profiles of a listing table: columns, numbers, frequent values, header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.operators.quantiles import quantiles

def header(df: DataFrame, name: str, origin: str, order: Sequence[str] = ("id",)) -> DataFrame:
    """Rows, first collection time in row order, and where the data came from."""
    return df.agg(
        F.lit(name).alias("nome"),
        F.count(F.lit(1)).alias("total_registros"),
        F.min_by("data_coleta", F.struct(*order)).alias("data_coleta"),
        F.lit(origin).alias("fonte"),
    )


def basic_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_carros"),
        F.count_distinct("marca").alias("marcas_unicas"),
        F.avg("preco").alias("preco_medio"),
        F.min("preco").alias("preco_min"),
        F.max("preco").alias("preco_max"),
        F.avg("km").alias("km_medio"),
        F.avg("ano_fabricacao").alias("ano_medio"),
    )


def value_counts(df: DataFrame, column: str = "marca") -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values; equal counts in order of the value."""
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(n)


def _fingerprint(value: Column, kind: str) -> tuple[Column, Column]:
    """Two numbers that stand for a value; the first is null for a null.

    Integers stand for themselves. The hash of a double tells all doubles apart but the two zeros. Of anything
    else they are 128 bits of its text (two independent hashes).
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("long"), F.lit(0).cast("long")
    if kind == "double":
        negative = (value == 0) & F.startswith(value.cast("string"), F.lit("-"))
        return F.when(value.isNotNull(), F.xxhash64(value)), F.when(negative, F.lit(1)).otherwise(F.lit(0)).cast("long")
    text = value.cast("string")
    return F.when(text.isNotNull(), F.xxhash64(text)), F.when(text.isNotNull(), F.xxhash64(F.lit(7), F.reverse(text)))


def columns(
    df: DataFrame, order: Sequence[str] = ("id",), names: Sequence[str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Type, distinct values, nulls and first known example of each column.

    Columns are stacked to (number of the column, number or hash of the value) rows and counted per value, so no
    task sees all values of a column and no text is shuffled; `approximate` counts with a sketch instead. The
    examples are one row of aggregates without grouping, which needs no sort.
    """
    names = list(names or df.columns)
    kinds = F.create_map(*[
        F.lit(x) for f in df.schema.fields if f.name in names
        for x in (f.name, f.dataType.simpleString())
    ])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    made = [(i, *_fingerprint(F.col(c), types[c])) for i, c in enumerate(names)]
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), a.alias("a"), b.alias("b")) for i, a, b in made
    ])).alias("e")).select("e.c", "e.a", "e.b")
    if approximate:
        counted = stacked.groupBy("c").agg(
            F.approx_count_distinct("a").alias("valores_unicos"),
            F.count_if(F.col("a").isNull()).alias("valores_nulos"),
        )
    else:
        per_value = stacked.groupBy("c", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        counted = per_value.groupBy("c").agg(
            F.count("a").alias("valores_unicos"),
            F.sum(F.when(F.col("a").isNull(), F.col("n")).otherwise(F.lit(0)))
            .cast("bigint").alias("valores_nulos"),
        )
    counted = counted.withColumn("coluna", F.get(F.array(*[F.lit(c) for c in names]), F.col("c")))
    place = F.struct(*order)
    first = df.agg(*[
        F.min_by(F.col(c).cast("string"), F.when(F.col(c).isNotNull(), place)).alias(c)
        for c in names
    ])
    examples = first.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(c).alias("exemplo")) for c in names
    ])).alias("e")).select("e.*")
    return counted.join(examples, "coluna").select(
        "coluna", F.element_at(kinds, F.col("coluna")).alias("tipo"),
        "valores_unicos", "valores_nulos", "exemplo",
    )


def numeric_stats(df: DataFrame, columns: Sequence[str] = ("preco", "km"),
                  approximate: int | None = None) -> DataFrame:
    """Mean, median, extremes and sample deviation of each column, one row per column."""
    tall = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("e")).select("e.coluna", "e.v")
    moments = tall.groupBy("coluna").agg(
        F.avg("v").alias("media"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.stddev_samp("v").alias("desvio_padrao"),
    )
    medians = quantiles(tall, "v", {"mediana": 0.5}, ["coluna"], approximate)
    return moments.join(medians, "coluna", "left").select(
        "coluna", "media", "mediana", "min", "max", "desvio_padrao"
    )


def document(df: DataFrame, name: str, origin: str, order: Sequence[str] = ("id",), brands: bool = True) -> DataFrame:
    """The whole profile as one nested row, ready to be written as JSON.

    It has one entry per column and, with `brands`, one per brand; without, see `write_profile`.
    """
    def as_map(rows: DataFrame, key: str, value) -> DataFrame:
        return rows.select(F.map_from_entries(F.collect_list(F.struct(F.col(key), value))))

    per_column = as_map(
        columns(df, order), "coluna",
        F.struct("tipo", "valores_unicos", "valores_nulos", "exemplo"),
    ).scalar()
    numbers = as_map(
        numeric_stats(df), "coluna", F.struct("media", "mediana", "min", "max", "desvio_padrao")
    ).scalar()
    statistics = [numbers.alias("numeros")]
    if brands:
        statistics.append(as_map(value_counts(df), "marca", F.col("n")).scalar().alias("marcas"))
    return header(df, name, origin, order).select(
        F.struct("nome", "total_registros", "data_coleta", "fonte").alias("dataset_info"),
        per_column.alias("colunas"),
        F.struct(*statistics).alias("estatisticas"),
        F.array(*[F.lit(x) for x in lookups.INSIGHTS]).alias("insights_recomendados"),
    )


def write_json(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").json(path)


def write_profile(df: DataFrame, path: str, name: str, origin: str, order: Sequence[str] = ("id",)) -> None:
    """The profile below `path`: the nested row in `profile`, the brands as rows in `marcas`, however many."""
    write_json(document(df, name, origin, order, brands=False), f"{path}/profile")
    write_json(value_counts(df), f"{path}/marcas")
