"""Checks on raw cards and on listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import null_safe_anti

VALID_SHARE = 0.8
REPORTED_ERRORS = 10
PRICE_TARGET = 90.0


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; 0 of nothing is 0."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def card_verdict(lines: Column) -> Column:
    """'valid', or the first reason why the card is not."""
    line = [F.coalesce(F.get(lines, F.lit(i)), F.lit("")) for i in range(4)]
    size = F.size(lines)
    return (
        F.when(lines.isNull(), F.lit("não é uma lista"))
        .when(
            size < 3,
            F.concat(F.lit("muito curto ("), size.cast("string"), F.lit(" elementos)")),
        )
        .when((line[0] == "") | (line[2] == "") | (line[3] == ""), F.lit("dados básicos ausentes"))
        .when(
            ~F.rlike(line[2], F.lit(r"\d{4}/\d{4}")),
            F.concat(F.lit("padrão de ano inválido em '"), line[2], F.lit("'")),
        )
        .otherwise(F.lit("valid"))
    )


def card_verdicts(cards: DataFrame, keep: Sequence[str] = ("position",)) -> DataFrame:
    return cards.select(*keep, card_verdict(F.col("lines")).alias("verdict"))


def validate_cards(cards: DataFrame, order: Sequence[str] = ("position",)) -> DataFrame:
    """One row: total, valid cards, pass rate, verdict at 80 %, and the first ten messages.

    Only ten messages ever meet: each task hands on its first ten.
    """
    verdicts = card_verdicts(cards, order)
    first = verdicts.where(F.col("verdict") != "valid").orderBy(*order).limit(REPORTED_ERRORS)
    message = F.concat(F.lit("Card "), F.col(order[0]).cast("string"), F.lit(": "), F.col("verdict"))
    errors = first.select(
        F.transform(
            F.array_sort(F.collect_list(F.struct(*order, message.alias("message")))),
            lambda e: e["message"],
        )
    ).scalar()
    totals = verdicts.agg(
        F.count(F.lit(1)).alias("total_cards"),
        F.count_if(F.col("verdict") == "valid").alias("valid_cards"),
    )
    rate = F.when(F.col("total_cards") > 0, F.col("valid_cards") / F.col("total_cards"))
    return totals.select(
        F.coalesce(rate >= VALID_SHARE, F.lit(False)).alias("valid"),
        F.coalesce(rate, F.lit(0.0)).alias("pass_rate"),
        "total_cards",
        "valid_cards",
        F.when(F.col("total_cards") > 0, errors).otherwise(F.array(F.lit("Lista vazia")))
        .alias("errors"),
    )


def duplicates(
    df: DataFrame, keys: Sequence[str] = ("modelo", "versao", "ano_fabricacao")
) -> DataFrame:
    """Rows beyond the first of each key; nulls are equal."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicatas"))
    )


def report(df: DataFrame) -> DataFrame:
    """Completeness of price, mileage, year and place; distinct brands; duplicate rows.

    Rows are counted once per (brand, model, version, year); every figure is a sum over those
    groups, and the distinct keys come from the same shuffle.
    """
    key = ["modelo", "versao", "ano_fabricacao"]
    groups = df.groupBy("marca", *key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias("n_" + c) for c in ("preco", "km", "localizacao")],
    )
    keys = groups.select(*key).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    year_known = F.when(F.col("ano_fabricacao").isNotNull(), F.col("n"))
    rows = F.col("total_registros")
    return (
        groups.agg(
            total(F.col("n")).alias("total_registros"),
            total(F.col("n_preco")).alias("registros_com_preco"),
            total(F.col("n_km")).alias("registros_com_km"),
            total(year_known).alias("registros_com_ano"),
            total(F.col("n_localizacao")).alias("registros_com_localizacao"),
            F.count_distinct("marca").alias("marcas_unicas"),
        )
        .withColumns({
            "duplicatas": rows - keys,
            "perc_preco": percent(F.col("registros_com_preco"), rows),
            "perc_km": percent(F.col("registros_com_km"), rows),
            "perc_ano": percent(F.col("registros_com_ano"), rows),
            "perc_local": percent(F.col("registros_com_localizacao"), rows),
        })
    )


def sla(quality: DataFrame, target: float = PRICE_TARGET) -> DataFrame:
    """Price completeness against its target."""
    met = F.col("perc_preco") >= target
    return quality.select(
        "perc_preco", F.lit(float(target)).alias("target"), met.alias("met"),
        F.when(met, F.lit("SLA atendido")).otherwise(F.lit("SLA não atendido")).alias("verdict"),
    )


def coords(df: DataFrame) -> DataFrame:
    """Rows with both coordinates, and rows without a latitude."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(lat.isNotNull() & lon.isNotNull()).alias("com_coordenadas"),
        F.count_if(lat.isNull()).alias("sem_latitude"),
    )


def changed_rows(df: DataFrame, before: Column, after: Column) -> DataFrame:
    return df.agg(F.count_if(~before.eqNullSafe(after)).alias("changed"))


def new_values(current: DataFrame, reference: DataFrame, column: str = "localizacao") -> DataFrame:
    """Distinct values of the column that the reference frame lacks."""
    return null_safe_anti(
        current.select(column).distinct(), reference.select(column).distinct(), column
    )


def structure_check(pages: DataFrame) -> DataFrame:
    """Cards per source, flagged when a source's pages hold none (the layout has changed)."""
    from vitrine.sources.pages import card_count

    return (
        pages.groupBy("source")
        .agg(F.coalesce(F.sum(card_count(F.col("html"))), F.lit(0)).cast("bigint").alias("cards"))
        .withColumn("ok", F.col("cards") > 0)
    )
