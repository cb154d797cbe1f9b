"""Cards to typed listings.

A card is a list of text lines, and most fields come from the first line that matches. Years
and mileage are one pattern each over the joined lines; the other fields pick their line with
plain text tests and read only that line. The whole step is row-local: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.functions import dictionary
from vitrine.functions.numbers import money, tier, whole_number
from vitrine.functions.text import after_last, before_last, extract, strip
from vitrine.schemas import SILVER

# A mileage may hold several groups of thousands; the gap before KM stays on the line.
MILEAGE = r"(\d+(?:\.\d+)*)[^\S\n]*KM"
YEARS = r"\d{4}/\d{4}"
PRICE = r"R\$\s*[\d.,]+"
BULLET = "•"


def valid_cards(cards: DataFrame) -> DataFrame:
    """At least three lines, and a title that is not just blanks (an empty one is kept)."""
    title = F.get("lines", F.lit(0))
    return cards.where((F.size("lines") >= 3) & ((title == "") | (strip(title) != "")))


def first_line(lines: Column, wanted: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(lines, wanted), F.lit(0))


def states_conditions(line: Column) -> Column:
    folded = F.lower(line)
    return reduce(
        lambda a, b: a | b, [F.contains(folded, F.lit(w)) for w in lookups.CONDITION_WORDS]
    )


def brand(title: Column, brands: Sequence[str] = lookups.BRANDS) -> Column:
    """Dictionary brand that opens the title, else its first word; null for an empty title."""
    word = F.regexp_extract(title, r"^\s*(\S+)", 1)
    known = F.coalesce(dictionary.first_prefix(title, brands), word) if brands else word
    return F.when(strip(title) != "", known)


def years(text: Column) -> tuple[Column, Column]:
    """Manufacture and model year of the first 'dddd/dddd'."""
    pair = F.regexp_extract(text, YEARS, 0)
    return F.substring(pair, 1, 4).try_cast("int"), F.substring(pair, 6, 4).try_cast("int")


def km(text: Column) -> Column:
    return F.replace(F.regexp_extract(text, MILEAGE, 1), F.lit("."), F.lit("")).try_cast("bigint")


def location_raw(lines: Column) -> Column:
    """Text after the last bullet of the first line where that text is not the mileage."""
    bulleted = F.filter(lines, lambda line: F.contains(line, F.lit(BULLET)))
    places = F.transform(bulleted, lambda line: strip(after_last(line, BULLET)))
    place = first_line(places, lambda p: (p != "") & ~F.rlike(p, F.lit(r"^[\d.]+\s*KM$")))
    return F.regexp_replace(place, r"\s*,\s*([A-Z]{2})$", ", $1")


def location_clean(place: Column) -> Column:
    """Without a leftover mileage such as '12.345 KM • '."""
    return strip(F.regexp_replace(place, r"[\d.]+\s*KM\s*•\s*", ""))


def price_raw(lines: Column) -> Column:
    """First price that does not stand in a line of payment conditions; '' if none."""
    priced = first_line(
        lines,
        lambda line: F.contains(line, F.lit("R$"))
        & F.rlike(line, F.lit(PRICE))
        & ~states_conditions(line),
    )
    return F.coalesce(F.regexp_extract(priced, PRICE, 0), F.lit(""))


def conditions(lines: Column) -> Column:
    return F.coalesce(strip(first_line(lines, states_conditions)), F.lit(""))


def purchase_flag(lines: Column) -> Column:
    mark = lookups.PURCHASE_FLAG + ":"
    line = first_line(lines, lambda text: F.startswith(text, F.lit(mark)))
    return strip(F.substr(line, F.lit(len(mark) + 1)))


def full_text(lines: Column) -> Column:
    return F.replace(F.array_join(lines, " "), F.lit("\n"), F.lit(" "))


def batch_time(as_of: datetime) -> Column:
    """Collection time as session-local wall clock."""
    return F.lit(as_of.isoformat(" ")).cast("timestamp")


def age(year: Column, as_of: datetime) -> Column:
    return (F.lit(as_of.year) - year).cast("int")


def price_per_km(price: Column, mileage: Column) -> Column:
    return F.when(mileage > 0, price / mileage)


def coerce(df: DataFrame) -> DataFrame:
    """Mileage and years to numbers; what is no number becomes null."""
    kinds = {"km": "bigint", "ano_fabricacao": "int", "ano_modelo": "int"}
    names = dict(df.dtypes)
    done = {}
    for column, kind in kinds.items():
        if column in names:
            source = F.col(column)
            number = whole_number(source) if names[column] == "string" else source
            done[column] = number.try_cast(kind)
    return df.withColumns(done)


def clean(df: DataFrame) -> DataFrame:
    """Typed columns out of text columns: price, mileage, years, place."""
    typed = coerce(df.withColumn("preco", money(F.col("preco_bruto"))))
    return typed.withColumn("localizacao", location_clean(F.col("localizacao")))


def derive(df: DataFrame, as_of: datetime, include_lowest: bool = True) -> DataFrame:
    """Tiers, age and price per km."""
    price, mileage = F.col("preco"), F.col("km")
    return df.withColumns({
        "faixa_preco": tier(price, lookups.PRICE_EDGES, lookups.PRICE_LABELS, include_lowest),
        "faixa_km": tier(mileage, lookups.KM_EDGES, lookups.KM_LABELS, include_lowest),
        "idade_veiculo": age(F.col("ano_fabricacao"), as_of),
        "preco_por_km": price_per_km(price, mileage),
    })


def parse(
    cards: DataFrame, brands: Sequence[str] = lookups.BRANDS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per usable card, still with text values in `preco_bruto`."""
    lines, text = F.col("lines"), F.col("_text")
    title = F.get("lines", F.lit(0))
    made, model = years(text)
    return (
        valid_cards(cards)
        .withColumn("_text", F.array_join("lines", "\n"))
        .select(
            *keep,
            F.col("id").cast("bigint").alias("id"),
            brand(title, brands).alias("marca"),
            title.alias("modelo"),
            F.get("lines", F.lit(1)).alias("versao"),
            made.alias("ano_fabricacao"),
            model.alias("ano_modelo"),
            km(text).alias("km"),
            location_raw(lines).alias("localizacao"),
            price_raw(lines).alias("preco_bruto"),
            conditions(lines).alias("condicoes"),
            full_text(lines).alias("texto_completo"),
            purchase_flag(lines).alias("compra_online"),
        )
    )


def with_identity(df: DataFrame, as_of: datetime) -> DataFrame:
    """One collection time for the batch; `id` is the key the source gave the card."""
    return df.withColumn("data_coleta", batch_time(as_of))


def build(
    cards: DataFrame,
    as_of: datetime,
    brands: Sequence[str] = lookups.BRANDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Validate, parse, clean and derive; columns of `schemas.SILVER` after `keep`."""
    listings = derive(clean(with_identity(parse(cards, brands, keep), as_of)), as_of)
    return listings.select(*keep, *SILVER.fieldNames())


def parse_legacy(
    cards: DataFrame, as_of: datetime, current_year: int = 2026, keep: Sequence[str] = ()
) -> DataFrame:
    """Older card layout: fixed line positions, 'Ano/Modelo Y/Y', open lowest tier."""
    line = [F.coalesce(F.get("lines", F.lit(i)), F.lit("")) for i in range(5)]
    info = line[2]
    made, model = years(F.regexp_extract(info, "Ano/Modelo (" + YEARS + ")", 1))
    parsed = cards.where(F.size("lines") >= 4).select(
        *keep,
        F.col("id").cast("bigint").alias("id"),
        F.regexp_extract(line[0], r"^\s*(\S+)", 1).alias("marca"),
        line[0].alias("modelo"),
        line[1].alias("versao"),
        made.alias("ano_fabricacao"),
        model.alias("ano_modelo"),
        km(info).alias("km"),
        F.coalesce(location_raw(F.array(info)), F.lit("")).alias("localizacao"),
        line[3].alias("preco_bruto"),
        line[4].alias("condicoes"),
        F.array_join("lines", "\n").alias("texto_completo"),
        batch_time(as_of).alias("data_coleta"),
        money(line[3]).alias("preco"),
    )
    return derive(parsed, datetime(current_year, 1, 1), include_lowest=False)


def reparse_text(df: DataFrame, as_of: datetime) -> DataFrame:
    """Years and mileage again from the full text ('Y/Y • n KM'), then the derived columns."""
    text = F.col("texto_completo")
    found = F.regexp_extract(text, r"\d{4}/\d{4}\s*•\s*[\d.]+\s*KM", 0)
    made, model = years(F.col("_found"))
    again = df.withColumn("_found", found).withColumns({
        "ano_fabricacao": made,
        "ano_modelo": model,
        "km": km(after_last(F.col("_found"), BULLET)),
    })
    return derive(again.drop("_found"), as_of)


def split_address(
    df: DataFrame,
    as_of: datetime,
    text: str = "texto_completo",
    cities: Sequence[str] = lookups.SPLIT_CITIES,
) -> DataFrame:
    """Years, mileage and city / district / state from the second line of a multi-line text."""
    lines = F.split(F.col(text), "\n")
    info = F.when(F.size(lines) >= 3, strip(F.get(lines, F.lit(1))))
    made, model = years(F.col("_info"))
    place, has_state = F.col("_place"), F.contains(F.col("_place"), F.lit(", "))
    address = F.when(has_state, strip(before_last(place, ", ")))
    city = F.coalesce(
        extract(F.col("_address"), "^(" + "|".join(cities) + ")"),
        F.regexp_extract(F.col("_address"), r"^([^ ]*)", 1),
    )
    rest = strip(F.substr(F.col("_address"), F.length("cidade") + 1))
    split = (
        df.withColumn("_info", info)
        .withColumns({
            "ano_fabricacao": made,
            "ano_modelo": model,
            "km": km(F.col("_info")),
            "_place": F.when(
                F.col("_info").isNotNull(),
                F.coalesce(location_raw(F.array(F.col("_info"))), F.lit("")),
            ),
        })
        .withColumns({
            "_address": address,
            "estado": F.when(has_state, strip(after_last(place, ", "))).otherwise(
                F.when(place.isNotNull(), F.lit(""))
            ),
        })
        .withColumn("cidade", F.when(F.col("_address").isNotNull(), city).otherwise(place))
        .withColumn(
            "bairro",
            F.when(F.col("_address").isNotNull(), rest).otherwise(
                F.when(place.isNotNull(), F.lit(""))
            ),
        )
    )
    return derive(split.drop("_info", "_place", "_address"), as_of)
