"""Gold cleaning: places, names, labels and text of typed listings.

Every step is a column expression, gives the same result when it runs again on its own output,
and needs no shuffle.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine import lookups
from vitrine.functions import dictionary
from vitrine.functions.numbers import money
from vitrine.functions.text import (
    SPACES, after_last, before_last, collapse_spaces, drop_prefix, extract, strip,
)
from vitrine.schemas import GOLD

REQUIRED = ("marca", "modelo", "preco")


def strip_junk(
    place: Column, site_names: Sequence[str] = (), folded: Column | None = None
) -> Column:
    """Without sales words, doubled spaces and marks left over at either end.

    `folded`, the lower-case place as a column of its own, spares places without any of the
    words the patterns begin with the search for the patterns.
    """
    patterns = [*lookups.JUNK_PATTERNS, *site_names]
    bare = F.regexp_replace(place, f"(?iu)(?:{'|'.join(patterns)})", "")
    if folded is not None:
        openings = [re.match(r"\w+", p) for p in patterns]
        if all(openings):
            hints = [F.contains(folded, F.lit(o.group().lower())) for o in openings]
            bare = F.when(reduce(lambda a, b: a | b, hints), bare).otherwise(place)
    tidy = collapse_spaces(bare)
    return F.btrim(F.rtrim(tidy, F.lit("•,-" + SPACES)), F.lit("•" + SPACES))


def dealer_lookup(place: Column, dealers: Sequence[tuple] = lookups.DEALERS) -> Column:
    """'City, UF' of the first dealer named in the place; null if none is."""
    name = strip(F.regexp_replace(place, r",\s*[A-Z]{2}$", ""))
    towns = F.array(*[F.lit(f"{city}, {state}") for _, city, state, _ in dealers])
    found = F.get(towns, dictionary.contained_rank(name, [d[0] for d in dealers]) - 1)
    shared = os.path.commonprefix([d[0].lower() for d in dealers])
    return F.when(F.contains(F.lower(place), F.lit(shared)), found) if shared else found


def _city_prefix(place: Column, cities: Sequence[str], strict_order: bool) -> Column:
    return dictionary.first_prefix(
        place, cities if strict_order else dictionary.longest_first(cities)
    )


def location_from_text(
    df: DataFrame,
    cities: Sequence[str] = lookups.CITIES,
    dealers: Sequence[tuple] = lookups.DEALERS,
    site_names: Sequence[str] = (),
    strict_order: bool = False,
    text: str = "texto_completo",
    place: str = "localizacao",
) -> DataFrame:
    """Place between the mileage and the price of the full text, else the place column.

    Each intermediate is a column of its own, so Catalyst computes it once.
    """
    between = strip(F.regexp_extract(text, r"(?i)\d\s*KM\s+(.*?)\s+R\$", 1))
    raw, bare, town = F.col("_raw"), F.col("_bare"), F.col("_town")
    city = F.coalesce(_city_prefix(town, cities, strict_order), town)
    state = F.upper(strip(after_last(bare, ",")))
    named = F.when(town.isNotNull(), F.concat(city, F.lit(", "), state)).otherwise(bare)
    found = F.coalesce(dealer_lookup(bare, dealers), named) if dealers else named
    return (
        df.withColumn("_between", between)
        .withColumn("_raw", F.when(F.col("_between") != "", F.col("_between")).otherwise(F.col(place)))
        .withColumn("_folded", F.lower(raw))
        .withColumn("_bare", strip_junk(raw, site_names, F.col("_folded")))
        .withColumn("_town", F.when(F.contains(bare, F.lit(",")), strip(before_last(bare, ","))))
        .withColumn(
            place,
            F.when((strip(raw) != "") & (F.col("_folded") != "none"), found).otherwise(F.col(place)),
        )
        .drop("_between", "_raw", "_folded", "_bare", "_town")
    )


def normalize_location(
    df: DataFrame,
    cities: Sequence[str] = lookups.CITIES,
    states: Sequence[str] = lookups.STATES,
    strict_order: bool = False,
    place: str = "localizacao",
) -> DataFrame:
    """'Address, uf' -> 'City, UF'; a place without a comma is only stripped.

    The longest city that opens the address wins, and only if none does, the first listed city
    inside it. With `strict_order` the first listed city that opens it or lies in it wins.
    """
    bare, town, tail = F.col("_bare"), F.col("_town"), F.col("_tail")
    state = F.coalesce(extract(tail, "(" + "|".join(states) + ")$"), tail)
    inside = dictionary.first_contained(town, cities)
    city = inside if strict_order else F.coalesce(_city_prefix(town, cities, False), inside)
    opening = "|".join(lookups.SHOP_PREFIXES)
    rest = "|".join(lookups.ADDRESS_WORDS)
    short = F.regexp_replace(
        F.regexp_replace(town, rf"(?iu)^(?:{opening})\s+", ""), rf"(?iu)\s+(?:{rest}).*$", ""
    )
    named = F.concat(F.coalesce(F.col("_city"), strip(short)), F.lit(", "), state)
    return (
        df.withColumn("_bare", strip(F.col(place)))
        .withColumn("_town", F.when(F.contains(bare, F.lit(",")), strip(before_last(bare, ","))))
        .withColumn("_tail", F.upper(strip(after_last(bare, ","))))
        .withColumn("_city", city)
        .withColumn(place, F.when(town.isNotNull(), named).otherwise(bare))
        .drop("_bare", "_town", "_tail", "_city")
    )


def fix_model(model: Column, brand: Column) -> Column:
    """Model without the brand in front of it (up to twice), unless nothing is left."""
    name, prefix = strip(model), strip(brand)
    bare = drop_prefix(drop_prefix(name, prefix), prefix)
    return F.coalesce(F.nullif(bare, F.lit("")), name)


def fix_version(version: Column, model: Column) -> Column:
    """Version without the model in front of it, unless nothing is left."""
    name, prefix = strip(version), strip(model)
    bare = strip(F.ltrim(drop_prefix(name, prefix), F.lit(" -•")))
    repeats = F.startswith(F.lower(name), F.lower(prefix)) & (prefix != "") & (bare != "")
    return F.when(repeats, bare).otherwise(name)


def price_raw_numeric(df: DataFrame, column: str = "preco_bruto") -> DataFrame:
    """Price text to number; a numeric column passes through."""
    source = F.col(column)
    text = isinstance(df.schema[column].dataType, T.StringType)
    return df.withColumn(column, money(source) if text else source.cast("double"))


def tier_label(label: Column) -> Column:
    """'30k-50k' -> 'R$ 30k - R$ 50k'; a label with currency stays."""
    until = F.replace(label, F.lit("Até "), F.lit("Até R$ "))
    each = F.regexp_replace(label, r"(\d+k)", r"R\$ $1")
    marked = F.when(F.startswith(label, F.lit("Até ")), until).otherwise(each)
    return F.when(F.contains(label, F.lit("R$")), label).otherwise(
        F.replace(marked, F.lit("-"), F.lit(" - "))
    )


def clean_text(text: Column) -> Column:
    """One line, single spaces, no bullets."""
    return collapse_spaces(F.replace(text, F.lit("•"), F.lit("")))


def conform(df: DataFrame, schema: T.StructType = GOLD) -> DataFrame:
    """The columns of the schema in its order; absent ones become null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def required_fields(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows whose required columns are neither null nor empty."""
    kinds = dict(df.dtypes)
    for column in columns:
        known = F.col(column).isNotNull()
        df = df.where(known & (F.col(column) != "") if kinds[column] == "string" else known)
    return df


def build(
    silver: DataFrame,
    cities: Sequence[str] = lookups.CITIES,
    states: Sequence[str] = lookups.STATES,
    dealers: Sequence[tuple] = lookups.DEALERS,
    site_names: Sequence[str] = (),
    strict_order: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Whole Gold chain; columns of `schemas.GOLD` after `keep`."""
    col = F.col
    # Cleaning never empties a required column that holds text, so the filter can come first.
    usable = required_fields(silver).where(strip(col("modelo")) != "")
    placed = location_from_text(usable, cities, dealers, site_names, strict_order)
    named = normalize_location(placed, cities, states, strict_order).withColumn(
        "modelo", fix_model(col("modelo"), col("marca"))
    )
    cleaned = price_raw_numeric(
        named.withColumns({
            "versao": fix_version(col("versao"), col("modelo")),
            "texto_completo": clean_text(col("texto_completo")),
            "faixa_preco": tier_label(col("faixa_preco")),
        })
    )
    return conform(
        cleaned, T.StructType([silver.schema[name] for name in keep] + GOLD.fields)
    )
