"""Money text, number text and tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(text: Column) -> Column:
    """'R$ 1.234,56' -> 1234.56; null when the text holds no number."""
    whole = F.replace(text, F.lit("."), F.lit(""))
    plain = F.replace(whole, F.lit(","), F.lit("."))
    return F.regexp_extract(plain, r"\d+\.?\d*", 0).try_cast("double")


def whole_number(text: Column) -> Column:
    """'82.817' -> 82817: dots in a text number are thousands marks; null if no number."""
    return F.replace(F.trim(text), F.lit("."), F.lit("")).try_cast("bigint")


def format_currency(value: Column) -> Column:
    """1234.5 -> 'R$ 1.234,50'; null -> 'N/A'."""
    text = F.translate(F.format_number(value, 2), ".,", ",.")
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    return F.when(known, F.concat(F.lit("R$ "), text)).otherwise(F.lit("N/A"))


def format_count(value: Column, decimals: int = 0) -> Column:
    """1234 -> '1,234'; null -> 'N/A'."""
    known = value.isNotNull() & ~F.isnan(value.cast("double"))
    return F.when(known, F.format_number(value, decimals)).otherwise(F.lit("N/A"))


def tier(
    value: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = True
) -> Column:
    """Right-closed bins over ascending edges; the last bin is open to the right."""
    lowest = value >= edges[0] if include_lowest else value > edges[0]
    uppers = list(edges[1:])
    label = F.lit(labels[-1])
    for upper, name in reversed(list(zip(uppers, labels))):
        label = F.when(value <= upper, F.lit(name)).otherwise(label)
    return F.when(lowest & ~F.isnan(value.cast("double")), label)
