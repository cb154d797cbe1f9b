"""Cards out of listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import lookups
from vitrine.functions.text import strip

# A card element directly inside a link.
CARD = r"(?is)<a\b[^>]*>\s*<card\b[^>]*>(.*?)</card\s*>"
_BREAK = r"(?i)<br\s*/?>|</(?:p|div|li|h[1-6]|section|article|ul|ol|tr)\s*>"


def card_markup(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(CARD), F.lit(1))


def card_count(html: Column) -> Column:
    return F.size(card_markup(html))


def card_lines(markup: Column) -> Column:
    """Visible lines of a card; the purchase flag is its last line."""
    text = F.regexp_replace(F.regexp_replace(markup, _BREAK, "\n"), r"(?s)<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda line: line != "")
    shout = F.upper(markup)
    online = F.lit(False)
    for marker in lookups.ONLINE_MARKERS:
        online = online | F.contains(shout, F.lit(marker))
    flag = F.when(online, F.lit("Sim")).otherwise(F.lit("Não"))
    return F.array_append(lines, F.concat(F.lit(lookups.PURCHASE_FLAG + ": "), flag))


def cards_from_pages(pages: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per card, with its place on the page."""
    return pages.select(*keep, F.posexplode(card_markup(F.col("html"))).alias("card", "_m")).select(
        *keep, "card", card_lines(F.col("_m")).alias("lines")
    )
