"""Raw cards: named columns, caps per source, unions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.ordered import ranks, stored
from vitrine.operators.quantiles import place_bucket
from vitrine.operators.silver import batch_time
from vitrine.schemas import BRONZE_TEXT_COLUMNS


def from_cards(cards: DataFrame, as_of: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Line i of a card becomes the i-th named column; absent lines become ''."""
    named = [
        F.coalesce(F.get("lines", F.lit(i)), F.lit("")).alias(name)
        for i, name in enumerate(BRONZE_TEXT_COLUMNS)
    ]
    return cards.select(
        *keep, *named, F.col("id").cast("bigint").alias("id"), batch_time(as_of).alias("data_coleta")
    )


def cap_per_source(
    cards: DataFrame,
    limit: int,
    position: Sequence[str] = ("position",),
    source: str = "source",
) -> DataFrame:
    """The first `limit` cards of every source, in page order; cards without a source are one of them.

    No source is sorted. Cards are counted per source and bucket of their place, which tells the bucket
    that the limit falls in; later buckets are filtered out, and what is left (`limit` cards and that
    bucket) is ranked in ranges, by as many tasks as it needs.
    """
    name = F.when(F.col(source).isNotNull(), F.concat(F.lit("="), F.col(source).cast("string")))
    placed = cards.withColumns({
        "_source": F.coalesce(name, F.lit("")), "_bucket": place_bucket(cards, position[0]),
    })
    counts = placed.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_source").orderBy("_bucket")
    near = (
        counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        .where(F.col("_before") < limit).select("_source", "_bucket")
    )
    candidates = stored(placed.join(near, ["_source", "_bucket"]), "candidates")
    return ranks(candidates, position, ["_source"]).where(F.col("rank") < limit).select(*cards.columns)


def cap_overall(cards: DataFrame, limit: int, position: Sequence[str] = ("position",)) -> DataFrame:
    """The first `limit` cards of the whole collection."""
    return cards.orderBy(*position).limit(limit)


def union_sources(batches: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
