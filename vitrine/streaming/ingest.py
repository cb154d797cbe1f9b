"""Continuous refinement: the batch expressions over cards as their files arrive.

Bronze, Silver and Gold are row-local, so they run on a stream unchanged: no state, no
watermark. Each card is refined once; the sink's checkpoint keeps it so after a restart.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators import gold, silver
from vitrine.schemas import CARDS


def arriving_cards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(CARDS).parquet(folder)


def refine(cards: DataFrame, as_of: datetime) -> DataFrame:
    return gold.build(silver.build(cards, as_of))


def start(gold_rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet folder, then stop."""
    return (
        gold_rows.writeStream.format("parquet").option("path", folder)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
