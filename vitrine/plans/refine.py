"""A whole run: raw cards to Bronze, Silver and Gold, coordinates, audit, exports."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators import bronze, demand, fleet, geo, gold, predict, quality, runlog, silver
from vitrine.schemas import GEO_CACHE
from vitrine.session import shared_folder
from vitrine.sources import layers


@dataclass
class Run:
    """Frames of one run; nothing is computed until a frame is written."""

    bronze: DataFrame
    validation: DataFrame
    silver: DataFrame
    gold: DataFrame
    pending: DataFrame


def refine(
    cards: DataFrame, as_of: datetime, cache: DataFrame, gazetteer: DataFrame | None = None,
    seconds: float | None = None, memory_mb: float | None = None, **cleaning,
) -> Run:
    """Gold is cleaned once and gets its coordinates last. Places the cache lacks are resolved
    against the gazetteer, if one is given."""
    listings = silver.build(cards, as_of)
    cleaned = gold.build(listings, **cleaning)
    missing = geo.pending(cleaned, cache)
    known = geo.upsert(cache, geo.resolve(missing, gazetteer)) if gazetteer is not None else cache
    placed = geo.enrich(cleaned, known)
    return Run(
        bronze=bronze.from_cards(cards, as_of),
        validation=quality.validate_cards(cards),
        silver=listings,
        gold=runlog.with_audit(placed, seconds, memory_mb, as_of),
        pending=missing,
    )


def save(run: Run, root: str, at: datetime) -> None:
    """Snapshots of the three layers, and the export that each run replaces."""
    layers.append_snapshot(run.bronze, root, "bronze", at)
    layers.append_snapshot(run.silver, root, "silver", at)
    layers.append_snapshot(run.gold, root, "gold", at)
    spark = run.gold.sparkSession
    # From the written snapshot, so the run is not computed a second time.
    layers.replace_latest(layers.latest_snapshot(spark, root, "gold").drop("run_ts"), f"{root}/gold_final")


def complete(
    cards: DataFrame, root: str, at: datetime, as_of: datetime, gazetteer: DataFrame | None = None,
    seconds: float | None = None, memory_mb: float | None = None, **cleaning,
) -> DataFrame:
    """A run as it is kept: every layer is written once and read back for the next, resolved places
    join the cache, and the run closes with a row about itself.

    Below `root`: snapshots of bronze, silver, gold, the place cache (`geo_cache`) and the closing
    row (`run_summary`), and the export `gold_final`. The closing row has the quality report, the
    price target, coordinate coverage, and how many places the newest earlier Gold lacks, with the
    first five of them. Running again with the same stamp replaces the run's own snapshots.
    """
    spark = cards.sparkSession
    stamp = at.strftime(layers.STAMP)

    def kept(df: DataFrame, layer: str) -> DataFrame:
        layers.append_snapshot(df, root, layer, at)
        return layers.snapshot(spark, root, layer, stamp)

    earlier = {layer: [r for r in layers.runs(spark, root, layer) if r < stamp] for layer in ("gold", "geo_cache")}
    kept(bronze.from_cards(cards, as_of), "bronze")
    cleaned = kept(gold.build(kept(silver.build(cards, as_of), "silver"), **cleaning), "gold_cleaned")
    cache = (layers.snapshot(spark, root, "geo_cache", earlier["geo_cache"][-1]) if earlier["geo_cache"]
             else spark.createDataFrame([], GEO_CACHE))
    if gazetteer is not None:
        cache = geo.upsert(cache, geo.resolve(geo.pending(cleaned, cache), gazetteer))
    cache = kept(cache.select(*GEO_CACHE.fieldNames()), "geo_cache")
    final = kept(runlog.with_audit(geo.enrich(cleaned, cache), seconds, memory_mb, as_of), "gold")
    layers.replace_latest(final, f"{root}/gold_final")

    places = final.select("localizacao").where("localizacao is not null")
    if earlier["gold"]:
        places = quality.new_values(places, layers.snapshot(spark, root, "gold", earlier["gold"][-1]))
    places = places.distinct()
    first = places.orderBy("localizacao").limit(5).agg(F.sort_array(F.collect_list("localizacao"))).scalar()
    found = quality.report(final).select("*", F.struct(*[quality.coords(final).select(c).scalar().alias(c) for c in (
        "com_coordenadas", "sem_latitude")]).alias("c")).select(
        "*", "c.*", places.agg(F.count(F.lit(1))).scalar().alias("locais_novos"), first.alias("primeiros_locais_novos"))
    met = F.col("perc_preco") >= quality.PRICE_TARGET
    return kept(found.drop("c").withColumns({"sla_alvo": F.lit(float(quality.PRICE_TARGET)), "sla_atendido": met}), "run_summary")


def predictions(
    gold_rows: DataFrame, finished: datetime, key: tuple[str, ...] = ("id",), unit: str = "day",
    rounds: int = 100,
) -> DataFrame:
    """Gold with predicted age, health score and the next period's demand.

    Codes, training, metrics, scores and the series all read Gold: it is written once and read back.
    """
    path = f"{shared_folder(gold_rows.sparkSession)}/gold-{uuid.uuid4().hex}"
    gold_rows.write.parquet(path)
    gold_rows = gold_rows.sparkSession.read.schema(gold_rows.schema).parquet(path)
    model, metrics = fleet.train(gold_rows, key, rounds=rounds)
    scored = model.score(gold_rows, "Aging_Predicted")
    forecast = demand.forecast(demand.series(gold_rows, unit=unit))
    return predict.table(scored, forecast, metrics, finished)
