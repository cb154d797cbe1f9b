"""Run facts: audit columns, and the time between a run's checkpoints."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.joins import lookup_join
from vitrine.operators.ordered import with_previous

STAMP = "%d/%m/%Y %H:%M:%S"


def with_audit(
    df: DataFrame, seconds: float | None, memory_mb: float | None, finished: datetime
) -> DataFrame:
    """Elapsed time, memory and stamp of the run on every row; values come from the caller."""
    def rounded(value):
        return F.lit(None if value is None else round(float(value), 2)).cast("double")

    return df.withColumns({
        "execucao_tempo_seg": rounded(seconds),
        "execucao_memoria_mb": rounded(memory_mb),
        "execucao_data_hora": F.lit(finished.strftime(STAMP)),
    })


def stage_durations(checkpoints: DataFrame, runs: DataFrame, parts: int | None = None) -> DataFrame:
    """Seconds between consecutive checkpoints of a run.

    `checkpoints(run, seq, name, ts)` in time order (`seq` breaks ties), `runs(run, start, end)`.
    The first stage counts from the start, and a last one leads to the end. One run may hold all
    checkpoints: they are dealt into ranges of time, and the last one of a range is carried to the next.
    """
    point = F.struct("ts", "seq", "name")
    rows, last = with_previous(checkpoints.select("run", "seq", "name", "ts"), ["ts", "seq"], ["run"], point, parts)
    closing = last.select(
        "run", F.lit(None).cast("bigint").alias("seq"), F.lit("fim").alias("name"),
        F.lit(None).cast(checkpoints.schema["ts"].dataType).alias("ts"), F.col("_last").alias("_previous"),
    )
    stages = rows.select("run", "seq", "name", "ts", "_previous")
    label = F.concat(
        F.coalesce(F.col("_previous.name"), F.lit("inicio")), F.lit(" → "), F.col("name")
    )
    micros = F.timestamp_diff(
        "MICROSECOND", F.coalesce("_previous.ts", "start"), F.coalesce("ts", "end")
    )
    return (
        lookup_join(stages.unionByName(closing), runs, ["run"], "inner")
        .where(F.col("ts").isNotNull() | F.col("end").isNotNull())
        .select("run", "seq", label.alias("stage"), (micros / F.lit(1000000.0)).alias("seconds"))
    )
