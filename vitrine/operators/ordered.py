"""Order over a whole table: range partitions, and what one hands to the next.

Rows are dealt into ranges by sampled split points, so equal work goes to every task however often a
key occurs, and each range is written with its number. What lies before a range is known from one row
per range (and key). That gives global ranks, and neighbours across the edges, without a group in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import shared_folder

RANGE = "_range"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, however often they are read."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranges(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows with the number of their range in the given order, as a table in the shared folder.

    Ranges are disjoint but for equal rows of the order, which lie in one. The split points are
    drawn once, and the table holds what came of them, so all that reads it agrees.
    """
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return stored(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def ranks(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """The rows with `rank`, from 0, in the order inside each key; rows with a null key are left out."""
    dealt = ranges(df, [*keys, *order], parts)
    sizes = dealt.groupBy(*keys, RANGE).agg(F.count(F.lit(1)).alias("_n"))
    # One row per key and range that holds it.
    before = Window.partitionBy(*([*keys] or [F.lit(0)])).orderBy(RANGE)
    starts = sizes.select(*keys, RANGE, (F.sum("_n").over(before) - F.col("_n")).alias("_start"))
    inside = Window.partitionBy(*keys, RANGE).orderBy(*order)
    placed = dealt.withColumn("_at", F.row_number().over(inside) - 1).join(starts, [*keys, RANGE])
    return placed.withColumn("rank", F.col("_start") + F.col("_at")).drop("_start", "_at", RANGE)


def with_previous(df: DataFrame, order: Sequence[str], keys: Sequence[str], point: Column, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows with `_previous`, the `point` of the row before in the order inside a key (null for the first);
    and `keys, _last`, the point of the last row of each key. Rows with a null key are left out."""
    dealt = ranges(df, [*keys, *order], parts)
    inside = Window.partitionBy(*keys, RANGE).orderBy(*order)
    marked = dealt.withColumns({"_inside": F.lag(point).over(inside), "_at": F.row_number().over(inside)})
    place = F.struct(*order)
    ends = dealt.groupBy(*keys, RANGE).agg(F.max(F.struct(place, point.alias("point"))).getField("point").alias("_end"))
    carried = ends.select(*keys, RANGE, F.lag("_end").over(Window.partitionBy(*keys).orderBy(RANGE)).alias("_carried"))
    joined = marked.join(carried, [*keys, RANGE])
    rows = joined.withColumn("_previous", F.when(F.col("_at") > 1, F.col("_inside")).otherwise(F.col("_carried")))
    last = ends.groupBy(*keys).agg(F.max_by("_end", RANGE).alias("_last"))
    return rows.select(*df.columns, "_previous"), last
