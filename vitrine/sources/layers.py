"""Layer files: snapshots by run time, the latest export, delimited text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.sources import versions

STAMP = "%Y%m%d_%H%M%S"


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Delimited text with a header, typed by the schema: nothing is inferred."""
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("escape", '"').csv(path)
    )


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text with a header, every column a string, empty cells ''."""
    frame = (
        spark.read.option("header", True).option("inferSchema", False).option("multiLine", True)
        .option("escape", '"').csv(path)
    )
    return frame.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in frame.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """Delimited text with a header, UTF-8 (Spark writes no byte order mark)."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("encoding", "UTF-8").csv(path)
    )


def append_snapshot(df: DataFrame, root: str, layer: str, run: datetime) -> None:
    """Add a run to a layer; other runs stay as they are. A run written again replaces itself."""
    stamped = df.withColumn("run_ts", F.lit(run.strftime(STAMP)))
    (
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_ts").parquet(f"{root}/{layer}")
    )


def snapshots(spark: SparkSession, root: str, layer: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{layer}")


def latest(df: DataFrame, run: str = "run_ts") -> DataFrame:
    """Rows of the newest run. The newest name is a scalar subquery over the partition column,
    so only that run's files are read."""
    newest = df.select(F.max(run)).scalar()
    return df.where(F.col(run) == newest)


def snapshot(spark: SparkSession, root: str, layer: str, stamp: str) -> DataFrame:
    """Rows of one run of a layer, without the column that names the run."""
    return spark.read.option("basePath", f"{root}/{layer}").parquet(f"{root}/{layer}/run_ts={stamp}").drop("run_ts")


def runs(spark: SparkSession, root: str, layer: str) -> list[str]:
    """Names of the runs of a layer, oldest first, from its folders: no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{layer}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path) if status.isDirectory()]
    return sorted(name.partition("=")[2] for name in names if name.startswith("run_ts="))


def latest_snapshot(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Rows of the newest run of a layer; only its folder is read."""
    return snapshots(spark, root, layer).where(F.col("run_ts") == runs(spark, root, layer)[-1])


def replace_latest(df: DataFrame, root: str) -> None:
    """Export that each run replaces: a version of its own, swapped in when it is complete."""
    versions.replace(df, root)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The export as the last complete run left it."""
    return versions.read(spark, root)
