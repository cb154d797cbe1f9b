"""Tables that are replaced as a whole and never seen half written.

A version is a folder of its own. Once it is complete, an empty file is made whose name holds a serial number
and the name of the version: readers take the highest number. Making that one file is the swap, so
a job that dies before it leaves the version before in place, on any file system.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTERS = "_pointers"


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, sorted; none if there is no such folder."""
    found, system = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def _pointers(spark: SparkSession, root: str) -> list[str]:
    return [n for n in listing(spark, f"{root}/{POINTERS}") if "-" in n]


def current(spark: SparkSession, root: str) -> str | None:
    """Folder of the version that readers see; None before the first."""
    found = _pointers(spark, root)
    return f"{root}/{found[-1].partition('-')[2]}" if found else None


def fresh(root: str) -> str:
    """A folder for a new version, which no reader sees until it is published."""
    return f"{root}/v{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folder: str) -> None:
    """Make a complete version the current one. Of two writers at once the later pointer wins."""
    found = _pointers(spark, root)
    number = int(found[-1].partition("-")[0]) + 1 if found else 1
    path, system = _at(spark, f"{root}/{POINTERS}/{number:012d}-{folder.rsplit('/', 1)[-1]}")
    system.create(path, True).close()


def replace(df: DataFrame, root: str) -> str:
    """Write the rows as the new current version."""
    folder = fresh(root)
    df.write.parquet(folder)
    publish(df.sparkSession, root, folder)
    return folder


def read(spark: SparkSession, root: str) -> DataFrame:
    folder = current(spark, root)
    if folder is None:
        raise FileNotFoundError(f"no version below {root}")
    return spark.read.parquet(folder)


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest published versions and what unfinished writers left; the names deleted.
    Readers that opened an older version lose it, and no writer may be at work."""
    pointers = _pointers(spark, root)
    kept = {p.partition("-")[2] for p in pointers[-max(keep, 1) :]}
    gone = [n for n in listing(spark, root) if n not in kept and n != POINTERS]
    for name in gone:
        path, system = _at(spark, f"{root}/{name}")
        system.delete(path, True)
    for name in pointers[: -max(keep, 1)]:
        path, system = _at(spark, f"{root}/{POINTERS}/{name}")
        system.delete(path, False)
    return gone
