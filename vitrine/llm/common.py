"""What the operators share: shared folder, written steps, native text expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines of the cluster share (`spark.checkpoint.dir`).

    Only where a local session (tests, a trial) names none a temporary folder is made and set; on a
    cluster a folder of one machine would lose what is written, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="vitrine-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and whole after a lost executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A plain projection would be pasted into the lambda functions that read it and computed again
    for each element; a generated row is not.
    """
    names = list(columns)
    made = df.withColumn("_row", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
    return made.select(*[F.col(f"`{c}`") for c in df.columns if c not in names],
                       *[F.col("_row")[n].alias(n) for n in names])


def numbered(df: DataFrame) -> list[Column]:
    """The columns of a table under the names c0, c1, ...: apart from any name an operator adds."""
    return [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]


def restored(df: DataFrame) -> list[Column]:
    """The same columns under their own names."""
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)]


def words(text: Column) -> Column:
    """Words of a text as an array; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def second_sum(text: Column) -> Column:
    """A checksum of a text that is independent of the plain one: both together tell texts apart."""
    return F.xxhash64(F.lit(1), text)


def row_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`_id, _text, _sum`: identifier, text (null: empty) and a checksum of the text.

    Identifier and checksum together name a row: rows that repeat both are the same row twice and
    get the same result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_sum"))
