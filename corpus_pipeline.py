"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage returns as
Parquet in the shared folder and reads it again as the next one's documents. All stages but the last
return the columns of `documents`, with `n_chars` brought up to date where the text changed.

Every stage takes any table with these columns. A null text counts as empty and stays null; rows with a
null identifier are rows like others; repeated rows are documents each, until the SimHash stage keeps
one of them; an empty table gives an empty table; columns beside those of `documents` are not carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import line_frequency, packing, quality_rules, repeats, simhash
from vitrine.llm.common import count_words, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(df: DataFrame, text) -> DataFrame:
    kept = df.withColumn("text", F.when(F.col("text").isNotNull(), text))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and that no learned rule names; a null or blank text fails the base rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learn(quality_rules.labelled_statistics(docs, labels))
    return quality_rules.judge(docs, rules, keep=tuple(COLUMNS)).where("kept").select(*COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many documents of their source contain; none goes, a null source is a source."""
    found = line_frequency.strip_lines(docs.select(*COLUMNS), F.col("source"), F.col("text"))
    return _with_text(found, F.col("_kept_text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints over three words, linked at two differing bits or fewer: the
    one with the smallest identifier, a null one only if there is no other. Texts without words are one component."""
    return simhash.keep_one(docs.select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words inside passages that occur twice or more; a document may end up empty and stays."""
    found = repeats.strip_repeats(docs.select(*COLUMNS))
    return _with_text(found, F.col("stripped.kept_text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin and slot of every piece of every document, in words; ties go to the smaller identifier, and a
    document without words is a piece of size 0."""
    copies = F.xxhash64(F.lower(F.coalesce("text", F.lit(""))))
    found = packing.pack(docs, "doc_id", count_words(F.col("text")), F.col("source"), copies)
    return found.withColumnsRenamed({"_id": "doc_id", "first_unit": "first_word", "size": "n_words"})


STAGES = [
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the learned rules, the fingerprints' components and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
