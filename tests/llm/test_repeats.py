import random

import plain
import pytest
from pyspark.sql import functions as F
from texts import documents, prose  # noqa: F401

from vitrine.llm import repeats
from vitrine.llm.catalog import QUERIES


def digests(df):
    rows = df.select("doc_id", "stripped.n_words", "stripped.n_removed", F.sha2(F.col("stripped.kept_text").cast("binary"), 256)).collect()
    return sorted(map(tuple, rows), key=str)


def test_query_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op6_suffix_tree_repeats"](spark, folder).collect()))
    assert got == sorted(plain.repeats(rows))


@pytest.mark.parametrize("group_rows", [3, 4_000])
def test_edges_and_split_groups(documents, prose, group_rows):
    passage = prose(1, 50, seed=4)[0]
    texts = prose(30, 120, seed=5)
    rng = random.Random(1)
    rows = [(i, f"{t[:rng.randrange(200)]} {passage}\n{t}" if i % 2 else t) for i, t in enumerate(texts)]
    rows += [(100, None), (101, ""), (102, "one two"), (103, "tick " * 80), (104, passage.upper()), (None, texts[3]), (3, rows[3][1]),
             (105, " ".join(passage.split()[:34])), (106, " ".join(passage.split()[:35])), (107, "\t".join(passage.split())), (108, texts[0] * 40)]
    got = digests(repeats.strip_repeats(documents(rows), spacing=False, group_rows=group_rows))
    assert got == sorted(plain.repeats(rows), key=str)


def test_spacing_and_columns(documents, prose):
    passage, one, two = prose(3, 60, seed=9)
    df = documents([(1, f" {one}\n\n{passage}\n{one[:9]}"), (2, f"{passage}  {two}\n"), (3, None)])
    df = df.withColumn("runs", F.lit(1)).withColumn("_id", F.lit(2)).withColumn("c0", F.lit("x"))
    out = repeats.strip_repeats(df)
    assert out.columns == [*df.columns, "stripped"]
    texts = {r["doc_id"]: r["stripped"]["kept_text"] for r in out.collect()}
    assert texts == {1: f" {one}\n\n{one[:9]}", 2: f"{two}\n", 3: ""}
    assert repeats.strip_repeats(df.limit(0)).count() == 0


def test_exact_copies_do_not_make_a_large_group(documents, prose):
    """Thousands of equal texts, some under one identifier, come as one text."""
    text, other = prose(2, 60, seed=12)
    rows = [(i // 2, text) for i in range(3_000)] + [(9_000, f"{other} {text}"), (9_001, "few words"), (9_002, "few words"), (None, text)]
    df = documents(rows)
    keyed = repeats.row_keys(df, "doc_id", "text")
    texts = repeats.distinct_texts(keyed, repeats.copied_texts(keyed))
    made = repeats.suffixes(texts, 35, 100)
    assert texts.count() == 3 and made.groupBy("prefix", "part").count().agg(F.max("count")).first()[0] <= 2
    assert digests(repeats.strip_repeats(df, spacing=False, group_rows=100)) == sorted(plain.repeats(rows), key=str)
