import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from texts import documents, prose  # noqa: F401

from vitrine.llm.common import written

COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def passed(spark, folder):
    """What goes into each stage and what it returns."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, folder), name)
        out[name] = (docs, after)
        docs = after
    return out


def test_columns_and_identifiers(passed):
    for name, (before, after) in passed.items():
        if name != "best_fit_packing":
            assert after.columns == COLUMNS
            assert after.where("n_chars <> length(text)").count() == 0
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0 or name == "best_fit_packing"


def test_decisions_take_effect(passed, spark, folder):
    before, after = passed["quality_rules"]
    assert after.where("size(split(trim(text), '\\\\s+')) < 50").count() == 0 and after.count() < before.count()
    before, after = passed["simhash_near_dedup"]
    assert after.count() == after.select(F.lower("text")).distinct().count() <= before.count()
    before, after = passed["substring_dedup"]
    assert after.count() == before.count()
    before, after = passed["best_fit_packing"]
    assert after.select("doc_id").distinct().count() == before.count()


def test_planted_cases(spark, documents, prose, folder):
    """Exact and near copies, a shared passage and junk go; clean documents stay as they are."""
    clean = prose(30, 120, seed=21, vocabulary=5000)
    passage = prose(1, 60, seed=22, vocabulary=5000)[0]
    # A near copy that differs in case and spaces has the fingerprint of its original.
    word = [w.encode().upper().decode() for w in clean[3].split()]
    rows = [(i, t) for i, t in enumerate(clean)] + [(50, clean[0]), (51, "\n".join(word)), (52, "### $$$ " * 60), (53, None), (54, "too short")]
    rows += [(60 + i, f"{a}\n{passage}\n{b}") for i, (a, b) in enumerate(zip(prose(6, 80, seed=23, vocabulary=5000), prose(6, 80, seed=24, vocabulary=5000)))]
    docs = documents(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), "planted")
    got = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == {*range(30), *range(60, 66)}
    assert all(got[i] == t for i, t in enumerate(clean))
    assert all(passage not in got[60 + i] and len(got[60 + i].split()) == 160 for i in range(6))


def test_extra_columns_and_repeated_rows(spark, documents, prose, folder):
    texts = prose(3, 120, seed=31, vocabulary=5000)
    docs = documents([(1, texts[0]), (1, texts[0]), (2, texts[0]), (3, texts[1]), (None, texts[2]), (4, None)])
    for name in ("_id", "root", "kept", "stripped", "words", "part", "fp"):
        docs = docs.withColumn(name, F.lit(7))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS, name
        kept = [r["doc_id"] for r in out.collect()]
        want = {"quality_rules": [1, 1, 2, 3, None], "simhash_near_dedup": [1, 3, 4, None]}.get(name, [1, 1, 2, 3, 4, None])
        assert sorted(map(str, kept)) == sorted(map(str, want)), name
    assert corpus_pipeline.pack_sequences(spark, docs, folder).count() == 6


def test_empty_and_null_rows(spark, documents, folder):
    for rows in ([], [(None, None), (None, None), (1, None)]):
        docs = documents(rows)
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = written(stage(spark, docs, folder), name)
        assert docs.count() <= len(rows)
    assert corpus_pipeline.drop_low_quality(spark, documents([]), folder).count() == 0
