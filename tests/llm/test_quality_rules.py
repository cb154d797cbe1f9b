import plain
from pyspark.sql import functions as F
from texts import documents  # noqa: F401

from vitrine.llm import quality_rules
from vitrine.llm.catalog import QUERIES

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in BASE) for r in QUERIES["op10_quality_rules"](spark, folder).collect()}
    assert got == {r["doc_id"]: plain.base_statistics(r["text"]) for r in docs.select("doc_id", "text").collect()}


def test_edges(documents):
    texts = [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a", "x\nx\n\n \n \nx ", "€ $ <|>\x0b#", "ab ab " * 30_000, "a\x1cb\u00a0c"]
    df = documents([*enumerate(texts), (None, "x y"), (3, "a")]).withColumn("n_words", F.lit(-1)).withColumn("rule", F.lit(0))
    got = quality_rules.judge(df, []).collect()
    want = [plain.base_statistics(t) for t in [*texts, "x y", "a"]]
    assert sorted(tuple(r[c] for c in BASE) for r in got) == sorted(want)
    assert not any(r["kept"] for r in got)
    assert quality_rules.judge(df.limit(0), []).count() == 0


def test_list_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rules = quality_rules.learn(quality_rules.labelled_statistics(docs, labels.where("doc_id % 2 = 0")))
    assert rules
    held = quality_rules.judge(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").cache()
    good, bad = held.where("quality = 1"), held.where("quality = 0")
    assert good.where("not kept").count() <= 0.01 * good.count()
    assert bad.where("not kept").count() >= 0.9 * bad.count()
    held.unpersist()


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "a b c")])
    labels = spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")
    assert quality_rules.learn(quality_rules.labelled_statistics(docs, labels)) == []
    assert quality_rules.learn(quality_rules.labelled_statistics(docs, labels.limit(0))) == []


def test_verdict_is_ordered(spark):
    first = (quality_rules.Threshold("a", True, 5.0),)
    second = (quality_rules.Threshold("a", True, 1.0), quality_rules.Threshold("b", False, 2.0))
    rows = spark.createDataFrame([(6.0, 0.0), (2.0, 0.0), (2.0, 9.0), (None, None)], "a double, b double")
    got = [r[0] for r in rows.select(quality_rules.verdict([first, second])).collect()]
    assert got == ["a >= 5", "a >= 1 and b < 2", None, None]


def test_long_text_keeps_whole_hashes(documents):
    """The hashes of (a b v3659405) and (a b v13253765) agree in their low 44 bits, all that was left at this length."""
    text = " ".join(["a b v3659405 a b v13253765", *(f"w{i}" for i in range(600_000))])
    assert quality_rules.statistics(documents([(1, text)])).first()["n_repeat_words"] == 0
