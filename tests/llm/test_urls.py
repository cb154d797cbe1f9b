import math

import plain
import pytest
from pyspark.sql import functions as F

from vitrine.llm import url_labels, urls
from vitrine.llm.catalog import QUERIES, URL_RULES

RULES = [(r.verdict, r.host, r.path) for r in URL_RULES]
ADDRESSES = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://sub.example.ORG/en/12?x#y", "http://badexample.org/es/", "http://org/", "http://org",
    "http://a.com/fr/", "http://a.com/de/x", "http://a.com?/de/", "http://a.com#/de/", "ftp://x.com/fr/y://z", "://h/p", "http://ÄB.org/", "http://a.com/" + "de/" * 40_000,
    "http://a.com/de", "http://com/de/\nline", "a://b\nc.org/x",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([*enumerate(ADDRESSES), (3, ADDRESSES[3]), (None, "http://x.org/")], "page_id int, url string")
    df = df.withColumn("host", F.lit(1)).withColumn("verdict", F.lit(1)).withColumn("_rule", F.lit(1))
    got = urls.judge(df, URL_RULES, urls.Model((0.0,) * urls.BUCKETS, -1.0)).collect()
    assert len(got) == len(ADDRESSES) + 2
    for r in got:
        address = "http://x.org/" if r["page_id"] is None else ADDRESSES[r["page_id"]]
        host, path = plain.url_parts(address)
        rule, verdict = plain.url_rule(host, path, RULES)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


def test_score_is_the_sum_of_weights(spark):
    df = spark.createDataFrame([(1, "http://ab.c/d")], "page_id int, url string")
    host, path = urls.parts(F.col("url"))
    buckets = urls.with_buckets(df, host, path).first()["_buckets"]
    assert len(buckets) == 4 + 3 + 2 + 1 and all(0 <= b < urls.BUCKETS for b in buckets)
    model = urls.Model(tuple(math.sin(i) for i in range(urls.BUCKETS)), 0.5)
    score = urls.judge(df, [], model).first()["score"]
    assert score == pytest.approx(0.5 + sum(math.sin(b) for b in buckets))


def accuracy(judged):
    right, n = judged.agg(F.count_if((F.col("verdict") == "block") == F.col("blocked")), F.count("*")).first()
    return right / n


def test_held_out_accuracy(spark):
    """Addresses that are not in the labelled table, and pages that no rule decides."""
    labelled = url_labels.table(spark)
    assert labelled.count() <= urls.TRAIN_URLS
    model = urls.train(labelled)
    fresh = url_labels.table(spark, seed=1).join(labelled.select("url"), "url", "left_anti").distinct()
    judged = urls.judge(fresh.withColumn("page_id", F.lit(1)), [], model)
    marks = fresh.select(*[c.alias(n) for c, n in zip(urls.parts(F.col("url")), ("host", "path"))], "blocked").distinct()
    assert accuracy(judged.join(marks, ["host", "path"])) >= 0.97
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    undecided = urls.judge(pages, URL_RULES, model).where("rule is null")
    assert accuracy(undecided.withColumn("blocked", F.col("host").rlike("pills|casino"))) >= 0.97


def test_training_edges(spark):
    schema = "url string, blocked boolean"
    assert urls.train(spark.createDataFrame([], schema)).intercept == -1.0
    assert urls.train(spark.createDataFrame([("a://b", None)], schema)).intercept == -1.0
    assert urls.train(spark.createDataFrame([("a://b", True), (None, True)], schema)).intercept == 1.0
    assert QUERIES["op5_url_filter"](spark, "/root/testdata/sf0.001").columns == ["page_id", "host", "path", "rule", "verdict", "score"]
