from pyspark.sql import functions as F
from texts import documents  # noqa: F401

from vitrine.llm import line_frequency


def strip(df, **options):
    out = line_frequency.strip_lines(df, F.col("source"), F.col("text"), **options)
    return {r["doc_id"]: (r["_kept_text"], r["_n_lines"], r["_n_dropped"]) for r in out.collect()}


def test_ratio_is_of_the_host(documents):
    rows = [(i, f"menu\nbody {i}", "a") for i in range(8)] + [(i, f"menu \n\nbody {i}" if i < 12 else f"x{i}", "b") for i in range(8, 40)]
    got = strip(documents(rows), ratio=0.2)
    assert got[3] == ("body 3", 2, 1)
    assert got[9] == ("menu \n\nbody 9", 3, 0)  # 4 of 32 pages of that host


def test_copies_of_a_page_count_once(documents):
    rows = [(i, "whole page\nsecond line", "a") for i in range(20)] + [(20 + i, f"p{i}", "a") for i in range(10)]
    assert strip(documents(rows))[0] == ("whole page\nsecond line", 2, 0)


def test_copies_of_a_page_are_pages(documents):
    rows = [(i, "whole page\nsecond line", "a") for i in range(20)] + [(20 + i, f"p{i}\n\np{i}", "a") for i in range(10)]
    got = strip(documents(rows), distinct_pages=False, ratio=0.5)
    assert got[0] == ("", 2, 2) and got[25] == ("p5\n\np5", 3, 0)
    assert strip(documents(rows), distinct_pages=False, ratio=0.7)[0] == ("whole page\nsecond line", 2, 0)


def test_text_of_a_page(spark):
    page = ("<!DOCTYPE html><HEAD><title>t &amp; u</title><style>p{}\n</style><script>var a='<p>';</script></HEAD><body>"
            "<nav><ul><li><a href='/x'>x</a></li></ul></nav><!-- no\n<p> --><article><p class='a\nb'>one <b>two</b><br/>three<pre>four")
    df = spark.createDataFrame([(page,), (None,), ("",), ("plain\ntext",), ("<p" * 30_000,)], "html string")
    got = [r[0] for r in df.select(line_frequency.text_of(F.col("html"))).collect()]
    assert [x for x in got[0].split("\n") if x] == ["t &amp; u", "x", "one two", "threefour"]
    assert got[1:4] == [None, "", "plain\ntext"] and len(got[4]) == 60_000


def test_edges(documents):
    rows = [(i, "foot\n\n  \nbody %d" % i, None) for i in range(9)] + [(10, None, None), (11, "", "a"), (None, "foot", None), (0, "foot\n\n  \nbody 0", None),
                                                                      (12, "long\n" * 100_000, "a"), (13, "foot", "")]
    df = documents(rows, source=None).withColumn("_host_key", F.lit(1)).withColumn("lines", F.lit(2)).withColumn("_drop", F.lit(2))
    got = strip(df)
    assert got[0] == ("\n  \nbody 0", 4, 1) and got[10] == ("", 1, 0) and got[11] == ("", 1, 0) and got[None] == ("", 1, 1)
    assert got[12][1:] == (100_001, 0) and got[13] == ("foot", 1, 0)
    assert line_frequency.strip_lines(df.limit(0), F.col("source"), F.col("text")).count() == 0
    assert line_frequency.strip_lines(df, F.col("source"), F.col("text"), prefix="k_").columns[: len(df.columns)] == df.columns


def test_host(spark):
    df = spark.createDataFrame([("https://A.b.C/d?x://y",), ("http://h",), ("no host",), (None,)], "u string")
    assert [r[0] for r in df.select(line_frequency.host_of(F.col("u"))).collect()] == ["a.b.c", "h", None, None]
