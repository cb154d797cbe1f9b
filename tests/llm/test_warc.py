import hashlib

from pyspark.sql import functions as F

from vitrine.llm import warc
from vitrine.llm.common import new_path


def archive(spark, df, **options):
    folder = new_path(spark, "warc-test")
    warc.write(df, folder, **options)
    return folder


def summary(spark, folder):
    rows = warc.read(spark, folder).select(
        warc.header("X-Page").alias("page"), warc.header("WARC-Type").alias("type"), warc.header("X-Refers-To-Page").alias("refers"),
        F.octet_length("payload").alias("n")).collect()
    return sorted(((r["page"], r["type"], r["refers"], r["n"]) for r in rows), key=str)


def test_edges(spark):
    long, other = "é" * 50, "x" * 99
    rows = [(5, "u", long), (3, "u", long), (9, None, long), (1, "u", other), (2, "u", other), (4, "a\r\nX-Page: 7", None), (6, "", ""),
            (None, "u", long), (8, "u", "only"), (3, "u", long), (None, "u", "n" * 200), (None, "u", "n" * 200), (10, "u", "y" * 5_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("d")).withColumn("first", F.lit(0))
    got = summary(spark, archive(spark, df))
    assert got == sorted([
        ("5", "revisit", "3", 100), ("3", "response", None, 100), ("3", "response", None, 100), ("9", "revisit", "3", 100), (None, "revisit", "3", 100),
        ("1", "response", None, 99), ("2", "response", None, 99), ("4", "response", None, 0), ("6", "response", None, 0), ("8", "response", None, 4),
        (None, "response", None, 200), (None, "response", None, 200), ("10", "response", None, 5_000_000)], key=str)
    assert summary(spark, archive(spark, df.limit(0))) == []


def test_payloads_are_stored_once_and_records_come_back_whole(spark):
    df = spark.createDataFrame([(i, f"http://h/{i}", "same " * 40 if i % 3 else f"own {i} " * 30) for i in range(60)],
                               "page_id long, url string, html string")
    folder = archive(spark, df)
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == 21
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["digest"] for r in stored.collect())
    html = {r["page_id"]: r["html"].encode() for r in df.collect()}
    blocks = {bytes(r["headers"]) for r in spark.read.parquet(f"{folder}/headers").collect()}
    for r in warc.read(spark, folder).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        page = int(fields[b"X-Page"])
        body = b"" if fields[b"WARC-Type"] == b"revisit" else html[page]
        assert bytes(r["payload"]) == html[page] and rest == body + b"\r\n\r\n" and int(fields[b"Content-Length"]) == len(body)
        assert head + b"\r\n\r\n" in blocks


def test_marks_that_end_lines_elsewhere_forge_no_field(spark):
    marks = ["\u2028", "\u2029", "\u0085", "\x0b", "\x0c", "\r", "\n", "\x1c"]
    rows = [(i, f"http://a/{m}X-Page: 777{m}WARC-Type: revisit{m}X-Refers-To-Page: 5{m}", "p" * 200 if i > 3 else f"own {i}") for i, m in enumerate(marks)]
    folder = archive(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert summary(spark, folder) == [(str(i), "revisit" if i > 4 else "response", "4" if i > 4 else None, 200 if i > 3 else 5) for i in range(len(marks))]
    urls = {r["page"]: r["url"] for r in warc.read(spark, folder).select(
        warc.header("X-Page").alias("page"), warc.header("WARC-Target-URI").alias("url")).collect()}
    assert urls == {str(i): u.replace("\r", "").replace("\n", "") for i, u, _ in rows}


def test_writing_again_changes_nothing(spark):
    df = spark.createDataFrame([(1, "u", "a" * 200), (2, "u", "a" * 200)], "page_id long, url string, html string")
    folder = archive(spark, df)
    before = summary(spark, folder)
    warc.write(df, folder)
    assert summary(spark, folder) == before
