"""Content-addressed WARC archive.

A record is an exact header block and a payload. The archive keeps every header block in one table
and every different payload once in another, under its SHA-256; records are put together again by
a join on the digest. Both tables are Parquet in a folder that all machines share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Smaller payloads are never replaced by a reference.
LEAST_BYTES = 100
STAMP = "2024-01-01T00:00:00Z"
_END = "\r\n"


def _record_id(page: Column, digest: Column) -> Column:
    """A name-based record identifier; equal rows have equal identifiers."""
    text = F.sha2(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest), 256)
    parts = [F.substring(text, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _payload(column: str) -> Column:
    return F.coalesce(F.col(column).cast("binary"), F.lit(bytearray()))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            least_bytes: int = LEAST_BYTES) -> DataFrame:
    """`page, digest, type, refers, headers`: a WARC record of every row of `pages`, less its payload.

    Of rows with equal payloads of `least_bytes` or more, the one with the smallest identifier is a
    response and the others revisit it. Rows that share that identifier are all responses, and so
    are rows of a payload that comes with null identifiers only. A null payload is empty, a null
    URL an empty target. `headers` is the exact block in front of the payload, with the blank line.
    """
    payload = _payload(payload_col)
    page = pages.select(F.col(id_col).cast("long").alias("page"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    # Copies are counted before they are shuffled: one row per digest and task.
    firsts = page.where(F.col("size") >= least_bytes).groupBy(F.col("digest").alias("_digest")).agg(
        F.min("page").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    known = page.join(firsts, F.col("digest") == F.col("_digest"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    refers = F.when(revisit, F.col("first"))
    # Line ends inside a URL would end the header line.
    target = F.regexp_replace("url", r"[\r\n]", "")
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page"), F.col("digest"))), F.lit(f"WARC-Date: {STAMP}"),
        F.concat(F.lit("WARC-Target-URI: "), target), F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first"), F.col("digest")))),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page: "), F.col("first").cast("string"))),
        F.when(F.col("page").isNotNull(), F.concat(F.lit("X-Page: "), F.col("page").cast("string"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
    ]
    block = F.concat(F.concat_ws(_END, *lines), F.lit(_END + _END))
    return known.select("page", "digest", kind.alias("type"), refers.alias("refers"), block.cast("binary").alias("headers"))


def payloads(pages: DataFrame, payload_col: str = "html") -> DataFrame:
    """`digest, payload`: every different payload once. A digest under which two payloads differ is
    an error: a second checksum is compared over all copies."""
    payload = _payload(payload_col)
    rows = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"), F.xxhash64(payload).alias("check"))
    once = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("check").alias("low"), F.max("check").alias("high"))
    verified = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payloads differ under digest "), F.col("digest"))).cast("binary"))
    return once.select("digest", verified.alias("payload"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          least_bytes: int = LEAST_BYTES) -> None:
    """Store a record of every row: `headers` (one row each) and `payloads` (one row per digest)
    below `folder`. Writing again replaces the archive."""
    found = records(pages, id_col, url_col, payload_col, least_bytes)
    found.select("digest", "headers").write.mode("overwrite").parquet(f"{folder}/headers")
    payloads(pages, payload_col).write.mode("overwrite").parquet(f"{folder}/payloads")


def header(name: str) -> Column:
    """A field of the header block of a record; null if it has none.

    Only CR LF ends a header line: other marks that are line ends elsewhere (U+2028, U+2029, U+0085, a lone
    CR or LF) may stand inside a field.
    """
    text = F.col("headers").cast("string")
    found = F.regexp_extract(text, rf"\r\n{name}: ((?s:.*?))\r\n", 1)
    return F.when(F.regexp_like(text, F.lit(rf"\r\n{name}: ")), found)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """`headers, payload, record` of every record: `record` is the original's exact bytes (header
    block, payload unless it is a revisit, two line ends), `payload` the full payload also of a
    revisit. A payload that does not have the digest it is stored under is an error."""
    blocks = spark.read.parquet(f"{folder}/headers")
    stored = spark.read.parquet(f"{folder}/payloads").select(
        F.col("digest").alias("_digest"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("binary")).alias("payload"))
    joined = blocks.join(stored, F.col("digest") == F.col("_digest"), "left")
    body = F.when(header("WARC-Type") == "revisit", F.lit(bytearray())).otherwise(F.col("payload"))
    return joined.select("headers", "payload", F.concat(F.col("headers"), body, F.lit(bytearray(b"\r\n\r\n"))).alias("record"))
