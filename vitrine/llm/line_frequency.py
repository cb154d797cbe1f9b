"""Line dedup by site-relative frequency.

A line is boilerplate of a host if more than a given share of the host's pages contain it: pages with
the line, divided by all pages of the host. With `distinct_pages`, pages of a host with identical
text count once on both sides of the division, so copies of a page do not turn its content into
boilerplate (a pipeline that keeps one copy of each text later wants that).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import numbered, restored, written

RATIO = 0.1
LEAST_PAGES = 5
BLANKS = " \t\x0b\x0c\r"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null if there is none."""
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.lower(F.regexp_extract(rest, "^[^/?#]*", 0)))


#: Parts of a page that are no text, tags that end a line, and other tags.
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BLOCK = r"(?i)</?(p|br|li|ul|ol|h[1-6]|div|nav|article|section|header|footer|title|body|table|tr)([ /\t\n][^>]*)?>"
TAG = "<[^>]*>"


def text_of(html: Column) -> Column:
    """The text of a page, a line for each block; entities stay as they are. A null page stays null."""
    shown = F.regexp_replace(html, HIDDEN, "")
    return F.regexp_replace(F.regexp_replace(shown, BLOCK, "\n"), TAG, "")


def _host_key(host: Column) -> Column:
    return F.when(host.isNotNull(), F.concat(F.lit("="), host.cast("string"))).otherwise(F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(BLANKS)))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO,
                least_pages: int = LEAST_PAGES, distinct_pages: bool = True) -> DataFrame:
    """`host_key, line_hash, n_pages, n_total` of the lines above the ratio, as a written table.

    Lines are compared without blanks at their ends; blank lines are never boilerplate. Pages
    without a host form one group. A line must be on `least_pages` pages: on a host of fewer than
    1 / ratio pages every line is above the ratio, so the ratio alone would empty small hosts.
    """
    page = pages.select(_host_key(host).alias("host_key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_page"),
                        F.filter(_lines(text), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("_lines"))
    # A page gives each of its lines once; rows are summed before they are shuffled, so a common
    # line of a large host is no hot key.
    lines = F.explode(F.array_distinct(F.transform("_lines", _line_hash))).alias("line_hash")
    if distinct_pages:
        totals = page.select("host_key", "_page").distinct().groupBy("host_key").agg(F.count("*").alias("n_total"))
        hashes = page.select("host_key", "_page", lines).distinct()
    else:
        totals = page.groupBy("host_key").agg(F.count("*").alias("n_total"))
        hashes = page.select("host_key", lines)
    counts = hashes.groupBy("host_key", "line_hash").agg(F.count("*").alias("n_pages"))
    return written(
        counts.where(F.col("n_pages") >= least_pages).join(totals, "host_key").where(F.col("n_pages") > ratio * F.col("n_total")),
        "boilerplate")


def strip_lines(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO,
                least_pages: int = LEAST_PAGES, prefix: str = "_", distinct_pages: bool = True) -> DataFrame:
    """All rows and columns of `pages`, with `<prefix>kept_text`, `<prefix>n_lines` and
    `<prefix>n_dropped`; `prefix` keeps them apart from columns of the input.

    A host has at most (lines per page) / ratio lines above the ratio, so its list fits a row; the
    lists meet the pages by host, and Catalyst broadcasts the written table if its size allows.
    A null text gives an empty one. Repeated rows get equal results; an empty table gives none.
    """
    found = boilerplate(pages, host, text, ratio, least_pages, distinct_pages)
    lists = written(found.groupBy(F.col("host_key").alias("_host_key")).agg(F.collect_list("line_hash").alias("_drop")), "host_lists")
    # The generated row keeps the split of a text from being repeated by later expressions.
    split = F.explode(F.array(F.struct(_lines(text).alias("lines"), _host_key(host).alias("host"))))
    rows = pages.select(*numbered(pages), split.alias("_split"))
    rows = rows.join(lists, F.col("_split.host") == F.col("_host_key"), "left")
    known = F.coalesce("_drop", F.array().cast("array<bigint>"))
    kept = F.when(F.size(known) == 0, F.col("_split.lines")).otherwise(
        F.filter("_split.lines", lambda x: ~F.array_contains(known, _line_hash(x)) | (F.trim(x, F.lit(BLANKS)) == "")))
    rows = rows.withColumn("_kept", F.explode(F.array(kept)))
    return rows.select(*restored(pages), F.array_join("_kept", "\n").alias(f"{prefix}kept_text"),
                       F.size("_split.lines").cast("long").alias(f"{prefix}n_lines"),
                       (F.size("_split.lines") - F.size("_kept")).cast("long").alias(f"{prefix}n_dropped"))
