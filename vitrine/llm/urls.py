"""URL filter: rules, and logistic regression on hashed n-grams for what no rule decides.

Host and path are cut into character n-grams, each hashed into one of a fixed number of buckets.
The model is trained on a small labelled table of URLs and applied as a sum of weights by built-in
expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import staged

BUCKETS = 2_048
GRAMS = (3, 4)
#: Labelled URLs that the model is trained on: the bound of the sample.
TRAIN_URLS = 4_000


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains if the path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null or an address without `://`."""
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    found = F.instr(url, "://") > 0
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(found, host).otherwise(F.lit("")), F.when(found, path).otherwise(F.lit(""))


def matched(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (text, verdict); null if none does. Of equally long
    rules the one with the longer host wins, then the greater text."""
    fits = [F.when((host.endswith("." + r.host) | (host == r.host)) & path.startswith(r.path),
                   F.struct(F.lit(len(r.text)).alias("length"), F.lit(len(r.host)).alias("host_length"),
                            F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))) for r in rules]
    if not fits:
        return F.lit(None).cast("struct<length: int, host_length: int, text: string, verdict: string>")
    return F.array_max(F.array(*fits))


def _grams(text: str, kind: int, n: int, buckets: int) -> str:
    """Buckets of the n-grams of a column of single characters, with its ends marked."""
    return (f"transform(sequence(0, greatest(size({text}) - {n}, 0)), i -> cast(pmod(xxhash64({kind}, "
            f"concat_ws('', slice({text}, i + 1, {n}))), {buckets}) as int))")


def with_buckets(df: DataFrame, host: Column, path: Column, buckets: int = BUCKETS, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """Add `_buckets`, the bucket of every n-gram of host and path. One character at a time is
    split off once, so a very long address costs time in proportion to its length."""
    marked = [F.split(F.concat(F.lit("^"), c, F.lit("$")), "") for c in (host, path)]
    df = staged(df, _host_chars=marked[0], _path_chars=marked[1])
    every = ", ".join(_grams(c, k, n, buckets) for k, c in enumerate(("_host_chars", "_path_chars")) for n in grams)
    return staged(df, _buckets=F.expr(f"concat({every})")).drop("_host_chars", "_path_chars")


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    intercept: float

    def score(self, buckets: Column) -> Column:
        """Log-odds that a URL is to be blocked."""
        weights = F.array(*[F.lit(float(w)) for w in self.weights])
        return F.aggregate(buckets, F.lit(float(self.intercept)), lambda total, b: total + F.get(weights, b))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", rows: int = TRAIN_URLS,
          buckets: int = BUCKETS, grams: tuple[int, ...] = GRAMS, strength: float = 0.001) -> Model:
    """Fit the model on at most `rows` labelled URLs: those with the smallest hashes, so the sample
    repeats. Null labels are left out. With one kind of label only, the model always says it; with
    none it allows all."""
    sample = labelled.where(F.col(label_col).isNotNull()).select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label"))
    sample = sample.orderBy(F.xxhash64("url"), "url", "label").limit(rows)
    host, path = parts(F.col("url"))
    ready = with_buckets(sample, host, path, buckets, grams).select("label", F.col("_buckets").cast("array<string>").alias("_names")).coalesce(1)
    seen = ready.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return Model((0.0,) * buckets, 1.0 if seen[0] == 1.0 else -1.0)
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(buckets)], "_names", "features")
    fitted = LogisticRegression(maxIter=30, regParam=strength, standardization=False).fit(counter.transform(ready).select("label", "features"))
    return Model(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def judge(pages: DataFrame, rules: list[Rule], model: Model, id_col: str = "page_id", url_col: str = "url",
          buckets: int = BUCKETS, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """`<id>, host, path, rule, verdict, score` of every row: the rule's verdict, else the model's.

    Null addresses have empty host and path and are judged like others; repeated rows get equal
    results; columns beside identifier and address are not read.
    """
    host, path = parts(F.col("_url"))
    rows = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    rows = staged(rows, host=host, path=path).drop("_url")
    rows = with_buckets(rows, F.col("host"), F.col("path"), buckets, grams)
    rows = staged(rows, _rule=matched(F.col("host"), F.col("path"), rules), score=model.score(F.col("_buckets")))
    by_model = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(id_col, "host", "path", F.col("_rule.text").alias("rule"), F.coalesce("_rule.verdict", by_model).alias("verdict"), "score")
