"""A stored inverted index that grows, and ranking of many questions that leaves out what cannot win.

A collection is a set of segments. A document has a number of its own inside its segment; the caller's key is
only carried along, so keys may repeat. Adding documents writes a segment, deleting writes the numbers
that no longer count and what they take from the frequencies, merging writes the live documents as one
segment. The list of what counts is swapped last (`sources.versions`).

A segment has `documents(number, doc_id, length, tokens, tfs)`, and `postings` numbered in blocks: of a token's
documents, the ones it weighs most in come first. For the words asked, a block's highest term frequency and smallest
length are found, and the highest weight under its segment's average length. Both bound what it can add to a score
under any average length, the second by the ratio of the averages.

Ranking takes two rounds. The best block of every word asked gives first documents, whose exact scores
give each question a score that its k-th best document reaches at least. Words whose highest
weights do not reach it together need no postings at all, and of the others only blocks are read that could lift
a document above it. What is left is scored exactly, from the documents themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.functions.text import tokens
from vitrine.operators.retrieval import B, K1, idf, weight, words
from vitrine.sources import versions

BUCKETS = 64  # folders of a segment's postings; more for a larger collection
BLOCK = 128  # postings of a block
PART = 50_000  # postings of a token that one task orders; a more frequent token has several parts
SLICES = 64
TRIED = 8  # first documents of a question that are scored, for each that is asked for
SLACK = 1e-9  # rounding of sums: what is within it of the bound stays


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often they are used afterwards."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.withColumn("_made", made).select(*df.columns, *[f"_made.{n}" for n in columns])


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class TextIndex:
    """The state of an index below `root` when it was opened; `add`, `delete` and `merge` return the next."""

    spark: SparkSession
    root: str
    buckets: int
    segments: tuple[str, ...]
    deletions: tuple[str, ...]

    # ------------------------------------------------------------------------------- tables
    @staticmethod
    def load(spark: SparkSession, root: str) -> TextIndex:
        entries = versions.read(spark, f"{root}/manifest").collect()  # one row per segment or deletion
        named = {kind: tuple(sorted(r["name"] for r in entries if r["kind"] == kind)) for kind in ("segment", "deletion")}
        return TextIndex(spark, root, entries[0]["buckets"], named["segment"], named["deletion"])

    def _table(self, name: str, parts: Iterable[str], buckets: Iterable[int] | None = None) -> DataFrame:
        base = f"{self.root}/{name}"
        found = self.spark.read.option("basePath", base).parquet(*[f"{base}/segment={s}" for s in parts])
        return found if buckets is None else found.where(F.col("bucket").isin(*buckets))

    @property
    def documents(self) -> DataFrame:
        """`segment, number, doc_id, length, tokens, tfs` of the live documents."""
        found = self._table("documents", self.segments)
        if not self.deletions:
            return found
        gone = self._table("deleted", self.deletions).select(F.col("home").alias("segment"), "number")
        return found.join(gone, ["segment", "number"], "left_anti")

    def postings(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """`segment, bucket, token, part, block, number, tf, length`; deleted documents are still in them."""
        return self._table("postings", self.segments, buckets)

    def frequencies(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """`bucket, token, df` over the live documents."""
        ledger = self._table("frequencies", [*self.segments, *self.deletions], buckets)
        return ledger.groupBy("bucket", "token").agg(F.sum("df").alias("df")).where(F.col("df") > 0)

    def figures(self) -> DataFrame:
        """One row `n, average` over the live documents."""
        ledger = self._table("figures", [*self.segments, *self.deletions])
        sums = ledger.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("total").alias("total"))
        return sums.select("n", F.try_divide(F.col("total"), F.col("n")).alias("average"))

    # ------------------------------------------------------------------------------ changes
    def _published(self, segments: Iterable[str], deletions: Iterable[str]) -> TextIndex:
        entries = [("segment", s, self.buckets) for s in segments] + [("deletion", d, self.buckets) for d in deletions]
        rows = self.spark.createDataFrame(entries, "kind string, name string, buckets int")
        versions.replace(rows.coalesce(1), f"{self.root}/manifest")
        return TextIndex.load(self.spark, self.root)

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> TextIndex:
        """Documents more, as a segment of their own. Equal keys are documents each."""
        name = _write_segment(self, _counted(docs, doc_id, text))
        return self._published([*self.segments, name], self.deletions)

    def delete(self, keys: DataFrame, doc_id: str = "doc_id") -> TextIndex:
        """All live documents with one of the keys go."""
        name = _name()
        asked = keys.select(F.col(doc_id).alias("doc_id")).distinct()
        found = self.documents.join(asked, "doc_id", "left_semi").select(F.col("segment").alias("home"), "number", "length", "tokens")
        gone = f"{self.root}/deleted/segment={name}"
        found.write.parquet(gone)
        found = self.spark.read.parquet(gone)
        found.agg((-F.count(F.lit(1))).cast("long").alias("n"), (-F.coalesce(F.sum("length"), F.lit(0))).cast("long").alias("total")).write.parquet(
            f"{self.root}/figures/segment={name}")
        less = found.select(F.explode("tokens").alias("token")).groupBy("token").agg((-F.count(F.lit(1))).cast("long").alias("df"))
        _write_buckets(less.withColumn("bucket", _bucket(F.col("token"), self.buckets)), f"{self.root}/frequencies/segment={name}")
        return self._published(self.segments, [*self.deletions, name])

    def merge(self) -> TextIndex:
        """The live documents as one segment, without texts: the documents' own words are written anew."""
        live = self.documents.select("doc_id", "length", "tokens", "tfs")
        return self._published([_write_segment(self, live)], [])


def _name() -> str:
    """A random number of 62 bits: short as a key of the documents of a segment."""
    return str(uuid.uuid4().int >> 66)


def build_index(docs: DataFrame, root: str, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> TextIndex:
    """The index of a collection; one that stands below `root` is replaced when the new one is complete."""
    empty = TextIndex(docs.sparkSession, root, buckets, (), ())
    return empty._published([_write_segment(empty, _counted(docs, doc_id, text))], [])


def _counted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`doc_id, length, tokens, tfs`: the different words of each text in order, and how often each stands there."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    rows = _once(rows, _sorted=F.sort_array(F.coalesce(tokens(F.col("_text")), F.array().cast("array<string>"))))
    places = F.when(F.size("_sorted") > 0, F.sequence(F.lit(0), F.size("_sorted") - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(places, lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)))
    rows = _once(rows.drop("_text"), _first=first)
    upto = F.transform("_first", lambda s, i: F.coalesce(F.get("_first", i + 1), F.size("_sorted")) - s)
    return rows.select("doc_id", F.size("_sorted").alias("length"), F.transform("_first", lambda i: F.get("_sorted", i)).alias("tokens"), upto.alias("tfs"))


def _write_buckets(df: DataFrame, path: str) -> None:
    """Rows in folders by bucket, ordered by token. A frequent token fills its folder with several files:
    rows are rebalanced by size, not sent to one task per bucket."""
    df.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(path)


def _write_segment(index: TextIndex, counted: DataFrame) -> str:
    """Write documents, figures, frequencies and postings of a new segment; its name."""
    spark, root, name = index.spark, index.root, _name()
    home = f"{root}/documents/segment={name}"
    # Numbers are given as the table is written, and read back from there.
    counted.select(F.monotonically_increasing_id().alias("number"), "doc_id", "length", "tokens", "tfs").write.parquet(home)
    documents = spark.read.parquet(home)
    documents.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("total")).write.parquet(
        f"{root}/figures/segment={name}")
    pairs = documents.select("number", "length", F.explode(F.arrays_zip("tokens", "tfs")).alias("e")).select(
        F.col("e.tokens").alias("token"), "number", F.col("e.tfs").alias("tf"), "length")
    frequencies = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("df")).withColumn("bucket", _bucket(F.col("token"), index.buckets))
    _write_buckets(frequencies, f"{root}/frequencies/segment={name}")

    frequent = spark.read.schema("token string, df long, bucket int").parquet(f"{root}/frequencies/segment={name}").where(F.col("df") > PART)
    # At most one row for PART postings: small beside the postings.
    split = F.broadcast(frequent.select("token", F.ceil(F.col("df") / F.lit(PART)).cast("int").alias("_parts")))
    part = F.pmod(F.xxhash64("number"), F.coalesce("_parts", F.lit(1))).cast("int")
    average = documents.agg(F.avg("length")).scalar()
    impact = weight(F.col("tf"), F.col("length"), average, K1, B)
    placed = pairs.join(split, "token", "left").select("token", part.alias("part"), "number", "tf", "length")
    # The postings are shuffled and sorted once: ranked inside their part, they lie in the order of the folders.
    placed = placed.select(_bucket(F.col("token"), index.buckets).alias("bucket"), "token", "part", "number", "tf", "length", impact.alias("impact"))
    inside = F.row_number().over(Window.partitionBy("bucket", "token", "part").orderBy(F.desc("impact"), "number"))
    rows = placed.withColumn("block", F.floor((inside - 1) / F.lit(BLOCK)).cast("int"))
    rows.select("bucket", "token", "part", "block", "number", "tf", "length").write.partitionBy("bucket").parquet(f"{root}/postings/segment={name}")
    return name


# ------------------------------------------------------------------------------------ ranking
_BLOCK = ["bucket", "token", "segment", "part", "block"]


@dataclass(frozen=True)
class _Asked:
    """The tables that the rounds of a ranking share."""

    index: TextIndex
    figures: Column
    asked: DataFrame  # query_id, bucket, token, w (repetitions and rarity), u (the most it can add)
    headers: DataFrame  # blocks of the words asked, with `bound`, the most a block's weight can be
    buckets: list[int] | None
    k1: float
    b: float

    def weight(self, tf, length) -> Column:
        return weight(tf, length, self.figures["average"], self.k1, self.b)

    def opened(self, blocks: DataFrame) -> DataFrame:
        """`query_id, segment, number, u, part_score`: the documents of blocks `(query_id, w, u, *_BLOCK)`."""
        rows = self.index.postings(self.buckets).join(blocks, _BLOCK)
        return rows.select("query_id", "segment", "number", "u", (F.col("w") * self.weight(F.col("tf"), F.col("length"))).alias("part_score"))

    def scanned(self, limits: DataFrame) -> DataFrame:
        """`query_id, segment, number, doc_id, score` of all documents that reach the limit `(query_id, least)` of a
        question. Each is scored for all questions where it lies: the documents are shuffled once, and of the pairs
        with questions only those leave their task that can be among the best."""
        rows = self.index.documents.select("segment", "number", "length", "tokens", "tfs").repartition("segment", "number").select(
            "segment", "number", "length", F.explode(F.arrays_zip("tokens", "tfs")).alias("e")).select(
            "segment", "number", "length", F.col("e.tokens").alias("token"), F.col("e.tfs").alias("tf"))
        parts = rows.join(F.broadcast(self.asked.select("query_id", "token", "w")), "token")
        score = F.round(F.sum(F.col("w") * self.weight(F.col("tf"), F.col("length"))), 10)
        scored = parts.groupBy("segment", "number", "query_id").agg(score.alias("score"))
        best = scored.join(F.broadcast(limits), "query_id").where(F.col("score") >= F.col("least")).drop("least")
        return best.join(self.index.documents.select("segment", "number", "doc_id"), ["segment", "number"])

    def exact(self, pairs: DataFrame) -> DataFrame:
        """`query_id, doc_id, score` of pairs `(query_id, segment, number)`, from the documents' own words."""
        rows = pairs.join(self.index.documents, ["segment", "number"]).select(
            "query_id", "segment", "number", "doc_id", "length", F.explode(F.arrays_zip("tokens", "tfs")).alias("e"))
        held = rows.select("query_id", "segment", "number", "doc_id", "length", F.col("e.tokens").alias("token"), F.col("e.tfs").alias("tf"))
        parts = held.join(self.asked.select("query_id", "token", "w"), ["query_id", "token"])
        score = F.sum(F.col("w") * self.weight(F.col("tf"), F.col("length")))
        # The words of a document are summed in the task that read it. Rounded far below what ranks: copies
        # of a document tie in whatever order their parts were added.
        return parts.groupBy("query_id", "segment", "number").agg(F.first("doc_id").alias("doc_id"), F.round(score, 10).alias("score"))


def _kept(index: TextIndex, df: DataFrame) -> DataFrame:
    """A step of a ranking as a table below the index."""
    path = f"{index.root}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return index.spark.read.schema(df.schema).parquet(path)


def _ask(index: TextIndex, questions: DataFrame, k1: float, b: float, known: list[str] | None) -> _Asked:
    """`known` lists the words of a short question, so that only their folders are read."""
    buckets = None if known is None else [r[0] for r in index.spark.createDataFrame([(w,) for w in known or [""]], "t string").select(
        _bucket(F.col("t"), index.buckets)).distinct().collect()]
    figures = index.figures().select(F.struct("n", "average").alias("f")).scalar()
    wanted = (
        questions.select("query_id", F.explode(tokens(F.col("text"))).alias("token"))
        .groupBy("query_id", "token").agg(F.count(F.lit(1)).alias("times"))
        .withColumn("bucket", _bucket(F.col("token"), index.buckets))
    )
    weighed = wanted.join(index.frequencies(buckets), ["bucket", "token"]).select(
        "query_id", "bucket", "token", (F.col("times") * idf(figures["n"], F.col("df"))).alias("w"))
    # The best weight of a block is taken under the average length of its segment.
    typical = index._table("figures", index.segments).select("segment", F.try_divide("total", "n").alias("typical"))
    held = index.postings(buckets).join(weighed.select("bucket", "token").distinct(), ["bucket", "token"], "left_semi").join(F.broadcast(typical), "segment")
    headers = held.groupBy(*_BLOCK, "typical").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("most"), F.min("length").alias("least"),
        F.max(weight(F.col("tf"), F.col("length"), F.col("typical"), K1, B)).alias("best"))
    bound = weight(F.col("most"), F.col("least"), figures["average"], k1, b)
    if (k1, b) == (K1, B):
        # A weight grows with the average length, and by no more than the average does.
        bound = F.least(bound, F.col("best") * F.greatest(F.lit(1.0), F.try_divide(figures["average"], F.col("typical"))) * (1 + SLACK))
    # Blocks without their postings, and the words asked: both rounds read them several times.
    headers = _kept(index, headers.select(*_BLOCK, "n", bound.alias("bound")))
    peaks = headers.groupBy("bucket", "token").agg(F.max("bound").alias("peak"))
    asked = weighed.join(peaks, ["bucket", "token"]).select("query_id", "bucket", "token", "w", (F.col("w") * F.col("peak")).alias("u"))
    asked = _kept(index, asked)
    return _Asked(index, figures, asked, headers, buckets, k1, b)


def _thresholds(ask: _Asked, k: int) -> DataFrame:
    """`query_id, least_score`: what the k-th best document reaches at least; questions without k first documents are left out."""
    best = ask.headers.groupBy("bucket", "token").agg(F.max(F.struct("bound", "n", "segment", "part", "block")).alias("best"))
    first = ask.asked.join(best, ["bucket", "token"]).select("query_id", "w", "u", "bucket", "token", "best.segment", "best.part", "best.block")
    # At most BLOCK documents a word of the question.
    partial = ask.opened(first).groupBy("query_id", "segment", "number").agg(F.sum("part_score").alias("p"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("p"), "segment", "number"))
    tried = partial.withColumn("_at", place).where(F.col("_at") <= TRIED * k).select("query_id", "segment", "number")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    return _kept(ask.index, ask.exact(tried).withColumn("_at", place).where(F.col("_at") == k).select(
        "query_id", F.col("score").alias("least_score")))


def candidates(index: TextIndex, questions: DataFrame, k: int = 10, k1: float = K1, b: float = B) -> DataFrame:
    """`query_id, segment, number` of the documents that are scored for each question `(query_id, text)`."""
    ask = _ask(index, questions, k1, b, None)
    judged = _judged(ask, k)
    return _met(ask, judged, _needed(ask, judged))


def _judged(ask: _Asked, k: int) -> DataFrame:
    """The words asked, with `least`, the score a document of the question must reach, `all` and `upto`, sums of what words can add."""
    least = F.coalesce("least_score", F.lit(-1.0)) - SLACK * F.greatest(F.lit(1.0), F.coalesce("least_score", F.lit(1.0)))
    mine = Window.partitionBy("query_id")
    judged = ask.asked.join(_thresholds(ask, k), "query_id", "left").select(
        "query_id", "bucket", "token", "w", "u", least.alias("least"), F.sum("u").over(mine).alias("all"),
        F.sum("u").over(mine.orderBy("u", "token").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    return _kept(ask.index, judged)


def _needed(ask: _Asked, judged: DataFrame) -> DataFrame:
    """The blocks to be read, per question."""
    # The words whose weights do not reach the threshold together need no postings.
    needed = judged.where(F.col("upto") >= F.col("least"))
    blocks = ask.headers.join(needed, ["bucket", "token"]).where(
        F.col("w") * F.col("bound") + (F.col("all") - F.col("u")) >= F.col("least"))
    return _kept(ask.index, blocks.select("query_id", "w", "u", *_BLOCK, "n"))


def _met(ask: _Asked, judged: DataFrame, blocks: DataFrame) -> DataFrame:
    met = ask.opened(blocks.drop("n")).groupBy("query_id", "segment", "number").agg(
        F.sum("part_score").alias("p"), F.sum("u").alias("seen"))
    limits = judged.select("query_id", "least", "all").distinct()
    left = met.join(limits, "query_id").where(F.col("p") + F.col("all") - F.col("seen") >= F.col("least"))
    return _kept(ask.index, left.select("query_id", "segment", "number"))


def _scan_is_less(ask: _Asked, blocks: DataFrame) -> bool:
    """Whether the questions would open more postings than a quarter of all that the documents hold: every opened
    posting is a row of a shuffle, for each question that opens it, and documents are read again for what it leaves."""
    opened, = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()
    held, = ask.index.frequencies().agg(F.coalesce(F.sum("df"), F.lit(0))).first()
    return 4 * opened > held


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """The k best of each question: inside slices of a question first, then over what the slices kept."""
    order = [F.desc("score"), F.col("doc_id"), F.col("segment"), F.col("number")]
    sliced = scored.withColumn("_slice", F.pmod(F.xxhash64("segment", "number"), F.lit(SLICES)))
    inside = F.row_number().over(Window.partitionBy("query_id", "_slice").orderBy(*order))
    best = sliced.withColumn("_at", inside).where(F.col("_at") <= k)
    overall = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return best.withColumn("rank", overall).where(F.col("rank") <= k)


def bm25_many(index: TextIndex, questions: DataFrame, k: int = 10, k1: float = K1, b: float = B, prune: bool = True) -> DataFrame:
    """`(query_id, rank, doc_id, score)` for a table of questions `(query_id, text)`.

    A question without a hit gets the first k documents with score 0. Equal scores are ranked by document.
    `prune=False` scores every document that holds a word asked: the same rows, and less work where the
    collection is small or its words are so common that few documents can be left out. With pruning, that is
    done as well when the blocks to be read hold more postings than it takes.
    """
    return _many(_ask(index, questions, k1, b, None), questions, k, prune)


def _many(ask: _Asked, questions: DataFrame, k: int, prune: bool = True) -> DataFrame:
    judged = _judged(ask, k)
    blocks = _needed(ask, judged) if prune else None
    if blocks is None or _scan_is_less(ask, blocks):
        scored = ask.scanned(judged.select("query_id", "least").distinct())
    else:
        scored = ask.exact(_met(ask, judged, blocks))
    ranked = _ranked(scored, k).select("query_id", "rank", "doc_id", "score")
    first = ask.index.documents.select("doc_id").orderBy("doc_id").limit(k).agg(F.array_sort(F.collect_list("doc_id")).alias("d")).scalar()
    silent = questions.select("query_id").distinct().join(ask.asked.select("query_id").distinct(), "query_id", "left_anti")
    zeros = silent.select("query_id", F.posexplode(first).alias("_at", "doc_id")).select(
        "query_id", (F.col("_at") + 1).alias("rank"), "doc_id", F.lit(0.0).alias("score"))
    return ranked.union(zeros)


def search(index: TextIndex, question: str, k: int, k1: float = K1, b: float = B) -> DataFrame:
    """`(doc_id, score)` of the k best documents; the first k with score 0 if no document holds a
    word of the question. Only the folders of the question's words are read."""
    asked = index.spark.createDataFrame([(0, question)], "query_id int, text string")
    return _many(_ask(index, asked, k1, b, list(dict.fromkeys(words(question)))), asked, k).select("doc_id", "score")
