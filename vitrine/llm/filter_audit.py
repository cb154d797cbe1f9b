"""Audit of how quality filters interact, with decision diagrams.

A document is a mask of the filters it fails. Documents are counted by part and mask, so a part is at
most 2 ** k counts whatever its size. Those counts become a decision diagram: a level for each filter,
an edge for pass and one for fail, equal subtrees shared, and each node knows the documents below it.
Swapping two adjacent levels gives the diagram of a neighbouring order; a chain of such swaps visits
every order. Along the path on which all filters pass, the fail edge of a level is what its filter
removes and the pass edge is what it keeps.

Defined cases: a null text is empty, a null part is the empty string; a row with a null identifier has
no label, is no copy and makes no other row a copy; rows that repeat an identifier count each, and are
no copies of each other; of repeated labels any `quality = 1` or `toxic = 1` counts; null labels are
none; an empty table has no parts and gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import words, written

#: Name of the filter that needs the whole table: the text of a smaller identifier again.
COPY = "E"
EMPTY = 0


def text_failures() -> dict[str, Column]:
    """The failure conditions that a text decides alone, over the columns `_text` and `_words`."""
    n, text = F.size("_words").cast("long"), F.col("_text")
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct("_words")).cast("long") * 100 < n * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def count_masks(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
                text_col: str = "text") -> tuple[list[str], DataFrame]:
    """The names of the filters, and `part, mask, n, good, toxic`: documents by the filters they fail.

    Bit i of the mask is filter i. Copies are found by the SHA-256 of the text: the smallest identifier of
    each digest is found with a partial aggregate, and rows meet it by identifier and digest, so that
    no group of copies is a key.
    """
    conditions = text_failures()
    names = [*conditions, COPY]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("_text"), words(text).alias("_words"))
    mask = sum((c.cast("int") * (1 << i) for i, c in enumerate(conditions.values())), F.lit(0))
    facts = written(rows.select("doc", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("digest")), "facts")

    named = facts.where("doc is not null")
    firsts = named.groupBy("digest").agg(F.min("doc").alias("doc")).withColumn("first", F.lit(True))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    copied = F.when(F.col("first").isNull(), F.lit(1 << len(conditions))).otherwise(0)
    met = named.join(firsts, ["doc", "digest"], "left").join(marks, "doc", "left")
    met = met.select("part", (F.col("mask") + copied).alias("mask"), "good", "toxic")
    unnamed = facts.where("doc is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    counts = met.union(unnamed).groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return names, counts


class Diagram:
    """A decision diagram over masks of k filters, weighted with vectors of counts.

    A node is a number; `passed` and `failed` are its children and `total` the counts below. The
    node EMPTY stands for no documents at any level. `levels[i]` maps children to the node of level
    i that has them, so equal subtrees are one node.
    """

    def __init__(self, counts: Mapping[int, tuple[int, ...]], k: int):
        self.order = list(range(k))
        self.width = len(next(iter(counts.values())))
        self.passed, self.failed, self.total = [EMPTY], [EMPTY], [(0,) * self.width]
        self.levels: list[dict] = [{} for _ in range(k + 1)]
        self.root = self._build(0, 0, counts)

    def _build(self, level: int, mask: int, counts) -> int:
        if level == len(self.order):
            return self._leaf(counts.get(mask))
        bit = 1 << self.order[level]
        return self._node(level, self._build(level + 1, mask, counts), self._build(level + 1, mask | bit, counts))

    def _leaf(self, weight) -> int:
        if weight is None or not any(weight):
            return EMPTY
        return self._add(len(self.order), weight, EMPTY, EMPTY, weight)

    def _node(self, level: int, passed: int, failed: int) -> int:
        if passed == failed == EMPTY:
            return EMPTY
        weight = tuple(a + b for a, b in zip(self.total[passed], self.total[failed]))
        return self._add(level, (passed, failed), passed, failed, weight)

    def _add(self, level: int, key, passed: int, failed: int, weight) -> int:
        found = self.levels[level].get(key)
        if found is None:
            found = self.levels[level][key] = len(self.total)
            self.passed.append(passed)
            self.failed.append(failed)
            self.total.append(weight)
        return found

    def swap(self, level: int) -> None:
        """Exchange a level with the next. A node of the upper level stays the same function, so what
        lies above is untouched; only its children are put together anew."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for node in upper:
            p, f = self.passed[node], self.failed[node]
            both = self._node(level + 1, self.passed[p], self.passed[f])
            neither = self._node(level + 1, self.failed[p], self.failed[f])
            self.passed[node], self.failed[node] = both, neither
            self.levels[level][both, neither] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, tuple, tuple, tuple]]:
        """Along the path of passes: filter, counts kept, counts removed, counts that fail it alone."""
        node = self.root
        for level, name in enumerate(self.order):
            gone = alone = self.failed[node]
            node = self.passed[node]
            for _ in range(level + 1, len(self.order)):
                alone = self.passed[alone]
            yield name, self.total[node], self.total[gone], self.total[alone]


def adjacent_swaps(k: int) -> list[int]:
    """Levels to swap, one after another, so that all orders of k filters are visited once: the
    last filter wanders through every order of the others, to and fro."""
    if k < 2:
        return []
    inner, out = adjacent_swaps(k - 1), []
    for turn in range(len(inner) + 1):
        down = turn % 2 == 0
        out += range(k - 2, -1, -1) if down else range(k - 1)
        if turn < len(inner):
            out.append(inner[turn] + (1 if down else 0))
    return out


def audit_part(counts: Mapping[int, tuple[int, int, int]], names: list[str]) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part."""
    k = len(names)
    diagram = Diagram(counts, k)
    seen, failing, shares = [], [0] * k, [0] * k
    for level in [None, *adjacent_swaps(k)]:
        if level is not None:
            diagram.swap(level)
        order = "".join(names[i] for i in diagram.order)
        # What the first filter of an order removes is all that fail it.
        failing[diagram.order[0]] = diagram.total[diagram.failed[diagram.root]][0]
        for step, (name, kept, gone, alone) in enumerate(diagram.all_pass(), 1):
            shares[name] += gone[0]
            seen.append((order, step, name, kept[0], gone, alone[0]))
    return [(order, step, kept, gone[0], failing[name] - gone[0], alone, gone[1], gone[2], shares[name])
            for order, step, name, kept, gone, alone in seen]


_LONGS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _LONGS)


def audit(names: list[str], counts: DataFrame) -> DataFrame:
    """All orders and steps of each part, from the `part, mask, n, good, toxic` of `count_masks`.

    One row of at most 2 ** k counts goes into a task per part, whatever the part holds.
    """
    if len(names) > 8:
        raise ValueError("all orders are listed: more than eight filters give too many")
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * len(_LONGS)]
        for batch in batches:
            for part, masks in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist()):
                rows = audit_part({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks}, names)
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.string()), *columns], ["part", "filter_order", "step", *_LONGS])

    return parts.mapInArrow(run, RESULT)
