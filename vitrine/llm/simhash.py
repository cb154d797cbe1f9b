"""SimHash near-dedup with BK-trees.

Fingerprints are 64-bit words. Equal ones are one class. Classes are dealt into shards by masked
bits, so that any two within the radius meet in a shard; a
shard is a BK-tree, whose children hang on their Hamming distance to the parent, and a search
follows only the edges within the radius. A tree reaches the queries of its shard by a join, which
Catalyst turns into a broadcast if the trees are small; a large shard is split into several trees
and several blocks of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens
from vitrine.llm.common import numbered, restored, row_keys, second_sum, written
from vitrine.llm.components import components, forest_edges

#: Fingerprints in one tree or one block of queries.
TREE_NODES = 2_048


# ------------------------------------------------------------------------- fingerprints
def _bit_votes(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each of n texts, how many of its hashes have each of the 64 bits set."""
    table = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
    votes = np.empty((n, 64), np.int64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        counts = np.bincount(owner * 256 + octets[:, k], minlength=n * 256).reshape(n, 256)
        votes[:, 8 * k : 8 * k + 8] = counts @ table
    return votes


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits set in more than half of each text's hashes; zero for a text without any."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    bits = (_bit_votes(hashes, owner, n) * 2 > counts[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def joined_shingles(text: str, size: int, digest=xxhash.xxh64_intdigest, seed: int = 42) -> list[int]:
    """XXH64 of each run of `size` words of the lower-cased (A-Z) text, joined by single spaces."""
    found = text.encode().lower().split()
    if len(found) <= size:
        return [digest(b" ".join(found), seed)] if found else []
    line = b" ".join(found)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(gaps[: len(found) - size] + 1).tolist()]
    ends = [*gaps[size - 1 :].tolist(), len(line)]
    return [digest(line[a:b], seed) for a, b in zip(starts, ends)]


def _exact_words(size: int):
    def of(texts: pa.Array) -> np.ndarray:
        lists = [joined_shingles(t or "", size) for t in texts.to_pylist()]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        hashes = np.fromiter((h for x in lists for h in x), np.uint64, int(counts.sum()))
        return _majority(hashes, counts)[:, None]

    return of


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """`_id, _sum, _mark, fp` (an array of one long) of each row, as a written table.

    A null text counts as empty; a text without words has an all-zero fingerprint, one with fewer
    words than `size` is one shingle. `_sum` and `_mark` are two hashes that tell texts apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _exact_words(size)
        for batch in batches:
            for piece in tokens.pieces(batch, "_text"):
                flat = pa.array(of(piece.column("_text")).view(np.int64).ravel())
                fp = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32), flat)
                yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("_sum"), piece.column("_mark"), fp], ["_id", "_sum", "_mark", "fp"])

    rows = row_keys(docs, id_col, text_col).withColumn("_mark", second_sum(F.col("_text")))
    return written(rows.mapInArrow(run, "_id long, _sum long, _mark long, fp array<long>"), "fingerprints")


# ------------------------------------------------------------------------------- shards
def block_masks(radius: int, bits: int = 64) -> list[list[int]]:
    """Masks of which any two fingerprints within the radius agree on at least one: the bits are
    cut into radius + 3 blocks, of which at least three are then equal."""
    blocks = radius + 3
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [_as_words(sum(chosen), bits) for chosen in combinations(parts, 3)]


def _as_words(mask: int, bits: int) -> list[int]:
    out = [(mask >> (64 * k)) & ((1 << 64) - 1) for k in range((bits + 63) // 64)]
    return [w - (1 << 64) if w >> 63 else w for w in out]


def _shard_keys(fp: Column, masks: list[list[int]]) -> Column:
    return F.array(*[
        F.xxhash64(F.lit(i), *[fp[k].bitwiseAND(F.lit(w)) for k, w in enumerate(mask) if w])
        for i, mask in enumerate(masks)])


# ---------------------------------------------------------------------------- BK-trees
class Tree:
    """A BK-tree over rows of 64-bit words; children are keyed by their distance to the parent."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in range(len(values))]
        stack = [(0, np.arange(1, len(values)))] if len(values) else []
        while stack:
            node, below = stack.pop()
            if not len(below):
                continue
            far = distances(values[below], values[node])
            order = np.argsort(far, kind="stable")
            below, far = below[order], far[order]
            cuts = np.flatnonzero(np.diff(far)) + 1
            for part, d in zip(np.split(below, cuts), far[np.concatenate(([0], cuts))].tolist()):
                self.children[node][d] = int(part[0])
                stack.append((int(part[0]), part[1:]))

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, numbers of the queries within the radius of it)."""
        stack = [(0, np.arange(len(queries)))] if len(self.values) else []
        while stack:
            node, active = stack.pop()
            far = distances(queries[active], self.values[node])
            yield node, active[far <= radius]
            for edge, child in self.children[node].items():
                follow = active[np.abs(far - edge) <= radius]
                if len(follow):
                    stack.append((child, follow))


def distances(values: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values ^ one).sum(axis=-1, dtype=np.int64)


def _search(radius: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left: list[np.ndarray] = []
            right: list[np.ndarray] = []
            columns = [batch.column(c) for c in ("tree", "tree_nodes", "asked", "asked_nodes")]
            for row in range(batch.num_rows):
                tree, tree_nodes, asked, asked_nodes = (c[row].values.to_numpy() for c in columns)
                values = np.ascontiguousarray(tree).view(np.uint64).reshape(-1, width)
                queries = np.ascontiguousarray(asked).view(np.uint64).reshape(-1, width)
                a, b = [], []
                for node, hits in Tree(values).near(queries, radius):
                    a.append(np.full(len(hits), tree_nodes[node]))
                    b.append(asked_nodes[hits])
                # Only the links that join what is not joined yet leave the task.
                x, y = forest_edges(np.concatenate(a), np.concatenate(b))
                left.append(x)
                right.append(y)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    return run


def links(classes: DataFrame, radius: int, masks: list[list[int]], tree_nodes: int = TREE_NODES) -> DataFrame:
    """Edges `a, b` that connect all classes `(node, fp)` within the radius of each other that
    share a mask. Distinct fingerprints only; nodes are longs."""
    width = len(masks[0])
    rows = classes.select("node", "fp", F.explode(_shard_keys(F.col("fp"), masks)).alias("shard"))
    shared = rows.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(shared, "shard")
    parts = F.ceil(F.col("n") / F.lit(tree_nodes)).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts)).withColumn("parts", parts)
    blocks = rows.groupBy("shard", "parts", "part").agg(
        F.flatten(F.collect_list(F.struct("node", "fp")).getField("fp")).alias("fps"),
        F.collect_list(F.struct("node", "fp")).getField("node").alias("nodes"))
    blocks = written(blocks, "trees")
    alone = blocks.where("parts = 1").select(
        F.col("fps").alias("tree"), F.col("nodes").alias("tree_nodes"), F.col("fps").alias("asked"), F.col("nodes").alias("asked_nodes"))
    split = blocks.where("parts > 1")
    asked = split.select("shard", F.col("part").alias("other"), F.col("fps").alias("asked"), F.col("nodes").alias("asked_nodes"))
    pairs = split.join(asked, "shard").where("part <= other").select(
        F.col("fps").alias("tree"), F.col("nodes").alias("tree_nodes"), "asked", "asked_nodes")
    # Each row is one tree and one block of queries, so the units of a large shard spread over tasks.
    units = alone.union(pairs.repartition(F.rand(5)))
    return units.mapInArrow(_search(radius, width), "a long, b long")


def near_components(prints: DataFrame, radius: int, masks: list[list[int]]) -> DataFrame:
    """`fp, least_id, node, root` of each distinct fingerprint: `root` is equal for those linked, directly
    or through others."""
    classes = written(prints.groupBy("fp").agg(F.min("_id").alias("least_id")).withColumn("node", F.col("fp")[0]), "classes")
    found = components(links(classes, radius, masks))
    return classes.join(found, "node", "left").select("fp", "least_id", "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """`_id, _sum, _mark, fp, component_id` of each row; the component is named by its smallest identifier
    (null identifiers count only if there is no other).

    The shards are exact for the radius. Extra columns of `docs` are not read.
    """
    prints = fingerprints(docs, id_col, text_col, size)
    found = near_components(prints, radius, block_masks(radius))
    least = found.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = written(found.join(least, "root").select(F.col("fp").alias("_fp"), "component_id"), "named")
    return prints.join(named, F.col("fp") == F.col("_fp")).drop("_fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component of `near_duplicates`: the one with the smallest identifier, then checksums.

    All columns stay. A row with a null identifier stays only if its component has no other; of rows
    that repeat identifier and text one stays. A text is known by two independent 64-bit hashes.
    """
    prints = fingerprints(docs, id_col, text_col, size)
    found = near_components(prints, radius, block_masks(radius)).select(F.col("fp").alias("_fp"), "root")
    order = F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"), F.col("_sum").alias("sum"), F.col("_mark").alias("mark"))
    chosen = prints.join(found, F.col("fp") == F.col("_fp")).groupBy("root").agg(F.min(order).alias("first"))
    chosen = written(chosen.select(*[F.col(f"first.{c}").alias(f"_best_{c}") for c in ("id", "sum", "mark")]), "chosen")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*numbered(docs), F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_sum"), second_sum(text).alias("_mark"))
    same = F.col("_id").eqNullSafe(F.col("_best_id")) & (F.col("_sum") == F.col("_best_sum")) & (F.col("_mark") == F.col("_best_mark"))
    kept = rows.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["_id", "_sum", "_mark"]).select(*restored(docs))
