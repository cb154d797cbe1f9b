"""Conflict-constrained best-fit packing.

Bins are held in order of their residual room and carry bitmaps of the sources and duplicate
clusters inside. A piece goes to the tightest bin that it fits and conflicts with in neither bitmap:
the search starts at the first bin with enough room and goes on to its successors.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens
from vitrine.llm.common import written

CAPACITY = 4_096
#: Pieces packed together. A bin holds pieces of one shard only.
SHARD_PIECES = 4_096
#: Pieces of one source that a bin may hold.
PER_SOURCE = 4


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int = 1) -> list[int]:
    """The bin of each piece, in the order given. Nulls conflict with nothing.

    `per_source` planes of source bits: the k-th says of which sources the bin holds k pieces.
    """
    source_bit = {s: 1 << i for i, s in enumerate(sorted({s for s in sources if s is not None}))}
    seen: dict = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    # Clusters of one piece conflict with nothing and need no bit.
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(c for c, n in seen.items() if c is not None and n > 1))}
    least = sizes[:]
    for i in range(len(least) - 2, -1, -1):
        least[i] = min(least[i], least[i + 1])
    order: list[tuple[int, int]] = []
    planes: list[list[int]] = []
    held: list[int] = []
    out = []
    for i, size in enumerate(sizes):
        source, cluster = source_bit.get(sources[i], 0), cluster_bit.get(clusters[i], 0)
        at = bisect_left(order, (size, -1))
        while at < len(order) and (planes[order[at][1]][-1] & source or held[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            room, found = order.pop(at)
        else:
            room, found = capacity, len(held)
            planes.append([0] * per_source)
            held.append(0)
        held[found] |= cluster
        for k, plane in enumerate(planes[found]):
            if not plane & source:
                planes[found][k] |= source
                break
        out.append(found)
        # A bin with less room than any piece to come is closed.
        if i + 1 < len(sizes) and room - size >= least[i + 1]:
            insort(order, (room - size, found))
    return out


def pack(docs: DataFrame, id_col: str, size: Column, source: Column, cluster: Column, capacity: int = CAPACITY,
         per_source: int = PER_SOURCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`_id, piece, first_unit, size, source, cluster, bin, slot` of every piece of every row.

    A row longer than `capacity` is cut into pieces of that size and a rest; nothing is dropped, and
    a row of size zero (or null) is one piece of size zero. Pieces of one row never share a bin, nor
    do two of one cluster; at most `per_source` of one source do. Pieces are dealt into shards of
    about `shard_pieces` by a hash of the row, so the work of a task is bounded at any size of the
    input and by any source; a shard is packed from its largest piece down. A null identifier,
    source or cluster is allowed; the latter two conflict with nothing.
    """
    units = F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), units.alias("_units"), source.cast("string").alias("source"),
                       cluster.cast("long").alias("cluster"))
    last = F.greatest(F.ceil(F.col("_units") / capacity) - 1, F.lit(0))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "_id", "piece", (F.col("piece") * capacity).alias("first_unit"),
        F.least(F.lit(capacity).cast("long"), F.col("_units") - F.col("piece") * capacity).alias("size"), "source", "cluster")
    pieces = written(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    # Equal rows (repeats) have equal hashes; a random part keeps them from meeting in one shard.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("_id", "piece", "cluster", F.floor(F.rand(7) * 1024)), F.lit(shards)))
    dealt = written(dealt, "dealt")
    grouped = dealt.repartition("shard").sortWithinPartitions("shard", F.desc("size"), "_id", "piece", "cluster", "source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tokens.groups(batches, ["shard"]):
            edges = [0, *tokens.changes(table, ["shard"]).tolist(), table.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                part = table.slice(a, b - a).combine_chunks()
                of = {c: part.column(c).to_pylist() for c in ("size", "source", "cluster")}
                bins = np.array(best_fit(of["size"], of["source"], of["cluster"], capacity, per_source), np.int64)
                slots = np.zeros(len(bins), np.int64)
                by_bin = np.argsort(bins, kind="stable")
                ordered = bins[by_bin]
                heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
                slots[by_bin] = np.arange(len(bins)) - np.repeat(heads, np.diff(np.concatenate((heads, [len(bins)]))))
                names = ["_id", "piece", "first_unit", "size", "source", "cluster"]
                numbered = pa.array(bins + (part.column("shard")[0].as_py() << 32))
                yield pa.RecordBatch.from_arrays([*[part.column(c).combine_chunks() for c in names], numbered, pa.array(slots)],
                                                 [*names, "bin", "slot"])

    return grouped.mapInArrow(
        run, "_id long, piece long, first_unit long, size long, source string, cluster long, bin long, slot long")
