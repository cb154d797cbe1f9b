"""Embedding near-dedup by sorted projection passes.

In each pass the vectors of a label are ordered by a key of concatenated signs of random
projections, and each is compared with a bounded number of its successors. Verified pairs of all
passes are united. What the windows leave out is then found exactly: the vectors of a label are cut
into compact blocks in the order of such a key, and all pairs of blocks are compared that the angle
between their centres and their radii allow to hold a link between components. The links of a vector
are then counted inside its component, block by block, so that neither the number of passes nor the
window limits the count of a dense group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens
from vitrine.llm.common import written
from vitrine.llm.components import components, forest_edges

THRESHOLD = 0.98
PASSES = 12
WINDOW = 48
BITS = 48
BLOCK = 1_024
#: Vectors in one block of the exact comparison, and rows of it that are multiplied at once.
COMPARED = 4_096
STRIP = 512


def _keys(passes: int, bits: int, dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))


def _units(vectors: pa.Array, rows: int) -> np.ndarray:
    """The vectors in double precision, scaled to length one.

    They are divided by their largest component first: squares neither overflow nor vanish.
    """
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def _project(passes: int, bits: int, seed: int):
    """One row for each pass and vector, with its key; vectors travel as they are stored."""
    weights = (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 1_024):
                batch = whole.slice(start, 1_024)
                vectors = batch.column("vector")
                dims = np.diff(vectors.offsets.to_numpy())
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    part = batch.take(pa.array(at))
                    values = _units(part.column("vector"), len(at))
                    if dim not in planes:
                        planes[dim] = _keys(passes, bits, dim, seed)
                    keys = ((values @ planes[dim]) > 0).reshape(len(at), passes, bits) @ weights
                    for p in range(passes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), p, np.int32)), part.column("label"), part.column("dim"), pa.array(keys[:, p]),
                             part.column("node"), part.column("vector")],
                            ["pass", "label", "dim", "key", "node", "vector"])

    return run


def _neighbours(window: int, threshold: float):
    """Compare each vector with its `window` successors in the order of the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for start in range(0, whole.num_rows, 4_096):
                batch = whole.slice(start, 4_096)
                table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
                fresh = 0 if held is None else held.num_rows
                merged = table.to_batches()[0] if table.num_rows else batch
                edges = [0, *tokens.changes(merged, ["pass", "label", "dim"]).tolist(), merged.num_rows]
                left, right = [], []
                for a, b in zip(edges[:-1], edges[1:]):
                    nodes = merged.column("node").slice(a, b - a).to_numpy()
                    values = _units(merged.column("vector").slice(a, b - a), b - a)
                    for step in range(1, min(window, b - a - 1) + 1):
                        first = max(0, fresh - a - step)  # pairs with a row of this batch
                        near = np.einsum("ij,ij->i", values[first:-step], values[first + step :]) >= threshold
                        hits = np.flatnonzero(near) + first
                        left.append(nodes[hits])
                        right.append(nodes[hits + step])
                if left:
                    x, y = forest_edges(np.concatenate(left), np.concatenate(right))
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
                held = merged.slice(max(0, merged.num_rows - window))

    return run


def _cut_blocks(rows: int):
    """The rows of a partition with the number of their block: at most `rows` of a label each. The
    first row of a block has its centre, its radius (an angle), and its smallest and largest root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        keys = ["label", "dim"]
        held: list[pa.RecordBatch] = []
        size = 0

        def closed() -> pa.RecordBatch:
            nonlocal number, held, size
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            values = _units(table.column("vector"), table.num_rows)
            centre = values.sum(axis=0)
            length = np.sqrt(centre @ centre)
            centre = centre / length if length > 0 else values[0]
            radius = float(np.arccos(np.clip(values @ centre, -1, 1)).max())
            roots = table.column("root").to_numpy()
            blank = [None] * (table.num_rows - 1)
            columns = [pa.array(np.full(table.num_rows, number)), pa.array([centre.tolist(), *blank], pa.list_(pa.float64())),
                       pa.array([radius, *blank], pa.float64()), pa.array([int(roots.min()), *blank], pa.int64()),
                       pa.array([int(roots.max()), *blank], pa.int64())]
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays([*(table.column(c) for c in ("label", "dim", "node", "root", "vector")), *columns],
                                              ["label", "dim", "node", "root", "vector", "block", "centre", "radius", "least", "most"])

        for batch in batches:
            edges = [0, *tokens.changes(batch, keys).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                if held and not tokens.same(held[-1], held[-1].num_rows - 1, batch, a, keys):
                    yield closed()
                while a < b:
                    piece = batch.slice(a, min(b - a, rows - size))
                    held.append(piece)
                    size += piece.num_rows
                    a += piece.num_rows
                    if size == rows:
                        yield closed()
        if held:
            yield closed()

    return run


def _bridge(threshold: float):
    """Links between different components, block `one` against block `two` (or in one block), as
    pairs of roots; all pairs are compared, and those that join what is joined already are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tokens.groups(batches, ["one", "two"]):
            table = table.combine_chunks()
            edges = [0, *tokens.changes(table, ["one", "two"]).tolist(), table.num_rows]
            block, one, two, root = (table.column(c).to_numpy() for c in ("block", "one", "two", "root"))
            vectors = table.column("vector").chunk(0)
            left, right = [], []
            for a, b in zip(edges[:-1], edges[1:]):
                values, roots = _units(vectors.slice(a, b - a), b - a), root[a:b].copy()
                first, other = np.flatnonzero(block[a:b] == one[a]), np.flatnonzero(block[a:b] == two[a])
                facing = values[other]
                for start in range(0, len(first), STRIP):
                    strip = first[start : start + STRIP]
                    near = values[strip] @ facing.T >= threshold
                    i, j = np.nonzero(near & (roots[strip][:, None] != roots[other][None, :]))
                    if not len(i):
                        continue
                    x, y = forest_edges(roots[strip][i], roots[other][j])
                    left.append(x)
                    right.append(y)
                    at = np.minimum(np.searchsorted(x, roots), len(x) - 1)
                    roots = np.where(x[at] == roots, y[at], roots)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    return run


def missed_links(classes: DataFrame, found: DataFrame, threshold: float, bits: int, seed: int, compared: int = COMPARED) -> DataFrame:
    """Links `a, b` that connect all components `found(node, root)` of `classes(label, dim, node,
    vector)` between which there is a pair within the threshold.

    By the triangle inequality of angles, two blocks hold no link if their centres are further
    apart than both radii and the angle of the threshold; and none is asked for inside a component.
    """
    types = dict(classes.dtypes)
    keyed = classes.select("label", "dim", "node", "vector").mapInArrow(
        _project(1, bits, seed), f"pass int, label {types['label']}, dim int, key long, node long, vector {types['vector']}")
    # Components of a block or more get blocks of their own.
    large = found.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") >= compared).select(F.col("root").alias("home"))
    keyed = keyed.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")).join(large, F.col("root") == F.col("home"), "left")
    order = ["label", "dim", "home", "key", "node"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("label", "dim", "node", "root", "vector")
    rows = written(ordered.mapInArrow(_cut_blocks(compared), f"label {types['label']}, dim int, node long, root long, vector {types['vector']}, "
                                      "block long, centre array<double>, radius double, least long, most long"), "blocks")
    one = rows.where("centre is not null").select("label", "dim", "block", "centre", "radius", "least", "most")
    two = one.select(*[F.col(c).alias(f"{c}_2") for c in one.columns])
    dot = F.aggregate(F.zip_with("centre", "centre_2", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    # The slack covers rounding of the angles.
    limit = F.col("radius") + F.col("radius_2") + math.acos(max(-1.0, min(1.0, threshold))) + 1e-6
    joined = F.least("least", "least_2") == F.greatest("most", "most_2")
    pairs = one.join(two, (F.col("label") == F.col("label_2")) & (F.col("dim") == F.col("dim_2")) & (F.col("block") <= F.col("block_2")))
    pairs = written(pairs.where(~joined & (apart <= limit)).select(F.col("block").alias("one"), F.col("block_2").alias("two")), "block_pairs")
    roles = pairs.select(F.explode(F.array_distinct(F.array("one", "two"))).alias("block"), "one", "two")
    units = rows.select("block", "root", "vector").join(roles, "block")
    dealt = units.repartition("one", "two").sortWithinPartitions("one", "two")
    return dealt.mapInArrow(_bridge(threshold), "a long, b long")


def _count_links(threshold: float):
    """Links between the rows of side 0 and those of side 1 of each unit (or among side 0 alone)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["root", "low", "high"]
        for table in tokens.groups(batches, keys):
            table = table.combine_chunks()
            edges = [0, *tokens.changes(table, keys).tolist(), table.num_rows]
            nodes, sizes = table.column("node").to_numpy(), table.column("copies").to_numpy()
            block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
            vectors = table.column("vector").chunk(0)
            out_nodes, out_links = [], []
            for a, b in zip(edges[:-1], edges[1:]):
                values = _units(vectors.slice(a, b - a), b - a)
                if low[a] == high[a]:
                    near = values @ values.T >= threshold
                    np.fill_diagonal(near, False)
                    out_nodes.append(nodes[a:b])
                    out_links.append(near @ sizes[a:b])
                else:
                    one = block[a:b] == low[a]
                    near = values[one] @ values[~one].T >= threshold
                    out_nodes += [nodes[a:b][one], nodes[a:b][~one]]
                    out_links += [near @ sizes[a:b][~one], sizes[a:b][one] @ near]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_nodes)), pa.array(np.concatenate(out_links).astype(np.int64))],
                                             ["node", "links"])

    return run


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, bits: int = BITS,
                 block: int = BLOCK, seed: int = 3, compared: int = COMPARED) -> DataFrame:
    """`_id, n_links, component_id` of every row.

    Vectors link if their labels are equal and not null, their lengths are equal, and their cosine
    in double precision is at least `threshold`. A vector that is null, empty, zero or holds a null
    or a non-finite component links with nothing, nor does a row with a null label or identifier;
    such a row is a component of its own. Rows with equal label and components are one class and
    are never expanded into pairs. All links are found: what the passes leave out by comparing the
    blocks of a label; within a component all links are counted, however dense it is. An identifier
    that comes with several vectors stands for as many rows, each with links of its own; a component
    is named by the smallest identifier of its rows.
    """
    good = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Single-precision vectors are moved in single precision; tasks compute in double.
    stored = "array<float>" if dict(df.dtypes)[vector_col] == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast(stored).alias("vector"),
                     F.col(label_col).alias("label"))
    usable = F.col("_id").isNotNull() & F.col("label").isNotNull() & good & F.exists("vector", lambda x: x != 0)
    sound = rows.where(usable)
    # One row per class of equal vectors. It is named by a number of its own, given as the table is
    # written: identifiers may repeat, and one may come with several vectors.
    classes = sound.groupBy("label", "vector").agg(F.min("_id").alias("least_id"), F.count("*").alias("copies"))
    classes = written(classes.select("label", "vector", F.monotonically_increasing_id().alias("node"), "least_id", "copies", F.size("vector").alias("dim")), "classes")

    wide = classes.select("label", "dim", "node", "vector")
    kind = dict(classes.dtypes)["label"]
    keyed = wide.mapInArrow(_project(passes, bits, seed), f"pass int, label {kind}, dim int, key long, node long, vector {stored}")
    order = ["pass", "label", "dim", "key", "node"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    pairs = ordered.mapInArrow(_neighbours(window, threshold), "a long, b long")
    found = components(pairs)
    late = missed_links(classes, found, threshold, bits, seed, compared)
    found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(late))

    members = classes.join(found, "node").select("root", "node", "copies", "vector")
    sizes = members.groupBy("root").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    members = members.join(sizes, "root").select("root", "node", "copies", "vector", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).alias("block"))
    # A large component is cut into blocks; each pair of blocks is a unit of work of its own.
    units = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "copies", "vector")
    dealt = units.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    counted = dealt.mapInArrow(_count_links(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    # Rows find their class by two independent hashes of the vector, so vectors are not moved again.
    # Hashes pass over nulls: only usable rows look for a class.
    marks = [F.xxhash64(F.lit(k), F.col("vector")) for k in range(2)]
    least = classes.join(found, "node").groupBy("root").agg(F.min("least_id").alias("first_id"))
    homes = found.join(least, "root").select("node", "first_id")
    named = written(classes.join(homes, "node", "left").join(counted, "node", "left").select(
        F.col("label").alias("_label"), marks[0].alias("_mark0"), marks[1].alias("_mark1"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("first_id", "least_id").alias("component_id")), "named")
    marked = rows.select("_id", "label", marks[0].alias("mark0"), marks[1].alias("mark1"), usable.alias("usable"))
    joined = marked.join(named, (F.col("label") == F.col("_label")) & (F.col("mark0") == F.col("_mark0"))
                         & (F.col("mark1") == F.col("_mark1")) & F.col("usable"), "left")
    return joined.select("_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("component_id", "_id").alias("component_id"))
