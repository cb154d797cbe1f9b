"""Substring dedup: windows of words that start at two places or more, found in groups by a prefix.

Every window of `length` words picks one of its prefixes of PREFIX words by smallest hash, so equal
windows pick the same one at the same place, and windows are grouped by it. In a group equal 64-bit
hashes of whole windows are the repeats; a prefix that is too frequent for one task is dealt over several,
which report their windows to each other by hash. For windows of one length these are the nodes of that
depth in a suffix tree of the group, but no tree is built, prefixes have one length, and longer
repeats come out as runs of windows.

One row per picked prefix carries the windows that picked it, so about every fourteenth word of
the corpus gives a row, and text is shuffled once, to meet the positions that go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens
from vitrine.llm.common import count_words, row_keys, written

LENGTH = 35
PREFIX = 8
#: Suffix rows of one prefix that a task holds; longer groups are split.
GROUP_ROWS = 4_000
#: Most prefixes that can each hold a millionth of all rows.
MOST_FREQUENT = 1_000_000
_PREFIX_HASH = tokens.Rolling(0x9E3779B97F4A7C15)
_WINDOW_HASH = tokens.Rolling(0xC2B2AE3D27D4EB4F)


def _picked(texts: pa.Array, length: int, with_windows: bool):
    """For each picked prefix: hash, row, first window that picked it, number of such windows; and
    the hashes of all windows in the same order."""
    hashes, offsets = tokens.word_hashes(texts)
    span = length - PREFIX + 1
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    if not counts.any():
        return None
    rows = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][rows] + within
    prefixes = _PREFIX_HASH(hashes, PREFIX)
    best = sliding_window_view(prefixes, span).argmin(axis=1)
    anchors = starts + best[starts]
    fresh = np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])))
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.concatenate((first, [len(rows)])))
    windows = _WINDOW_HASH(hashes, length)[starts] if with_windows else None
    # A window is known by its hash and by where in it the prefix stands.
    return prefixes[anchors[first]], rows[first], within[first], sizes, windows


def _count_prefixes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "_text"):
                found = _picked(piece.column("_text"), length, False)
                if found:
                    values, n = np.unique(found[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["prefix", "n"])

    return run


def frequent_prefixes(docs: DataFrame, length: int, group_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes shared by too many rows for one group, and into how many parts each is split.

    Too many is more than `group_rows`, and more than a millionth of all rows: so at any size there
    are at most MOST_FREQUENT of them (16 MB), which is why they may travel with the tasks.
    """
    counts = docs.select("_text").mapInArrow(_count_prefixes(length), "prefix long, n long")
    counts = written(counts.groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > group_rows), "frequent")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where(F.col("n") * MOST_FREQUENT > total).toPandas()
    found = found.sort_values("prefix")
    parts = np.ceil(found["n"].to_numpy(np.float64) / group_rows).astype(np.int64)
    return found["prefix"].to_numpy(np.int64), parts


def _suffix_rows(length: int, frequent: np.ndarray, parts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tokens.pieces(batch, "_text", 2 << 20):
                found = _picked(piece.column("_text"), length, True)
                if not found:
                    continue
                prefix, rows, first, sizes, windows = found
                prefix = prefix.view(np.int64)
                rows = pa.array(rows)
                sums = piece.column("_sum").take(rows)
                part = np.full(len(prefix), -1, np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, prefix), len(frequent) - 1)
                    hot = np.flatnonzero(frequent[at] == prefix)
                    ids = pc.fill_null(piece.column("_id"), -1).to_numpy(zero_copy_only=False)[found[1][hot]].view(np.uint64)
                    spread = tokens.mixed(tokens.mixed(sums.to_numpy()[hot].view(np.uint64) + first[hot].astype(np.uint64)) ^ ids)
                    part[hot] = (spread % parts[at[hot]].astype(np.uint64)).astype(np.int64)
                cuts = (np.concatenate(([0], np.cumsum(sizes))) * 8).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(prefix), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(windows))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix), pa.array(part), piece.column("_id").take(rows), sums, pa.array(first.astype(np.int32)), blob],
                    ["prefix", "part", "_id", "_sum", "first", "windows"])

    return run


_FOUND = "prefix long, window long, _id long, _sum long, start int, n int, decided boolean"


def _deep_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves below the nodes that are a whole window deep, group by group.

    A run of windows of one row that are all repeats comes as one row (`start`, `n`). In a part of
    a split group a window seen once may have its equal in another part: it comes undecided, as
    does one witness (n = 2) of each repeat of the part.
    """
    for table in tokens.groups(batches, ["prefix", "part"]):
        table = table.combine_chunks()
        edges = np.concatenate(([0], tokens.changes(table, ["prefix", "part"])))
        group = np.zeros(table.num_rows, np.int64)
        group[edges] = 1
        group = np.cumsum(group) - 1
        part = table.column("part").to_numpy()
        useful = (np.bincount(group)[group] > 1) | (part >= 0)
        if not useful.any():
            continue
        table = table.filter(pa.array(useful)).combine_chunks()
        group, part = group[useful], part[useful]
        blob = table.column("windows").chunk(0)
        base = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
        windows = np.frombuffer(blob.buffers()[2], np.uint8)[base[0] : base[-1]].view(np.int64)
        sizes = np.diff(base) // 8
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + table.column("first").to_numpy()[row]
        order = np.lexsort((windows, group[row]))
        key, owner = windows[order], group[row][order]
        equal = np.concatenate(([False], (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])))
        repeated = np.zeros(len(row), bool)
        repeated[order] = equal | np.concatenate((equal[1:], [False]))
        witness = np.zeros(len(row), bool)
        witness[order] = ~equal
        hot = part[row] >= 0

        at = np.flatnonzero(repeated)
        if len(at):
            new = np.concatenate(([True], (np.diff(at) != 1) | (row[at][1:] != row[at][:-1])))
            heads = at[new]
            runs = np.diff(np.concatenate((np.flatnonzero(new), [len(at)])))
            yield _found(table, row[heads], windows[heads], place[heads], runs, True)
        open_ = np.flatnonzero(hot & witness)
        if len(open_):
            yield _found(table, row[open_], windows[open_], place[open_], np.where(repeated[open_], 2, 1), False)


def _found(table: pa.Table, rows, windows, start, n, decided: bool) -> pa.RecordBatch:
    taken = table.select(["prefix", "_id", "_sum"]).take(pa.array(rows)).combine_chunks()
    column = {c: taken.column(c).chunk(0) for c in taken.column_names}
    return pa.RecordBatch.from_arrays(
        [column["prefix"], pa.array(windows), column["_id"], column["_sum"], pa.array(start.astype(np.int32)),
         pa.array(np.asarray(n).astype(np.int32)), pa.array(np.full(len(rows), decided))],
        ["prefix", "window", "_id", "_sum", "start", "n", "decided"])


def _mark():
    return F.xxhash64(F.lit(1), F.col("_text"))


def copied_texts(docs: DataFrame) -> DataFrame:
    """`_sum, _mark, n_words` of the texts that two rows or more hold, known by two hashes."""
    found = docs.select("_sum", _mark().alias("_mark"), count_words(F.col("_text")).alias("words"))
    found = found.groupBy("_sum", "_mark").agg(F.count("*").alias("n"), F.min("words").alias("n_words"))
    return written(found.where("n > 1").select("_sum", "_mark", "n_words"), "copies")


def distinct_texts(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """`_id, _text, _sum` with each of the `copies` once."""
    marked = docs.withColumn("_mark", _mark())
    held = copies.select("_sum", "_mark")
    single = marked.join(held, ["_sum", "_mark"], "left_anti").select("_id", "_text", "_sum")
    first = marked.join(held, ["_sum", "_mark"], "left_semi").groupBy("_sum", "_mark").agg(F.min("_id").alias("_id"), F.first("_text").alias("_text"))
    return written(single.union(first.select("_id", "_text", "_sum")), "texts")


def suffixes(texts: DataFrame, length: int, group_rows: int) -> DataFrame:
    """One row per picked prefix of each text: `prefix, part, _id, _sum, first, windows`."""
    frequent, parts = frequent_prefixes(texts, length, group_rows)
    return texts.mapInArrow(_suffix_rows(length, frequent, parts),
                            "prefix long, part long, _id long, _sum long, first int, windows binary")


def repeated_windows(docs: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """`_id, _sum, runs` of the rows of `docs(_id, _text, _sum)` that hold repeated windows; a run
    is (first window, number of windows), counted in words.

    Every window of a text that two rows hold is a repeat, so such a text gives suffixes only once.
    """
    copies = copied_texts(docs)
    grouped = suffixes(distinct_texts(docs, copies), length, group_rows).repartition("prefix", "part").sortWithinPartitions("prefix", "part")
    found = written(grouped.mapInArrow(_deep_nodes, _FOUND), "deep_nodes")
    undecided = found.where("not decided")
    repeats = undecided.groupBy("prefix", "window").agg(F.sum("n").alias("total")).where("total > 1").drop("total")
    late = undecided.where("n = 1").join(repeats, ["prefix", "window"]).select("_id", "_sum", "start", "n")
    whole = docs.select("_id", "_sum", _mark().alias("_mark")).join(copies.where(F.col("n_words") >= length), ["_sum", "_mark"])
    whole = whole.select("_id", "_sum", F.lit(0).alias("start"), (F.col("n_words") - length + 1).cast("int").alias("n")).distinct()
    marks = found.where("decided").select("_id", "_sum", "start", "n").union(late).union(whole)
    return marks.groupBy("_id", "_sum").agg(F.collect_set(F.struct("start", "n")).alias("runs"))


def _strip(text: str, runs, length: int, spacing: bool) -> tuple[str, int, int]:
    raw = (text or "").encode()
    starts, ends = tokens.word_spans(raw)
    gone = np.zeros(len(starts) + 1, np.int64)
    for run in runs:
        gone[run["start"]] += 1
        gone[min(run["start"] + run["n"] + length - 1, len(starts))] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    if not spacing:
        kept = b" ".join(raw[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist()))
        return kept.decode(), len(starts), int(gone.sum())
    if not gone.any():
        return text or "", len(starts), 0
    # A word that goes takes the separators behind it along.
    until = np.concatenate((starts[1:], [len(raw)]))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8)))
    head = raw[: starts[0]]
    kept = b"".join(raw[starts[a] : until[b - 1]] for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()))
    return (head + kept).decode(), len(starts), int(gone.sum())


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  spacing: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All rows and columns of `docs`, with `kept_text`, `n_words` and `n_removed` in a struct
    column `stripped` (which replaces one of that name).

    A word goes if a window of `length` words that holds it starts at two places or more of the
    corpus; all its occurrences go. `spacing` keeps the separators between kept words, else one
    space stands between them. A null text counts as empty, a text shorter than a window stays.
    Rows that repeat identifier and text are two places, and both lose the words they share.
    """
    keyed = row_keys(docs, id_col, text_col)
    runs = written(repeated_windows(keyed, length, group_rows).select(
        F.col("_id").alias("_run_id"), F.col("_sum").alias("_run_sum"), "runs"), "runs")
    columns = [c for c in docs.columns if c != "stripped"]
    position = columns.index(text_col)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col(id_col).cast("long").alias("_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_sum"))
    met = rows.join(runs.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_run_id")) & (F.col("_sum") == F.col("_run_sum")), "left")
    met = met.drop("_id", "_sum", "_run_id", "_run_sum")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])
        for batch in batches:
            for piece in tokens.pieces(batch, f"c{position}"):
                texts, marks = piece.column(f"c{position}").to_pylist(), piece.column("runs").to_pylist()
                made = [_strip(t, m or (), length, spacing) for t, m in zip(texts, marks)]
                kept = pa.StructArray.from_arrays([pa.array([m[i] for m in made], kind[i].type) for i in range(3)],
                                                  fields=[kind[i] for i in range(3)])
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], kept], [*piece.schema.names[:-1], "stripped"])

    schema = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(docs.select(*[f"`{c}`" for c in columns]).dtypes))
    out = met.mapInArrow(run, f"{schema}, stripped struct<kept_text: string, n_words: long, n_removed: long>")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "stripped")
