"""Words of many texts at once, as arrays. Used inside tasks, on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes handled at once inside a task; bounds the memory of the arrays derived from them.
PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most `limit` bytes of text; a longer single text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(size)
    if len(sizes) > start:
        yield batch.slice(start, len(sizes) - start)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every word in order, and the offsets of each text in that array."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    blank = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in coded.dictionary.to_pylist()),
                        dtype=np.uint64, count=len(coded.dictionary))
    hashes = table[coded.indices.to_numpy(zero_copy_only=False)] if len(table) else np.zeros(0, np.uint64)
    if blank.any():
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[~blank], minlength=len(counts)).astype(np.int64)
        hashes = hashes[~blank]
    return hashes, np.concatenate(([0], np.cumsum(counts)))


class Rolling:
    """Hashes of runs of k consecutive values, as a polynomial modulo 2^64."""

    def __init__(self, multiplier: int):
        self.multiplier = multiplier | 1
        self.inverse = pow(self.multiplier, -1, 1 << 64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 1), base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

    def __call__(self, values: np.ndarray, k: int) -> np.ndarray:
        """One hash for each start; `len(values) - k + 1` of them, none if there are fewer values."""
        n = len(values)
        if n < k:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64),
                                   np.cumsum(values * self._powers(self.inverse, n), dtype=np.uint64)))
            return mixed((sums[k:] - sums[:-k]) * self._powers(self.multiplier, n)[: n - k + 1])


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of a text."""
    codes = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([False], (codes != 32) & ((codes < 9) | (codes > 13)), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of equal keys out of batches sorted by key; several groups come as one table.

    Cuts only where the key changes, so each table holds whole groups and, unless one group is
    larger, about one batch.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edges = changes(batch, keys)
        if held and not same(held[-1], held[-1].num_rows - 1, batch, 0, keys):
            yield pa.Table.from_batches(held)
            held = []
        if len(edges):
            cut = int(edges[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def changes(batch, keys: list[str]) -> np.ndarray:
    """Rows whose key differs from that of the row before."""
    differs = np.zeros(max(batch.num_rows - 1, 0), bool)
    for key in keys:
        values = batch.column(key)
        values = values.to_numpy(zero_copy_only=False) if isinstance(values, pa.Array) else values.to_numpy()
        differs |= values[1:] != values[:-1]
    return np.flatnonzero(differs) + 1


def same(left, i: int, right, j: int, keys: list[str]) -> bool:
    return all(left.column(k)[i].as_py() == right.column(k)[j].as_py() for k in keys)
