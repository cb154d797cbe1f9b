"""SentencePiece encoding and decoding for merge-type vocabularies.

Symbols are merged by an agenda of adjacent pairs, best score first, leftmost among equals. No piece
of such a vocabulary has a space mark after another character, so a text falls into chunks that are
encoded on their own and remembered; each new chunk of a batch is checked against the library.

The agendas of a batch's new chunks are worked off together: of all chunks that have n symbols left,
each merges the head of its agenda and goes on with n - 1, or is done. A long chunk has a heap of its own.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm import tokens

MARK = "▁"
#: Chunks remembered by a worker; beyond that the older half goes.
REMEMBERED = 600_000
#: Chunks of more symbols have a heap of their own.
TOGETHER = 24
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Rank of a pair that is no piece; it never heads an agenda.
_NONE = np.int32((1 << 31) - 1)


class Vocabulary:
    """Pieces and scores of a model, and the agenda over them.

    A symbol is the number of its piece, or `first_other` and its code point for a character
    that is no piece. Pairs of symbols that make a piece are a table from number to number.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = [i for i in range(len(sp)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)]
        plain = sorted(set(range(len(sp))) - set(special))
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if any(sp.is_byte(i) for i in special) else None
        self.unknown = sp.unk_id()
        if any(sp.is_unused(i) for i in special):
            raise ValueError("a vocabulary with unused pieces is not supported")
        if sp.encode(" a ") != sp.encode(f"{MARK}a{MARK}") or sp.decode(sp.encode(" a ")) != " a ":
            raise ValueError("only models that keep spaces and put one in front are supported")
        self.apart = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.newline = not any("\n" in p for p in self.ids) and self.bytes is not None
        self.first_other = len(sp)
        self.width = self.first_other + 0x110000
        # Equal scores have equal ranks; the best score has the lowest.
        scores = {i: sp.get_score(i) for i in plain}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for piece, number in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (order[scores[number]], number)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)

    def _symbol(self, text: str) -> int | None:
        found = self.ids.get(text)
        return found if found is not None or len(text) > 1 else self.first_other + ord(text)

    def _finished(self, symbols) -> bytes:
        """Ids of the symbols that are left, as 32-bit numbers."""
        out: list[int] = []
        for symbol in symbols:
            if symbol < self.first_other:
                out.append(symbol)
            elif self.bytes:
                out.extend(self.bytes[b] for b in chr(symbol - self.first_other).encode())
            else:
                out.append(self.unknown)
        return np.array(out, np.int32).tobytes()

    def merge(self, chunk: str) -> bytes:
        """Ids of a chunk in which spaces are marks already, from a heap of its own."""
        symbols: list[int] = [self._symbol(c) for c in chunk]
        n, width, pairs = len(symbols), self.width, self.pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int, int]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < n:
                found = pairs.get(symbols[left] * width + symbols[right])
                if found is not None:
                    heapq.heappush(agenda, (found[0], left, right, symbols[left], symbols[right], found[1]))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, one, two, made = heapq.heappop(agenda)
            if symbols[left] != one or symbols[right] != two or after[left] != right:
                continue
            symbols[left], symbols[right] = made, -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            propose(before[left], left)
            propose(left, after[left])
        return self._finished(s for s in symbols if s >= 0)

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols."""
        asked = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        hit = self.keys[at] == asked
        return np.where(hit, self.ranks[at], _NONE), np.where(hit, self.made[at], 0)

    def merge_all(self, chunks: list[str]) -> list[bytes]:
        """The ids of many chunks: their agendas side by side, by the number of symbols left."""
        out: list[bytes] = [b""] * len(chunks)
        waiting: dict[int, list[int]] = {}
        for i, chunk in enumerate(chunks):
            if len(chunk) > TOGETHER or not len(self.keys):
                out[i] = self.merge(chunk)
            else:
                waiting.setdefault(len(chunk), []).append(i)
        symbol = {c: self._symbol(c) for c in set(chain.from_iterable(chunks[i] for rows in waiting.values() for i in rows))}
        rows, symbols = np.zeros(0, np.int64), np.zeros((0, TOGETHER), np.int64)
        ranks, made = np.zeros((0, TOGETHER - 1), np.int32), np.zeros((0, TOGETHER - 1), np.int64)
        for n in range(TOGETHER, 0, -1):
            symbols, ranks, made = symbols[:, :n], ranks[:, : n - 1], made[:, : n - 1]
            if fresh := waiting.get(n):
                new = np.fromiter((symbol[c] for i in fresh for c in chunks[i]), np.int64, n * len(fresh)).reshape(-1, n)
                new_ranks, new_made = self._looked_up(new[:, :-1], new[:, 1:])
                rows, symbols = np.concatenate((rows, fresh)), np.concatenate((symbols, new))
                ranks, made = np.concatenate((ranks, new_ranks)), np.concatenate((made, new_made))
            if not len(rows):
                continue
            # The head of an agenda is the lowest rank, leftmost among equals.
            head = ranks.argmin(axis=1) if n > 1 else np.zeros(len(rows), np.int64)
            done = ranks[np.arange(len(rows)), head] == _NONE if n > 1 else np.ones(len(rows), bool)
            if done.any():
                final = symbols[done]
                plain = (final < self.first_other).all(axis=1)
                data = final.astype(np.int32).tobytes()
                for k, i in enumerate(rows[done].tolist()):
                    out[i] = data[4 * n * k : 4 * n * (k + 1)] if plain[k] else self._finished(final[k].tolist())
            go = ~done
            rows, symbols, ranks, made, head = rows[go], symbols[go], ranks[go], made[go], head[go]
            if not len(rows):
                symbols, ranks, made = symbols[:, 1:], ranks[:, 1:], made[:, 1:]
                continue
            every = np.arange(len(rows))
            symbols[every, head] = made[every, head]
            keep = np.arange(n) != (head + 1)[:, None]
            symbols = symbols[keep].reshape(len(rows), n - 1)
            keep = np.arange(n - 1) != head[:, None]
            ranks, made = ranks[keep].reshape(len(rows), n - 2), made[keep].reshape(len(rows), n - 2)
            # The pairs on both sides of the new symbol are proposed.
            for at, some in ((head - 1, head > 0), (head, head < n - 2)):
                r, a = every[some], at[some]
                ranks[r, a], made[r, a] = self._looked_up(symbols[r, a], symbols[r, a + 1])
        return out


class Encoder:
    """Encodes texts chunk by chunk. `check` compares every new chunk with the library."""

    def __init__(self, model: bytes, check: bool = True):
        self.words = Vocabulary(model)
        self.check = check
        #: Ids by chunk: `marked` holds chunks with one mark in front under their name without it.
        self.marked: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def _chunks(self, text: str) -> list[tuple[dict[str, bytes], list[str]]]:
        """The chunks of a text in order, as stretches of one kind."""
        if not self.words.apart:
            return [(self.bare, [MARK + text.replace(" ", MARK)])]
        out = []
        for k, line in enumerate(text.split("\n") if self.words.newline else [text]):
            if k:
                out.append((self.bare, ["\n"]))
            names = line.split(" ")
            if MARK in line or "" in names:
                # Several marks in a row belong to the chunk behind them.
                found = _CHUNK.findall(("" if k else MARK) + line.replace(" ", MARK))
                out.append((self.bare, found))
            elif k:
                out += [(self.bare, names[:1]), (self.marked, names[1:])]
            else:
                out.append((self.marked, names))
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids (32-bit) of whole texts, without begin or end ids; an empty text has none."""
        parts = [self._chunks(t) if t else [] for t in texts]
        new_marked: dict[str, None] = {}
        new_bare: dict[str, None] = {}
        for stretch in parts:
            for known, names in stretch:
                into = new_marked if known is self.marked else new_bare
                for name in names:
                    if name not in known:
                        into[name] = None
        if new_marked or new_bare:
            self._learn(list(new_marked), list(new_bare))
        out = [b"".join([ids for known, names in stretch for ids in map(known.__getitem__, names)]) for stretch in parts]
        for known in (self.marked, self.bare):
            if len(known) > REMEMBERED:
                for name in list(known)[: len(known) // 2]:
                    del known[name]
        return out

    def _learn(self, marked: list[str], bare: list[str]) -> None:
        """Encode new chunks and compare them with the library; an unequal one is an error."""
        chunks = [MARK + c for c in marked] + bare
        found = self.words.merge_all(chunks)
        if self.check:
            self._verify(chunks, found)
        self.marked.update(zip(marked, found))
        self.bare.update(zip(bare, found[len(marked) :]))

    def _verify(self, chunks: list[str], found: list[bytes]) -> None:
        # The library puts a mark in front, so a chunk with one is given without; one without follows
        # a newline, whose ids are then cut off.
        library = self.words.library
        lead = len(library.encode("\n")) if self.words.newline else 0
        outer = [i for i, c in enumerate(chunks) if c.startswith(MARK) or not lead]
        inner = [i for i, c in enumerate(chunks) if lead and not c.startswith(MARK)]
        want: dict[int, list[int]] = dict(zip(outer, library.encode([chunks[i].removeprefix(MARK) for i in outer], num_threads=1)))
        want |= {i: ids[lead:] for i, ids in zip(inner, library.encode(["\n" + chunks[i] for i in inner], num_threads=1))}
        for i in outer:
            # A text that is a mark alone cannot be given; it stands in front of a newline.
            if chunks[i] == MARK:
                want[i] = library.encode("\n")[: lead - 1] if lead else [self.words.ids[MARK]]
        order = range(len(chunks))
        sizes = np.fromiter((len(want[i]) for i in order), np.int64, len(chunks))
        flat = np.fromiter(chain.from_iterable(want[i] for i in order), np.int32, int(sizes.sum()))
        same = np.array_equal(sizes * 4, np.fromiter(map(len, found), np.int64, len(found))) and b"".join(found) == flat.tobytes()
        if not same:
            i = next(i for i in order if np.frombuffer(found[i], np.int32).tolist() != want[i])
            raise ValueError(f"chunk {chunks[i]!r}: {np.frombuffer(found[i], np.int32).tolist()} here, {want[i]} in the library")


#: The encoders of a worker process, by model and check: tasks that it runs one after another share them.
_ENCODERS: dict[tuple[bytes, bool], Encoder] = {}


def encoder(model: bytes, check: bool = True) -> Encoder:
    key = (hashlib.sha256(model).digest(), check)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model, check)
    return _ENCODERS[key]


def encode(df: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           check: bool = True, decode: bool = True) -> DataFrame:
    """The `keep` columns, `ids` (array<int>) and `decoded` (the library's decode of the ids).

    A null text counts as empty and has no ids. Texts are encoded whole; a task handles a few MB of
    them at a time. The model is read once where the query is built and travels with the tasks
    (a vocabulary file, of fixed size). Columns beside `keep` are not read.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    rows = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = encoder(model, check)
        for batch in batches:
            for piece in tokens.pieces(batch, "_text", 1 << 20):
                found = worker.encode_all(piece.column("_text").to_pylist())
                cuts = np.concatenate(([0], np.cumsum([len(f) // 4 for f in found]))).astype(np.int32)
                flat = np.frombuffer(b"".join(found), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))
                lists = [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] if decode else []
                decoded = pa.array(worker.words.library.decode(lists) if decode else [None] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], ids, decoded], [*piece.schema.names[:-1], "ids", "decoded"])

    schema = ", ".join(f"k{i} {kind}" for i, (_, kind) in enumerate(df.select(*[f"`{c}`" for c in keep]).dtypes))
    out = rows.mapInArrow(run, ", ".join(filter(None, [schema, "ids array<int>, decoded string"])))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "ids", "decoded")
