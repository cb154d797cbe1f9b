"""First match against an ordered dictionary, as one regular expression per row.

Names are written as a tree of their common beginnings, so a match costs the length of the text it
follows, not the number of names. A name behind another one that begins it can never be the first
to match and is left out; of what remains the first to match is the longest, which is what the
greedy tree finds. For "first entry contained anywhere" a look-ahead reports the first entry at
every position and the lowest rank wins. An empty dictionary matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = frozenset("\\.[]{}()*+?^$|&-#~")


def _folded(entries: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(name.lower() for name in entries))


def _tree(names: Sequence[str]) -> dict:
    """Characters below characters; the empty key ends a name. An empty name ends the root."""
    root: dict = {}
    for name in names:
        node = root
        for character in name:
            if "" in node:  # an earlier name begins this one
                break
            node = node.setdefault(character, {})
        else:
            node[""] = {}
    return root


def _pattern(node: dict) -> str:
    """The longest path through the tree, as a greedy pattern."""
    branches = [("\\" if c in _SPECIAL else "") + c + _pattern(below) for c, below in node.items() if c]
    if not branches:
        return ""
    joined = branches[0] if len(branches) == 1 and "" not in node else "(?:" + "|".join(branches) + ")"
    return joined + "?" if "" in node else joined


def _mapping(keys: Sequence[str], values: Sequence) -> Column:
    return F.create_map(*[F.lit(x) for pair in zip(keys, values) for x in pair])


def longest_first(entries: Sequence[str]) -> list[str]:
    return sorted(dict.fromkeys(entries), key=lambda name: -len(name))


def first_prefix(text: Column, entries: Sequence[str]) -> Column:
    """First entry (in its own spelling) with which the text starts, case-blind; else null."""
    names = _folded(entries)
    if not names:
        return F.lit(None).cast("string")
    spelling: dict[str, str] = {}
    for name in entries:
        spelling.setdefault(name.lower(), name)
    found = F.regexp_extract(F.lower(text), f"^({_pattern(_tree(names))})", 1)
    return F.try_element_at(_mapping(names, [spelling[n] for n in names]), found)


def contained_rank(text: Column, entries: Sequence[str]) -> Column:
    """1-based rank of the first entry contained in the text, case-blind; else null."""
    names = _folded(entries)
    if not names:
        return F.lit(None).cast("int")
    rank = _mapping(names, list(range(1, len(names) + 1)))
    found = F.regexp_extract_all(F.lower(text), F.lit(f"(?=({_pattern(_tree(names))}))"), F.lit(1))
    return F.array_min(F.transform(found, lambda name: F.try_element_at(rank, name)))


def first_contained(text: Column, entries: Sequence[str]) -> Column:
    distinct: dict[str, str] = {}
    for name in entries:
        distinct.setdefault(name.lower(), name)
    if not distinct:
        return F.lit(None).cast("string")
    values = F.array(*[F.lit(name) for name in distinct.values()])
    return F.get(values, contained_rank(text, entries) - 1)
