"""Brute-force versions of the operators, in plain Python over rows held in memory."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower_az(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def simhash(text, size=3) -> int:
    found = words(lower_az(text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n: int, pairs) -> list[int]:
    """Smallest member of the component of 0 .. n-1."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def simhash_components(rows: list[tuple], radius=2) -> list[tuple]:
    """(id, fingerprint, component) of (id, text) rows; identifiers may be null."""
    prints = [simhash(text) for _, text in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    root = roots(len(rows), pairs)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root)]


def repeats(rows: list[tuple], length=35) -> list[tuple]:
    """(id, words, words removed, digest of kept words)."""
    texts = [words(t) for _, t in rows]
    starts = defaultdict(list)
    for k, found in enumerate(texts):
        for i in range(len(found) - length + 1):
            starts[tuple(found[i : i + length])].append((k, i))
    gone = [set() for _ in rows]
    for places in starts.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + length))
    return [(i, len(w), len(g), sha(" ".join(x for j, x in enumerate(w) if j not in g)))
            for (i, _), w, g in zip(rows, texts, gone)]


def base_statistics(text) -> tuple:
    text = text or ""
    found = words(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    again = {j for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(again) > 50 * len(found)
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(again), failed)


def conversation(rows: list[tuple]) -> tuple:
    """(turns, digest of turns, loss characters, digest of loss) of (turn, role, text) rows."""
    rows = sorted((t, r or "", x or "") for t, r, x in rows)
    loss = "".join(x for _, r, x in rows if r == "assistant")
    return (len(rows), sha("".join(f"{r}\n{x}\n" for _, r, x in rows)), len(loss), sha(loss))


def url_parts(url) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower_az(host), re.match(r"[^?#]*", rest[len(host):])[0]


def url_rule(host: str, path: str, rules: list[tuple]) -> tuple:
    """(rule, verdict) of the longest (verdict, host, path) that fits, else (None, None)."""
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fits)[2], max(fits)[3]) if fits else (None, None)
