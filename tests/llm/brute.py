"""Plain Python versions of the contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    found.sort()
    kinds = ("assign", "access", "hex")
    base = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
    counts = Counter(k for _, k, _ in found)
    return counts[0], counts[1], counts[2], hashlib.sha256(base.encode()).hexdigest()


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def targets(rows: list[tuple[str | None, int]]) -> dict[str | None, tuple[int, Fraction]]:
    """(source, size) rows to source -> (size, target), by sharing again and again."""
    sizes: dict[str | None, int] = defaultdict(int)
    for source, size in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, target, open_ = Fraction(3, 2) * sum(sizes.values()), dict.fromkeys(names, Fraction(0)), set(names)
    while rest and open_:
        whole = sum(weight[s] for s in open_)
        share = rest
        rest = Fraction(0)
        for s in open_:
            target[s] += share * weight[s] / whole
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = Fraction(2 * sizes[s])
                open_.remove(s)
    return {s: (sizes[s], target[s]) for s in names}


def shingles(text: str | None, n: int = 4) -> frozenset:
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(lower)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    pairs = {(a, b) for ds in by.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 85 * (len(sets[a]) + len(sets[b]) - inter):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in texts}


def repeats(texts: dict[int, str | None], k: int = 100) -> dict[int, tuple[int, int, int, str]]:
    seen, out = set(), {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - k + 1):
            w = data[i : i + k]
            if w in seen:
                gone[i : i + k] = b"\x01" * k
            seen.add(w)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[d] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def line_base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        dup,
        len(covered),
        len(w) < 10 or 100 * len(covered) > 20 * len(w),
    )
