"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def low(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def lettered(text: str | None) -> list[str]:
    return LETTERED.findall(low(text))


def components(n: int, links) -> list[int]:
    """Smallest index reachable from each of n nodes."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = SPACED.findall(low(text).encode())
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def similar(rows: list[tuple]) -> list[tuple[int, object]]:
    """(set size, component_id) by row; rows are (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    group = components(len(rows), links)
    least = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [(len(s), least.get(g)) for s, g in zip(sets, group, strict=True)]


def without_repeats(rows: list[tuple], window: int) -> list[tuple[int, int, str]]:
    words = [SPACED.findall((t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        covered = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                covered.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in covered]
        out.append((len(w), len(covered), sha(b" ".join(kept))))
    return out


def contaminated(rows: list[tuple], items: list[tuple], size: int = 10) -> list[tuple]:
    windows: dict[tuple, set[str]] = {}
    for item, text in items:
        w = lettered(text)
        for i in range(max(len(w) - size + 1, 1 if w else 0)):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for _, text in rows:
        w, hit, found = lettered(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def licenses(text: str | None) -> tuple:
    words, places, labels = lettered(text), [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in doubled) % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            out.append((3, *m.span()))
    return out


def cut_lines(rows: list[tuple], run: int = 3) -> list[tuple[int, int, str]]:
    """(lines, removed, text left) by row, for rows in the order of their ids."""
    full = [[i for i, x in enumerate((t or "").split("\n")) if x] for _, t in rows]
    lines = [(t or "").split("\n") for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for d, places in enumerate(full):
        for i in range(len(places) - run + 1):
            at = places[i : i + run]
            key = tuple(lines[d][p] for p in at)
            if key in seen:
                gone[d].update(at)
            seen.add(key)
    return [
        (len(f), len(g), "\n".join(x for i, x in enumerate(ls) if i not in g) if g else (t or ""))
        for f, g, ls, (_, t) in zip(full, gone, lines, rows, strict=True)
    ]
