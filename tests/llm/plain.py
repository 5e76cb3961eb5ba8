"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
from collections import Counter


def ascii_words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def shingles(text: str | None, n: int) -> frozenset:
    words = ascii_words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def near_components(docs: dict[int, str | None], n: int, percent: int) -> dict[int, int]:
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = {i: shingles(t, n) for i, t in docs.items()}
    for i in docs:
        for j in docs:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in docs}


def repeats(docs: list[tuple[int | None, str | None]], length: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """Kept bytes and removed spans of each row."""
    first: dict[bytes, int] = {}
    for i, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - length + 1 if i is not None else 0):
            w = data[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1 if i is not None else 0):
            if first[data[p:p + length]] < i:
                gone[p:p + length] = [True] * length
        spans, p = [], 0
        while p < len(data):
            e = p
            while e < len(data) and gone[e] == gone[p]:
                e += 1
            if gone[p]:
                spans.append((p, e))
            p = e
        out.append((bytes(b for b, g in zip(data, gone) if not g), spans))
    return out


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    words, text = ascii_words(text), text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if ascii_words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def aligned(item: list[str], text: list[str], match: float, mismatch: float, gap: float) -> float:
    best, row = 0.0, [0.0] * (len(text) + 1)
    for x in item:
        new = [0.0]
        for j, y in enumerate(text):
            new.append(max(0.0, row[j] + (match if x == y else mismatch), row[j + 1] + gap, new[j] + gap))
        row, best = new, max(best, *new)
    return best


def losses(docs: dict[int, str], target: set[int], mixed: float, added: float) -> dict[int, tuple[float, float]]:
    words = {i: ascii_words(t.lower()) for i, t in docs.items()}
    models = [docs.keys() & target, set(docs)]
    vocabulary = len({w for ws in words.values() for w in ws})
    out = {}
    for i, ws in words.items():
        pair = []
        for members in models:
            rest = [words[j] for j in members if j != i]
            one = Counter(w for r in rest for w in r)
            two = Counter(p for r in rest for p in zip(r, r[1:]))
            loss = 0.0
            for k, w in enumerate(ws):
                p = (one[w] + added) / (sum(one.values()) + added * vocabulary)
                if k:
                    p = (two[ws[k - 1], w] + mixed * p) / (one[ws[k - 1]] + mixed)
                loss -= math.log(p)
            pair.append(loss / max(1, len(ws)))
        out[i] = tuple(pair)
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
