"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Classes:
    """Union-find; a class is named by its smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def find(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def repeats(rows, length=400):
    """[(id, n_bytes, n_removed, n_spans, kept)] of [(id, text)]."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone, end = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                for j in range(max(end, k), k + length):
                    gone[j] = 1
                end = k + length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shingles(text, n=5):
    w = WORD.findall(text)
    return collections.Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else collections.Counter()


def probability_jaccard(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in set(a) & set(b))


def near_classes(rows, threshold=0.8):
    """{id: class id} of [(id, text)]."""
    classes, first = Classes([i for i, _ in rows]), {}
    for i, t in rows:
        if t is not None:
            if t in first:
                classes.union(i, first[t])
            else:
                first[t] = i
    sets = {i: shingles(t) for t, i in first.items()}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for k in s:
            where[k].append(i)
    common = collections.Counter((a, b) for ids in where.values() for n, a in enumerate(ids) for b in ids[n + 1 :])
    for (a, b), n in common.items():
        if n >= 0.2 * min(len(sets[a]), len(sets[b])) and probability_jaccard(sets[a], sets[b]) >= threshold - 1e-12:
            classes.union(a, b)
    return {i: classes.find(i) for i, _ in rows}


def measures(text):
    x = text or ""
    w = WORD.findall(x)
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(8)}
    lines = [line for line in x.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(covered)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
