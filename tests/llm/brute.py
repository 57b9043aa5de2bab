"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def closure(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def near_copies(docs, size, percent=80):
    sets = {}
    for d, t in docs:
        w = WORD.findall(low(t))
        k = min(size, len(w))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    ids = sorted(sets)
    edges = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    c = closure(ids, edges)
    return {d: (len(sets[d]), c[d], c[d] == d) for d in ids}


def repeats(docs, window=35):
    text = [(d, WORD.findall(t or "")) for d, t in docs]
    seen = defaultdict(int)
    for _, w in text:
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] += 1
    out = []
    for d, w in text:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def near_vectors(rows, threshold=0.9):
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = x / np.linalg.norm(x)
    ids = sorted(good)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold]
    links = defaultdict(int)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    c = closure([i for i, _ in rows], edges)
    return {i: (links[i], c[i], c[i] == i) for i, _ in rows}
