"""Plain versions of the corpus operators, to hold them against on small tables."""

from __future__ import annotations

from collections import Counter, defaultdict


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < k else [tuple(words[i : i + k]) for i in range(len(words) - k + 1)])


def near_components(docs, k, percent):
    """{id: (set size, least id reachable)} of {id: text}."""
    sets = {d: shingles(t, k) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in docs}


def without_repeats(texts, length):
    """Each text's bytes without those covered by a string of length bytes that starts elsewhere."""
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        out.append(bytes(b for i, b in enumerate(t) if i not in gone))
    return out


def line_dedup(docs, least=10):
    """{id: text} without lines that a smaller id holds."""
    key = lambda line: line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for d, t in docs.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(d)
    keep = lambda d, line: len(key(line)) < least or min(holders[key(line)]) == d
    return {d: "\n".join(line for line in (t or "").split("\n") if keep(d, line)) for d, t in docs.items()}
