"""Plain Python statements of what the operators return."""

import hashlib
from collections import Counter, defaultdict


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def shingles(text):
    w = words(text, True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])


def near_components(texts):
    """doc_id -> (set size, smallest reachable doc_id)."""
    sets = {d: shingles(t) for d, t in texts.items()}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    where = defaultdict(list)
    for d in sorted(sets):
        common = Counter(o for s in sets[d] for o in where[s])
        for o, n in common.items():
            if 100 * n >= 75 * (len(sets[d]) + len(sets[o]) - n):
                a, b = root(o), root(d)
                up[max(a, b)] = min(a, b)
        for s in sets[d]:
            where[s].append(d)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def without_repeats(texts, window=50):
    """doc_id -> (words, removed, text of the kept words)."""
    first = {}
    split = {d: words(t) for d, t in texts.items()}
    for d in sorted(split):
        for i in range(len(split[d]) - window + 1):
            first.setdefault(tuple(split[d][i : i + window]), d)
    out = {}
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def sha(text):
    return hashlib.sha256(text).hexdigest()
