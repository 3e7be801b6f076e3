"""Plain versions of the operators' contracts for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def similar(docs):
    """{doc_id: (n_shingles, component_id)} of [(doc_id, text)]."""
    sets = {i: shingles(t) for i, t in docs}
    ids, links, at = sorted(sets), [], {}
    for i in ids:
        for s in sets[i]:
            at.setdefault(s, []).append(i)
    for i in ids:
        shared = {}
        for s in sets[i]:
            for j in at[s]:
                if j > i:
                    shared[j] = shared.get(j, 0) + 1
        links += [(i, j) for j, n in shared.items() if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n)]
    part = components(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}


def dedup(docs, width=20):
    """{doc_id: (n_words, n_removed, kept_sha256)} of [(doc_id, text)]."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
