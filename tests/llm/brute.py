"""Plain versions of the operators, one document or pair at a time, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, fold=True):
    text = text or ""
    return SPACED.findall(text.translate(FOLD) if fold else text)


def shingle_set(text, size=5):
    w = words(text)
    if not w:
        return set()
    if len(w) < size:
        return {tuple(w)}
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def substring_dedup(docs, window=50):
    """{(doc_id): (n_words, n_removed, sha256 of the kept words)} of (doc_id, text) rows."""
    own = {i: words(t, fold=False) for i, t in docs}
    first = {}
    for i in sorted(own):
        w = own[i]
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p:p + window]), i)
    out = {}
    for i, w in own.items():
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def near_components(docs):
    """{doc_id: (set size, smallest doc_id reachable)} with links at 100 * intersection >= 75 * union."""
    sets = {i: shingle_set(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = Counter((a, b) for own in holders.values() for k, a in enumerate(own) for b in own[k + 1:])
    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_places(text, phrases):
    w = LICENSE_WORD.findall((text or "").translate(FOLD))
    found = [(i, label) for phrase, label in phrases.items() for p in [phrase.split()]
             for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(found)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best_window_distance(item, text_words):
    """Smallest edit distance of the item to any run of consecutive words."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for x in text_words:
        last, row[0] = row[0], 0
        for j, y in enumerate(item, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        best = min(best, row[-1])
    return best


def runs(sequence, least=12):
    """Sorted (start, end, smallest period) of all maximal repetitions, one period after the other."""
    n, found = len(sequence), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if sequence[i] != sequence[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and sequence[i] == sequence[i + q]:
                i += 1
            if i - start >= q and i + q - start >= least:
                found.setdefault((start, i + q), q)
    return sorted((s, e, q) for (s, e), q in found.items())
