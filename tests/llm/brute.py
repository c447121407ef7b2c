"""Plain Python versions of the operators that need hashing, sorting or models on Spark."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def windows(rows, k=13):
    """rows (doc_id, text) -> (doc_id, n_words, n_removed, kept_sha256) of each row."""
    least = {}
    key = lambda i: (i is None, i or 0)
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for j in range(len(w) - k + 1):
            x = tuple(w[j:j + k])
            least[x] = min(least.get(x, key(i)), key(i))
    out = Counter()
    for i, w in words:
        gone = set()
        for j in range(len(w) - k + 1):
            if least[tuple(w[j:j + k])] < key(i):
                gone.update(range(j, j + k))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def byte_strings(rows, least=200, keep="none"):
    """rows -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256); keep="first": rows in order of doc_id."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    if keep == "first":
        texts.sort(key=lambda r: (r[0] is None, r[0] or 0))
    times, first = Counter(), {}
    for n, (_, b) in enumerate(texts):
        for p in range(len(b) - least + 1):
            s = b[p:p + least]
            times[s] += 1
            first.setdefault(s, (n, p))
    out = Counter()
    for n, (i, b) in enumerate(texts):
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            s = b[p:p + least]
            if times[s] > 1 and (keep == "none" or first[s] != (n, p)):
                gone[p:p + least] = b"\1" * least
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        out[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def shingle_set(t, n):
    w = WORD.findall(low(t))
    if not w:
        return frozenset()
    return frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows, n=3, percent=90):
    """rows -> (doc_id, n_shingles, component_id) of each row."""
    sets = [shingle_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    at = defaultdict(list)
    for d, s in enumerate(sets):
        for x in s:
            at[x].append(d)
    common = Counter()
    for ds in at.values():
        for a in range(len(ds)):
            for b in range(a):
                common[ds[b], ds[a]] += 1
    for (a, b), both in common.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    smallest = {}
    for d, (i, _) in enumerate(rows):
        r = find(d)
        if i is not None:
            smallest[r] = min(smallest.get(r, i), i)
    return Counter((i, len(sets[d]), smallest.get(find(d)) if sets[d] else i) for d, (i, _) in enumerate(rows))
