"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def repeated_bytes(rows, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, digest of what is left)}"""
    first = {}
    texts = {i: (t or "").encode() for i, t in rows}
    for i in sorted(texts):
        for p in range(len(texts[i]) - length + 1):
            first.setdefault(texts[i][p : p + length], i)
    found = {}
    for i, data in texts.items():
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for q in range(len(data)) if gone[q] and (q == 0 or not gone[q - 1]))
        found[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(data, gone) if not g)).hexdigest())
    return found


def without_repeated_words(rows, length=50):
    """{doc_id: text without runs of words that start in an earlier document}"""
    words = {i: [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")] for i, t in rows}
    texts, first = dict(rows), {}
    run = lambda i, p: tuple(texts[i][a:b] for a, b in words[i][p : p + length])
    for i in sorted(texts):
        for p in range(len(words[i]) - length + 1):
            first.setdefault(run(i, p), i)
    found = {}
    for i in texts:
        gone = [False] * len(words[i])
        for p in range(len(words[i]) - length + 1):
            if first[run(i, p)] < i:
                gone[p : p + length] = [True] * length
        found[i] = texts[i] and cut(texts[i], words[i], gone)
    return found


def cut(text, places, gone):
    """``text`` without each run of marked places, from its first to its last character."""
    kept, at, p = [], 0, 0
    while p < len(places):
        if gone[p]:
            q = p
            while q + 1 < len(places) and gone[q + 1]:
                q += 1
            kept.append(text[at : places[p][0]])
            at, p = places[q][1], q
        p += 1
    return "".join([*kept, text[at:]])


def near_duplicates(rows, k, percent):
    """{doc_id: (size of the set, smallest id of its component)}"""
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        n = min(k, len(words))
        sets[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if n else set()
    parent, holders = {i: i for i in sets}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = defaultdict(int)
        for element in sets[i]:
            for j in holders[element]:
                common[j] += 1
            holders[element].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def benchmark_hits(rows, items, n=10):
    """{doc_id: (words, hit places, item names)}"""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: [(m.start(), m.end(), m.group()) for m in pattern.finditer((t or "").translate(LOWER))]
    windows = defaultdict(set)
    for name, text in items:
        words = [w for _, _, w in split(text)]
        size = min(n, len(words))
        for p in range(len(words) - size + 1) if size else ():
            windows[tuple(words[p : p + size])].add(str(name))
    sizes = {len(w) for w in windows}
    found = {}
    for i, t in rows:
        places = split(t)
        words, hit, names = [w for _, _, w in places], set(), set()
        for size in sizes:
            for p in range(len(words) - size + 1):
                if got := windows.get(tuple(words[p : p + size])):
                    hit.update(range(p, p + size))
                    names |= got
        found[i] = (places, hit, names)
    return found


def top_k(rows, is_query, k=5):
    """[(query_id, rank, vec_id, score)]"""
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.setdefault(i, [int(np.floor(256 * float(x))) for x in v])
    out = []
    for q in usable:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1


def auc(scores, labels):
    """Share of (1, 0) pairs in the right order."""
    order = np.argsort(scores, kind="stable")
    ranked = np.asarray(scores)[order]
    rank = np.empty(len(order))
    first, last = np.searchsorted(ranked, ranked, "left"), np.searchsorted(ranked, ranked, "right")
    rank[order] = (first + last + 1) / 2
    labels = np.asarray(labels)
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))
