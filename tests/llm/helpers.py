"""Brute-force versions of the operators' results and rows with awkward cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORDS = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORDS.findall(low(text))


def held_out(doc_id, parts, part):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % parts == part


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, size):
    w = words(text)
    if len(w) >= size:
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def near_duplicates(rows, size, percent=80):
    """Rows (doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = [(d, shingle_set(t, size)) for d, t in rows]
    ids = {d for d, _ in sets if d is not None}
    links = []
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= percent * len(s | t):
                links.append((a, b))
    root = components(ids, links)
    return sorted(((d, len(s), root.get(d), d is None or root[d] == d) for d, s in sets), key=str)


def substrings(rows, width=13):
    """Rows (doc_id, n_words, n_removed, kept_sha256)."""
    cut = [(d, WORDS.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in cut:
        for i in range(len(w) - width + 1):
            if d is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in cut:
        gone = set()
        for i in range(len(w) - width + 1):
            source = first.get(tuple(w[i : i + width]))
            if source is not None and (d is None or source < d):
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def unigrams(rows, train):
    """{row number: (n_tokens, n_known, train_tokens, base score)}."""
    cut = [words(t) + [None] for _, t in rows]
    counts = Counter(x for (d, _), w in zip(rows, cut, strict=True) if train(d) for x in w)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
        for i, w in enumerate(cut)
    }


AWKWARD = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, None), (3, ""), (4, " \n\t "), (5, "word"), (6, "Ünïcödé wörds änd 漢字 \U0001f600 here"),
    (7, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (7, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (None, None), (8, "x" * 20000), (9, "a b " * 4000), (10, "0 1 2 !! ?? 3"), (11, "the nul \x00 and \x0b \x0c \x1c \x85 end"),
]
