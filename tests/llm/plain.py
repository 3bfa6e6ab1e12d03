"""Plain-Python versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def blank_words(text):
    return BLANK.findall((text or "").translate(LOWER))


def plain_words(text):
    return PLAIN.findall((text or "").translate(LOWER))


def shingles(text, size):
    w = blank_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def windows(w, size):
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def contamination(docs, items, size=13):
    """doc_id -> (n_words, n_hit, n_items, items_sha256, contaminated)"""
    where: dict = {}
    for item, text in items:
        for window in windows(plain_words(text), size):
            where.setdefault(window, set()).add(item)
    sizes = {len(window) for window in where}
    out = {}
    for doc, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                window = tuple(w[i : i + n])
                if window in where:
                    hit.update(range(i, i + n))
                    found |= where[window]
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out
