"""Plain versions of operators that SQL cannot express, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def jaccard_components(rows, n, percent):
    """{row number: (n_shingles, component_id)} of ``rows`` (doc_id, text), every pair compared."""
    sets = [shingle_set(text, n) for _, text in rows]
    parent = {doc: doc for doc, _ in rows if doc is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            small, large = sorted((len(sets[i]), len(sets[j])))
            if 100 * small < percent * large:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(rows[i][0]), root(rows[j][0])))
                parent[b] = a
    return [(doc, len(s), None if doc is None else root(doc)) for (doc, _), s in zip(rows, sets, strict=True)]


def remove_repeats(rows, width):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of ``rows`` (doc_id, text)."""
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    least = {}
    for doc, data in texts:
        if doc is not None:
            for i in range(len(data) - width + 1):
                piece = data[i : i + width]
                if least.get(piece, doc) >= doc:
                    least[piece] = doc
    out = []
    for doc, data in texts:
        gone = bytearray(len(data))
        if doc is not None:
            for i in range(len(data) - width + 1):
                if least[data[i : i + width]] < doc:
                    gone[i : i + width] = b"\x01" * width
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
