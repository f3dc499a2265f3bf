"""Brute-force versions the operators are held against."""

from __future__ import annotations

import hashlib
import itertools
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def remove_repeats(rows, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} by looking at every string."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            piece = raw[i:i + length]
            if piece in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(piece)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, sha(kept))
    return out


def word_sets(rows, n):
    out = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
        out[doc_id] = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def jaccard_components(rows, n, num, den):
    """{doc_id: (set size, least doc_id reachable)} from all pairs."""
    sets = word_sets(rows, n)
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and den * len(x & y) >= num * len(x | y):
            up[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(docs, bench):
    """{doc_id: (n_words, n_hit, sorted item ids)} from all windows."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows: dict = {}
    for item, text in bench:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    sizes, out = {len(x) for x in windows}, {}
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (got := windows.get(tuple(w[i:i + k]))) is not None:
                    hit.update(range(i, i + k))
                    items |= got
        out[doc_id] = (len(w), len(hit), sorted(str(i) for i in items if i is not None))
    return out


def exact_groups(rows):
    """{doc_id: (keep_id, group_size)} for unique ids."""
    groups: dict = {}
    for doc_id, text in rows:
        groups.setdefault(low(text), []).append(doc_id)
    return {i: (max(g), len(g)) for g in groups.values() for i in g}
