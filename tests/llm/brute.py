"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate(_LOWER)


def alnum(text):
    return _ALNUM.findall(lower(text))


def spaced(text):
    return _SPACED.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hits(text, items, size=10):
    """Per word whether it is hit, and the ids of items hit."""
    words = alnum(text)
    hit, found = [False] * len(words), set()
    for item, item_text in items:
        w = alnum(item_text)
        m = min(size, len(w))
        windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
        for i in range(len(words) - m + 1 if m else 0):
            if tuple(words[i : i + m]) in windows:
                hit[i : i + m] = [True] * m
                found.add("" if item is None else str(item))
    return hit, found


def contamination(docs, items):
    out = Counter()
    for doc_id, text in docs:
        hit, found = hits(text, items)
        out[(doc_id, len(hit), sum(hit), len(found), sha(",".join(sorted(found))), any(hit))] += 1
    return out


def decontaminate(docs, items, most=0.5):
    out = []
    for doc_id, text in docs:
        hit, _ = hits(text, items)
        if sum(hit) > most * len(hit):
            continue
        if any(hit):
            places = [m.span() for m in _ALNUM.finditer(lower(text))]
            at, kept = 0, ""
            for i, h in enumerate(hit):
                if h and (i == 0 or not hit[i - 1]):
                    kept += text[at : places[i][0]]
                if h:
                    at = places[i][1]
            text = kept + text[at:]
        out.append((doc_id, text))
    return out


def repeated(texts, size=35):
    """Per text and word whether it stays."""
    words = [spaced(t) for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    keep = []
    for w in words:
        k = [True] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                k[i : i + size] = [False] * size
        keep.append(k)
    return words, keep


def shingles(text, size=5):
    w = spaced(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def clusters(docs):
    """Per row: doc_id, size of its set, component, kept."""
    sets = [shingles(t) if i is not None else frozenset() for i, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, s in enumerate(sets):
        if s:
            r = root(i)
            least[r] = min(least.get(r, docs[i][0]), docs[i][0])
    out = []
    for i, (doc_id, text) in enumerate(docs):
        component = least[root(i)] if sets[i] else doc_id
        out.append((doc_id, len(shingles(text)), component, doc_id is None or doc_id == component))
    return out


def pieces(docs, encode, length=4096, end=1):
    """Per piece: doc_id, piece, start, length, crc32."""
    out = Counter()
    for doc_id, text in docs:
        ids = [*encode(text or ""), end]
        for i in range(0, len(ids), length):
            part = ids[i : i + length]
            out[(doc_id, i // length, i, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    return out
