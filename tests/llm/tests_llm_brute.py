"""Brute-force versions shared by the tests of this folder."""

from __future__ import annotations

import hashlib
import itertools
import re

import xxhash


def brute_simhash(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, budget=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= budget:
            root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(ids))]


def brute_contamination(docs, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for s in range(len(w) - n + 1) if n else ():
            grams.setdefault(tuple(w[s : s + n]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                if (of := grams.get(tuple(w[s : s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= of
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_base(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
