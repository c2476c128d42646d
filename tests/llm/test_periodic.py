"""Periodic runs against a brute-force search."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

from tillstar.llm import periodic, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, start string, period int, n_words string"


def brute_runs(w, least_periods=2, least=0):
    """Every maximal stretch by trying all periods."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                found[i, j + q] = min(q, found.get((i, j + q), q))
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in found.items() if e - s >= max(least, least_periods * q))


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def brute_row(words, found):
    best = min(found, key=lambda r: (-Fraction(r[2] - r[0], r[1]), r[0], r[1]), default=None)
    gone = {i for s, q, e in found for i in range(s + q, e)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    cols = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
    return len(found), *cols, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def columns(r):
    return r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256


def brute_planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_of_random_words_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        docs = [[rng.choice([b"a", b"b", b"c"][: rng.randint(1, 3)]) for _ in range(rng.randint(0, 45))] for _ in range(rng.randint(1, 5))]
        symbols, begins = periodic.numbered(docs)
        start, end, q = periodic.runs(symbols)
        got = sorted(zip(start.tolist(), q.tolist(), end.tolist()))
        assert got == sorted((s + b, p, e + b) for b, d in zip(begins.tolist(), docs) for s, p, e in brute_runs(d))


def test_suffix_array_is_sorted():
    rng = random.Random(9)
    for _ in range(50):
        symbols, _ = periodic.numbered([[rng.choice([b"x", b"y"]) for _ in range(rng.randint(0, 60))] for _ in range(3)])
        sa, isa, rounds = periodic.suffix_array(symbols)
        s = symbols.tolist()
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:]) and isa[sa].tolist() == list(range(len(s)))
        got = periodic.shared_ahead(rounds, sa[:-1], sa[1:]).tolist()
        for (a, b), n in zip(zip(sa[:-1].tolist(), sa[1:].tolist()), got):
            assert s[a : a + n] == s[b : b + n] and s[a + n] != s[b + n]


def test_rows_equal_brute_force_on_odd_texts(spark):
    rng = random.Random(2)
    texts = [
        None, "", " \t\n ", "one", "a a a a a", "a a a a a a", "a\x0ba\fa\ra a\na b", "la la la la la la da", "a\x1fa a\x85a",
        "x " * 5000, "so it goes " * 900 + "end", "A a " * 6, "a b a b a b a b c a b a b a b a b", "1 2 3 4 5 6 7 8",
    ]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(60)]
    rows = [(i, t, "s", 1, "n") for i, t in enumerate(texts)] + [(None, "a " * 9, "s", None, None), (4, texts[4], "s", 1, "n")]
    got = periodic.periodic_runs(spark.createDataFrame(rows, DOCS), min_periods=4, min_length=6).collect()
    assert len(got) == len(rows)
    want = {}
    for doc_id, text, *_ in rows:
        words = words_of(text)
        want[doc_id] = brute_row(words, brute_runs(words, 4, 6))
    for r in got:
        assert columns(r) == want[r.doc_id], r.doc_id


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []


def test_query_equals_brute_force_on_its_table(spark):
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    several = 0
    for r in docs:
        words = words_of(r.text)
        words = brute_planted(r.doc_id, words)
        if len(words) > 4000:  # the brute force is quadratic
            continue
        found = brute_runs(words, 4, 6)
        several += bool(found)
        assert columns(got[r.doc_id]) == brute_row(words, found), r.doc_id
    assert several > 5
