"""The Jaccard join against brute force."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from tillstar.llm import jaccard, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, key string, tokens int, ref string"


def brute_sets(texts):
    out = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    return out


def brute(rows):
    sets = brute_sets([r[1] for r in rows])
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), low.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def joined(spark, rows):
    df = spark.createDataFrame([(*r, "k", 3, "r") for r in rows], DOCS)
    return sorted(map(tuple, jaccard.similarity_components(df).collect()), key=repr)


def copies(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(rng):
    """Near copies at and around the border, common passages, odd texts."""
    texts = [None, "", " \n", "one", "One", "a b c", "A B  C", "a b c d", "a b c d e", "a b c d e f", "a b c d e f g h i"]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in (8, 9, 10, 11, 13, 14, 26, 27, 33)]
    passage = [f"p{i}" for i in range(60)]
    lines = [[f"l{j}x{i}" for i in range(12)] for j in range(6)]
    for n in (12, 40, 120):
        texts += copies(rng, [f"b{n}w{rng.randrange(900)}" for _ in range(n)], 12, max(1, n // 20))
    for _ in range(12):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))]
        texts.append(" ".join(own + passage))
    for _ in range(30):
        texts.append(" ".join(w for line in rng.sample(lines, rng.randint(1, 6)) for w in line))
    rows = list(enumerate(texts))
    rows += [(None, texts[30]), (None, None), (5, texts[40]), (900, texts[40]), (901, texts[-1])]
    rng.shuffle(rows)
    return rows


def test_rows_equal_brute_force(spark):
    rows = corpus(random.Random(6))
    assert joined(spark, rows) == brute(rows)


def test_frequent_tokens_and_small_pieces(spark, monkeypatch):
    """All classes in use, groups cut into pieces, tiny bit tables that mistake tokens and sets."""
    monkeypatch.setattr(jaccard, "BORDERS", (1, 2, 4))
    monkeypatch.setattr(jaccard, "PIECE", 4)
    monkeypatch.setattr(jaccard, "FLUSH", 50)
    monkeypatch.setattr(jaccard, "SLOTS", (13, 12, 11))
    monkeypatch.setattr(jaccard, "SET_SLOTS", 4)
    monkeypatch.setattr(jaccard, "SMALL", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = corpus(random.Random(7))
    assert joined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert joined(spark, []) == []
    assert joined(spark, [(1, None), (2, "  ")]) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("odds", [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (1, 3, 3, 3)])
def test_similar_sets_share_a_signature(odds):
    """Whatever the classes of tokens are, unless one of the sets has tokens enough of its own."""
    rng = np.random.default_rng(sum(odds) + 10 * odds.index(max(odds)))
    for size in list(range(4, 40)) + [64, 79, 80, 127, 128, 200, 333, 800]:
        tokens = np.unique(rng.integers(0, 2**63, size=2 * size, dtype=np.uint64))
        kinds = dict(zip(tokens.tolist(), rng.choice(4, p=np.array(odds) / sum(odds), size=len(tokens)).tolist()))
        classes = jaccard.Classes([])
        for _ in range(6):
            common = rng.choice(tokens, size=size, replace=False)
            most = 100 * size // 80 - size  # what both may have besides
            extra = np.setdiff1d(tokens, common)
            split = int(rng.integers(0, most + 1))
            x = np.sort(np.r_[common, extra[:split]])
            y = np.sort(np.r_[common, extra[split:most]])
            for t in np.r_[common]:  # a token of both is not of one set alone
                kinds[int(t)] = max(kinds[int(t)], 1)
            classes.of = lambda ts: np.array([kinds[int(t)] for t in ts], dtype=np.int64)
            classes.above = lambda border, ts: np.array([kinds[int(t)] > border for t in ts], dtype=np.int64)
            if np.array_equal(x, y):
                continue
            assert len(np.intersect1d(jaccard.signatures(x, classes, 80), jaccard.signatures(y, classes, 80))), (size, odds)


def test_query_equals_brute_force_on_its_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op12_jaccard_join(spark, SF).collect()), key=repr)
    assert got == brute(rows)
    assert len({r[2] for r in got}) < len(got)


def test_copies_of_a_text_in_different_tasks_have_no_signatures(spark, monkeypatch):
    sent, real = [], jaccard.map_arrow

    def spy(df, rows, schema):
        out = real(df, rows, schema)
        if "sigs" in schema:
            sent.append(out)
        return out

    monkeypatch.setattr(jaccard, "map_arrow", spy)
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(30)]
    rows = [(100 * i + n, t, "k", 3, "r") for n, t in enumerate(texts) for i in range(1, 21)]
    docs = spark.createDataFrame(rows, DOCS).repartition(20, "doc_id")
    got = jaccard.similarity_components(docs).collect()
    assert sorted(map(tuple, got)) == sorted((r[0], 56, 100 + r[0] % 100) for r in rows)
    assert sent and not any(r.sigs for df in sent for r in df.collect())


def test_rows_that_stand_for_a_text(spark, monkeypatch):
    """A tiny table that marks nearly every row, null and repeated ids, texts equal but for case and spaces."""
    monkeypatch.setattr(jaccard, "ROW_SLOTS", 15)
    words = "a b c d e f g h"
    rows = [(5, words), (None, words), (5, words), (3, words.upper()), (9, words.replace(" ", "  ")), (None, "x y"), (None, "x y"), (8, ""), (8, None), (2, " ")]
    rows += [(100 + i, f"t{i % 40} u v w x y z") for i in range(400)]
    assert joined(spark, rows) == brute(rows)
