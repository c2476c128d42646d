"""Periodic runs of words in documents, by an enhanced suffix array.

A run is a maximal stretch of words that repeats with a period q: words q apart
are equal, the stretch holds at least two periods, and no neighbouring word
goes on with it.  The texts of a batch are put one after another, each
word numbered within its document and each document closed by a word of its
own, and one suffix array with its inverse and its LCP array serves them all:

1. suffixes are sorted by prefix doubling; only suffixes that still share their
   prefix with another are sorted again, and the ranks of each round are kept
   (two suffixes share 2**r words just where their ranks of round r agree), so
   the LCP of neighbours and the rotations below are read off by halving steps;
2. every LCP interval has a depth and children.  For each suffix i of all its
   children but the largest, the interval is asked for the suffixes i + depth
   and i - depth by their place in the inverse array: one of another child is a
   square of that depth that does not rotate to the right (a branching tandem);
3. a square is rotated to the left as far as the words allow.  It then spans a
   run whose end is the square's; of equal spans the shortest period is the run's.

No tree is built: intervals and children are ranges of the arrays, for all
intervals of a batch at once.  Documents never meet, so nothing is shuffled; a
task holds the arrays of about ``BATCH_WORDS`` words or of one longer document
(some 40 bytes a word, and 4 more for each doubling of its longest repeat).

Null, empty and word-free texts have no words and no run; repeated rows give
equal rows; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillstar.llm.common import map_arrow

# Words that are put into one suffix array at most, unless one document has more (memory bound only).
BATCH_WORDS = 1 << 18

SCHEMA = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint,"
    " runs_sha256 string, collapsed_sha256 string"
)


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffix array, its inverse, ranks by the first 1, 2, 4, ... symbols) of non-negative ``symbols``.

    The last symbol must occur once.  Equal ranks of round r mean equal first 2**r symbols.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    ordered = symbols[sa]
    head = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, dtype=np.int32)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0)).astype(np.int32)
    rounds = [rank]
    step = 1
    while True:
        # places of the suffix array whose suffixes share their prefix with a neighbour
        single = head & np.r_[head[1:], True]
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            return sa, rank, rounds
        mine = sa[open_at]
        # a shared prefix never holds its document's closing word, so mine + step stays inside
        key = rank[mine].astype(np.int64) << 32 | rank[mine + step]
        order = np.argsort(key, kind="stable")
        mine, key = mine[order], key[order]
        sa[open_at] = mine
        head = head.copy()
        head[open_at] = np.r_[True, key[1:] != key[:-1]]
        firsts = np.where(head[open_at], open_at, 0)
        rank = rank.copy()
        rank[mine] = np.maximum.accumulate(firsts).astype(np.int32)
        rounds.append(rank)
        step *= 2


def shared_ahead(rounds: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes ``a`` and ``b`` (all different) share."""
    out = np.zeros(len(a), dtype=np.int64)
    n = len(rounds[0])
    for r in range(len(rounds) - 1, -1, -1):
        x, y = a + out, b + out
        inside = (x < n) & (y < n)
        same = np.zeros(len(a), dtype=bool)
        same[inside] = rounds[r][x[inside]] == rounds[r][y[inside]]
        out[same] += 1 << r
    return out


def shared_behind(rounds: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols right before ``a`` and before ``b`` (a < b) are the same."""
    out = np.zeros(len(a), dtype=np.int64)
    for r in range(len(rounds) - 1, -1, -1):
        x, y = a - out - (1 << r), b - out - (1 << r)
        inside = x >= 0
        same = np.zeros(len(a), dtype=bool)
        same[inside] = rounds[r][x[inside]] == rounds[r][y[inside]]
        out[same] += 1 << r
    return out


def interval_bounds(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places ``at`` of ``lcp``: the nearest smaller value's place to the left, and to the right.

    Found by halving steps over minima of 1, 2, 4, ... values.  ``lcp`` begins and ends with a value below all others.
    """
    n = len(lcp)
    minima = [lcp]
    while 2 << (len(minima) - 1) <= n:
        half, low = 1 << (len(minima) - 1), minima[-1]
        minima.append(np.minimum(low[:-half], low[half:]))
    value = lcp[at]
    right, left = at + 1, at.copy()  # values of [at + 1, right) and of [left, at) are not smaller
    for r in range(len(minima) - 1, -1, -1):
        low, width = minima[r], 1 << r
        go = right + width <= n
        go[go] = low[right[go]] >= value[go]
        right[go] += width
        go = left >= width
        go[go] = low[left[go] - width] >= value[go]
        left[go] -= width
    return left - 1, right


def branching_tandems(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of every square whose next symbol breaks it.

    ``lcp[p]`` is shared by the suffixes at places p - 1 and p; ``lcp[0]`` and one value past the end are -1.
    """
    n = len(sa)
    none = np.empty(0, dtype=np.int64)
    at = np.flatnonzero(lcp[:n] >= 1)
    if not len(at):
        return none, none
    low, high = interval_bounds(lcp, at)  # the interval of place p is [low, high)
    depth = lcp[at]
    order = np.lexsort((at, high, low))
    at, low, high, depth = at[order], low[order], high[order], depth[order]
    first = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
    # children: from the interval's start to its first border, from each border to the next, from the last to its end
    begins = np.concatenate((low[first], at))
    ends = np.concatenate((at[first], np.where(np.r_[first[1:], True], high, np.r_[at[1:], 0])))
    group = np.cumsum(first) - 1
    of = np.concatenate((np.arange(group[-1] + 1), group))
    i_low, i_high, i_depth = low[first], high[first], depth[first]
    size = ends - begins
    # the largest child of each interval is left out
    by = np.lexsort((-size, of))
    small = np.ones(len(size), dtype=bool)
    small[by[np.r_[True, of[by][1:] != of[by][:-1]]]] = False
    begins, ends, of, size = begins[small], ends[small], of[small], size[small]
    total = int(size.sum())
    if not total:
        return none, none
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + begins[owner]
    suffix, d = sa[place].astype(np.int64), i_depth[of[owner]]
    starts, depths = [], []
    for sign in (1, -1):
        other = suffix + sign * d
        inside = (other >= 0) & (other < n)
        where = np.full(total, -1, dtype=np.int64)
        where[inside] = isa[other[inside]]
        found = (where >= i_low[of[owner]]) & (where < i_high[of[owner]])
        found &= (where < begins[owner]) | (where >= ends[owner])
        starts.append(np.minimum(suffix, other)[found])
        depths.append(d[found])
    return np.concatenate(starts), np.concatenate(depths)


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs of at least two periods, by start, then end."""
    sa, isa, rounds = suffix_array(symbols)
    lcp = np.full(len(sa) + 1, -1, dtype=np.int64)
    lcp[1:-1] = shared_ahead(rounds, sa[:-1], sa[1:])
    square, q = branching_tandems(sa, isa, lcp)
    start, end = square - shared_behind(rounds, square, square + q), square + 2 * q
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    # a span's shortest period comes first; its multiples are no periods of their own
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]
    return start[new], end[new], q[new]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all documents' words, each document closed by a symbol of its own; where documents begin)."""
    ids: dict[bytes, int] = {}
    counts = np.array([len(w) + 1 for w in texts], dtype=np.int64)
    begins = np.cumsum(counts) - counts
    words = np.zeros(int(counts.sum()), dtype=np.int64)
    for at, doc in zip(begins.tolist(), texts):
        words[at : at + len(doc)] = [ids.setdefault(w, len(ids) + 1) for w in doc]
    return np.repeat(np.arange(len(texts)), counts) * (len(ids) + 1) + words, begins


def report(words: list[bytes], found: list[tuple[int, int, int]]) -> dict:
    """The columns of one document from its runs (start, end, period)."""
    best = None
    for start, end, q in found:
        length = end - start
        # exact comparison of length / period
        if best is None or (length * best[2], -start, -q) > (best[1] * q, -best[0], -best[2]):
            best = (start, length, q)
    out = {"n_words": len(words), "n_runs": len(found)}
    out |= dict(zip(("start", "length", "period"), best or (None,) * 3))
    out["exponent_milli"] = 1000 * best[1] // best[2] if best else None
    lines = "".join(f"{start},{end - start},{q}\n" for start, end, q in sorted(found, key=lambda r: (r[0], r[2])))
    out["runs_sha256"] = hashlib.sha256(lines.encode()).hexdigest()
    if found:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, end, q in found:
            edge[start + q] += 1
            edge[end] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    out["collapsed_sha256"] = hashlib.sha256(b" ".join(words)).hexdigest()
    return out


def periodic_runs(
    docs: DataFrame,
    min_periods: int = 2,
    min_length: int = 0,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Runs of every row of ``docs (doc_id, text)``.

    Words are what white space of ASCII separates.  Runs have at least
    ``min_periods`` periods (two or more) and ``min_length`` words.  Columns:
    ``n_words``, ``n_runs``, the run of the greatest length by period (ties: smallest
    start, then period; nulls without a run), a digest of all runs, and a digest of the text
    without the words that lie in a run after its first period.  ``edit`` may change a
    document's words before.
    """
    if min_periods < 2:
        raise ValueError("a run has two periods at least")

    def flush(ids: list, texts: list[list[bytes]]) -> dict:
        symbols, begins = numbered(texts)
        start, end, q = runs(symbols)
        keep = end - start >= np.maximum(min_length, min_periods * q)
        start, end, q = start[keep], end[keep], q[keep]
        doc = np.searchsorted(begins, start, side="right") - 1
        found: dict[int, list] = {}
        for d, row in zip(doc.tolist(), zip((start - begins[doc]).tolist(), (end - begins[doc]).tolist(), q.tolist())):
            found.setdefault(d, []).append(row)
        rows = [report(words, found.get(d, [])) for d, words in enumerate(texts)]
        return {"doc_id": ids} | {name: [r[name] for r in rows] for name in rows[0]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = text.split() if text else []
                if edit is not None:
                    words = edit(doc_id, words)
                if texts and size + len(words) >= BATCH_WORDS:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words) + 1
        if texts:
            yield flush(ids, texts)

    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)
