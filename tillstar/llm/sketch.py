"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``k`` smallest distinct hashes of a text's shingles.
Sketches of parts merge into the sketch of the whole, and two of them estimate
resemblance, containment and the number of distinct shingles.  As text: base64
of the little-endian hashes in ascending order, so equal texts (and any texts
with equal shingle sets) have equal fingerprints.

A null or empty text has the empty sketch ''; two empty sketches resemble each
other fully, an empty and another one not at all.  A text shorter than a
shingle is one shingle.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import WordHash, grams, map_arrow

K = 128
SHINGLE = 5
U64 = np.uint64


def bottom(h: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct values, ascending."""
    n = 2 * k
    while len(h) > 2 * n:  # repeated hashes may fill the first places: then look further
        low = np.unique(np.partition(h, n)[:n])
        if len(low) >= k:
            return low[:k]
        n *= 4
    return np.unique(h)[:k]


def sketch(text: str | None, hashes: WordHash, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    words = text.lower().encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.empty(0, dtype=U64)
    h = hashes.array(words)
    g = grams(h, shingle) if len(h) >= shingle else grams(h, len(h)) ^ U64(len(h))
    return bottom(g, k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts' union from their sketches."""
    return np.union1d(a, b)[:k]


def distinct_count(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below ``k``)."""
    return float(len(s)) if len(s) < k else (k - 1) / ((float(s[-1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    shared = np.intersect1d(a, b, assume_unique=True)
    return len(np.intersect1d(both, shared, assume_unique=True)) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    union = distinct_count(merge(a, b, k), k)
    return min(1.0, j * union / distinct_count(a, k))


def to_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8").astype(U64)


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint, n_shingles)`` of ``docs (doc_id, text)``; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHash()
        for batch in batches:
            s = [sketch(t.as_py(), hashes, k, shingle) for t in batch.column(1)]
            yield {
                "doc_id": batch.column(0).to_pylist(),
                "fingerprint": [to_text(x) for x in s],
                "n_shingles": [distinct_count(x, k) for x in s],
            }

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, fingerprint string, n_shingles double")


def merged(parts: DataFrame, key: str, k: int = K) -> DataFrame:
    """``(key, fingerprint)``: the union of the parts' sketches (column ``fingerprint``) by key.

    Merged within each task first, then by key; a sketch never exceeds k hashes.
    """
    kind = dict(parts.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict = {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = from_text(text)
                held[name] = merge(held[name], s, k) if name in held else s
                if len(held) >= 1 << 14:
                    yield {key: list(held), "fingerprint": [to_text(x) for x in held.values()]}
                    held = {}
        yield {key: list(held), "fingerprint": [to_text(x) for x in held.values()]}

    once = map_arrow(parts.select(key, "fingerprint"), run, f"`{key}` {kind}, fingerprint string")

    def total(pdf):
        out = from_text(pdf["fingerprint"].iloc[0])
        for text in pdf["fingerprint"].iloc[1:]:
            out = merge(out, from_text(text), k)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "fingerprint": [to_text(out)]})

    return once.groupBy(key).applyInPandas(total, f"`{key}` {kind}, fingerprint string")


def _places(keys: list[np.ndarray], bounds: list[tuple[int, int, int]]) -> np.ndarray:
    """How many of the sorted ``bounds`` are below each row's (i, h, u)."""
    kind = [("i", "<i8"), ("h", "<i8"), ("u", "<i8")]
    rows = np.empty(len(keys[0]), dtype=kind)
    for (name, _), column in zip(kind, keys):
        rows[name] = column
    edges = np.array(bounds, dtype=kind)
    if len({b[0] for b in bounds}) == len(bounds):  # ids alone tell nearly all rows' places
        low = np.searchsorted(edges["i"], rows["i"], side="left")
        same = np.flatnonzero(edges["i"][np.minimum(low, max(len(edges) - 1, 0))] == rows["i"]) if len(edges) else []
        for k in same:
            low[k] += int(tuple(edges[low[k]]) < tuple(rows[k])) if low[k] < len(edges) else 0
        return low
    return np.searchsorted(edges, rows, side="left")


def _bounds(keyed: DataFrame, n_ranges: int) -> list[tuple[int, int, int]]:
    """Sorted cuts of ``keyed (i, h, u)`` into about even ranges, at most two for each of ``n_ranges``.

    A doc_id that is several quantiles is cut by text hash, and a text that is several quantiles
    of such an id by row, so neither a hot id nor a hot row is one range.
    """
    shares = [j / n_ranges for j in range(1, n_ranges)]
    cuts = [int(x) for x in keyed.approxQuantile("i", shares, 0.1 / n_ranges)]
    hot = {v: n for v, n in Counter(cuts).items() if n > 1}
    least = -(2**63)
    out = {(v, least, least) for v in cuts}
    if hot:
        points = F.percentile_approx("h", F.lit(shares), 10 * n_ranges).alias("h")
        few = keyed.sparkSession.createDataFrame([(v,) for v in hot], "i bigint")
        for row in keyed.join(F.broadcast(few), "i").groupBy("i").agg(points).collect():  # a row per hot id, at most n_ranges
            # as many of the text hashes' quantiles as the id has shares of all rows
            mine = [int(row.h[j * len(row.h) // (hot[row.i] + 1)]) for j in range(1, hot[row.i] + 1)]
            for h, n in Counter(mine).items():
                out |= {(row.i, h, least + (j << 64) // n) for j in range(n)}
            out.add((row.i + 1, least, least) if row.i < 2**63 - 1 else (row.i, 2**63 - 1, 2**63 - 1))
    return sorted(out)


def with_next(docs: DataFrame, n_ranges: int) -> DataFrame:
    """``docs (doc_id, text)`` dealt by ranges of doc_id, in order within each.

    Rows with equal doc_id are in order of text hash, equal rows in any order.
    Column ``own`` tells rows of a range (true) from the copy of the next
    range's first row, which follows its last one; so each row's next
    document is the row after it.  Text is shuffled once.  Range bounds are
    quantiles and, per range, its smallest row: bounded by
    the number of ranges.  The last document's next is the first.  A null
    doc_id comes first.
    """
    lowest = -(2**63)
    rows = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(lowest)).alias("i"), F.xxhash64("text").alias("h"),
        F.xxhash64(F.monotonically_increasing_id()).alias("u"),
    )
    bounds = _bounds(rows.select("i", "h", "u"), n_ranges)

    @F.pandas_udf("int")
    def range_of(i: pd.Series, h: pd.Series, u: pd.Series) -> pd.Series:
        return pd.Series(_places([i.to_numpy(), h.to_numpy(), u.to_numpy()], bounds).astype(np.int32))

    first = F.min(F.struct("i", "h", "u")).alias("first")
    found = rows.select("i", "h", "u", range_of("i", "h", "u").alias("r")).groupBy("r").agg(first).collect()
    order = sorted(r.r for r in found)
    before = dict(zip(order, [*order[-1:], *order[:-1]]))  # the range that comes before each
    firsts = {tuple(r.first): before[r.r] for r in found}
    first_ids = np.array(sorted({f[0] for f in firsts}), dtype=np.int64)

    @F.pandas_udf("array<int>")
    def targets(i: pd.Series, h: pd.Series, u: pd.Series) -> pd.Series:
        """The row's own range and, for a range's first row, the range before."""
        keys = [i.to_numpy(), h.to_numpy(), u.to_numpy()]
        out = [[r] for r in _places(keys, bounds).tolist()]
        for k in np.flatnonzero(np.isin(keys[0], first_ids)).tolist():
            if (to := firsts.get((int(keys[0][k]), int(keys[1][k]), int(keys[2][k])))) is not None:
                out[k].append(to)
        return pd.Series(out)

    dealt = rows.select("doc_id", "text", "i", "h", "u", F.posexplode(targets("i", "h", "u")).alias("n", "r")).select(
        "r", (F.col("n") == 0).alias("own"), "i", "doc_id", "text", "h", "u"
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "r").sortWithinPartitions("r", F.desc("own"), "i", "h", "u").drop("h", "u")


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many first code points of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def edit_report(docs: DataFrame, k: int = K, shingle: int = SHINGLE, ranges_per_partition: int = 4) -> DataFrame:
    """Fingerprints of each text, of its edited form and their likeness (see ``edited``).

    Rows with equal doc_id follow each other in order of text hash; an empty table gives no rows; extra columns are not looked at.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * ranges_per_partition
    rows = with_next(docs.select("doc_id", "text"), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHash()
        held = None  # (range, doc_id, text, sketch) that waits for its next document
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        for batch in batches:
            out = []
            for r, own, doc, cell in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
            ):
                if held is not None and held[0] != r:
                    held = None  # copies of a range's next document end it
                if held is None and not own:
                    continue
                text = cell.as_py() or ""
                s = sketch(text, hashes, k, shingle)
                if held is not None:
                    _, doc0, text0, s0 = held
                    new = edited(text0, text)
                    e = sketch(new, hashes, k, shingle)
                    out.append((
                        doc0, len(text0), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                        to_text(s0), to_text(e), resemblance(s0, e, k), resemblance(s0, s, k),
                    ))
                held = (r, doc, text, s) if own else None
            yield {n: [x[i] for x in out] for i, n in enumerate(names)}

    return map_arrow(
        rows,
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
