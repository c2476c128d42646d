"""Benchmark decontamination by winnowing.

Words are hashed; of the hashes of all ``GRAM`` consecutive words the smallest
in every run of ``WINDOW - GRAM + 1`` is kept as a fingerprint.  Any shared run
of ``WINDOW`` words therefore holds a fingerprint that both texts keep.
Fingerprints of documents are looked up among those of the benchmark; a hit is
compared word by word and extended left and right along its diagonal, and
counts when it covers a whole window.  Benchmark items shorter than a window
are looked up as a whole, by their own length.

The benchmark side is sent to the tasks when its measured size is within
``broadcast_bytes``; then documents are read once and nothing is shuffled.
Beyond it, documents keep those of their fingerprints that any item has (a semi
join, so no pairs arise); around them they list their windows, which are looked up word by
word among the items' windows, and the windows found are united for each document.  A
common phrase costs each document its own words only; document and item meet as a pair just where
the item is to be counted for the document.  Both ways give the same rows.

Null and empty texts have no words: zero counts, not contaminated.  Items
without words never occur.  Items with a null item_id count for the words that are hit and
so for ``contaminated``, but have no place among the items; rows with the same item_id are one item.
Repeated rows are judged each on their own; very long texts are compared whole; extra columns are not looked
at; empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import KEY, WordHash, grams, kept_rows, map_arrow, row_key, winnow, written

WINDOW = 13
GRAM = 7
BROADCAST_BYTES = 32 << 20
# Word characters: ASCII digits and letters, and everything beyond ASCII; A-Z become a-z.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    "contaminated boolean, item_ids array<string>, hit_spans array<struct<start:int,end:int>>"
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


class Index:
    """Fingerprints of benchmark items, and their words for exact comparison."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], hashes: WordHash):
        self.items = [(i, w) for i, w in items if w]
        self.at: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for n, (_, words) in enumerate(self.items):
            h = hashes.array(words)
            if len(words) >= WINDOW:
                g = grams(h, GRAM)
                for p in winnow(g, WINDOW - GRAM + 1):
                    self.at[int(g[p])].append((n, int(p)))
            else:
                self.short[len(words)][int(grams(h, len(words))[0])].append(n)
        self.keys = np.sort(np.fromiter(self.at, dtype=np.uint64, count=len(self.at)))
        self.short_keys = {
            n: np.sort(np.fromiter(m, dtype=np.uint64, count=len(m))) for n, m in self.short.items()
        }


def among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return keys[at] == values


def candidates(words: list[bytes], hashes: WordHash, index: Index) -> tuple[list, list]:
    """Places in a run of words (documents put together) where fingerprints match."""
    h = hashes.array(words)
    g = grams(h, GRAM)
    at = winnow(g, WINDOW - GRAM + 1)
    at = at[among(g[at], index.keys)]
    found, short = [(int(p), int(g[p])) for p in at], []
    for n, keys in index.short_keys.items():
        g = grams(h, n)
        short += [(int(p), n, int(g[p])) for p in np.flatnonzero(among(g, keys))]
    return found, short


def judge(words: list[bytes], found: list, short: list, index: Index) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit spans (merged) and items, from candidate places inside one document."""
    spans, items, done = [], set(), {}
    for p, key in found:
        for n, q in index.at[key]:
            item = index.items[n][1]
            if p < done.get((n, p - q), -1) or words[p : p + GRAM] != item[q : q + GRAM]:
                continue
            a = 0
            while a < p and a < q and words[p - a - 1] == item[q - a - 1]:
                a += 1
            b, most = GRAM, min(len(words) - p, len(item) - q)
            while b < most and words[p + b] == item[q + b]:
                b += 1
            done[n, p - q] = p + b
            if a + b >= WINDOW:
                spans.append((p - a, p + b))
                items.add(index.items[n][0])
    for p, size, key in short:
        for n in index.short[size][key]:
            if words[p : p + size] == index.items[n][1]:
                spans.append((p, p + size))
                items.add(index.items[n][0])
    return united(spans), items - {None}


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch as one."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _columns(rows: list[tuple]) -> dict:
    """Output columns of (doc_id, n_words, spans, items)."""
    hit = [sum(b - a for a, b in r[2]) for r in rows]
    ids = [sorted(r[3]) for r in rows]
    return {
        "doc_id": [r[0] for r in rows],
        "n_words": [r[1] for r in rows],
        "n_hit": hit,
        "n_items": [len(i) for i in ids],
        "items_sha256": [hashlib.sha256(",".join(i).encode()).hexdigest() for i in ids],
        "contaminated": [h > 0 and 20 * h >= r[1] for h, r in zip(hit, rows)],
        "item_ids": ids,
        "hit_spans": [[{"start": a, "end": b} for a, b in r[2]] for r in rows],
    }


def _judged(ids: list, texts: pa.Array, hashes: WordHash, index: Index) -> list[tuple]:
    """Rows of one batch; the words of many documents are hashed in one go."""
    rows, docs, size = [], [], 0

    def flush() -> None:
        run = [w for _, words in docs for w in words]
        found, short = candidates(run, hashes, index)
        starts = np.cumsum([0] + [len(w) for _, w in docs])
        mine = [defaultdict(list), defaultdict(list)]
        for kind, places in enumerate((found, short)):
            for place in places:
                d = int(np.searchsorted(starts, place[0], side="right")) - 1
                mine[kind][d].append((place[0] - int(starts[d]), *place[1:]))
        for d, (doc, words) in enumerate(docs):
            here = [sorted(mine[0].get(d, [])), mine[1].get(d, [])]
            spans, items = judge(words, *here, index) if any(here) else ([], set())
            rows.append((doc, len(words), spans, items))

    for doc, text in zip(ids, texts):
        words = words_of(text.as_py())
        docs.append((doc, words))
        size += len(words)
        if size >= 1 << 18:
            flush()
            docs, size = [], 0
    flush()
    return rows


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string"), "text").filter("text is not null")


def _sent(docs: DataFrame, items: DataFrame, broadcast_bytes: int):
    """The items for all tasks, None where they are larger than ``broadcast_bytes``."""
    size = F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 64
    if (items.agg(F.sum(size)).first()[0] or 0) > broadcast_bytes:
        return None
    return docs.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in items.collect()])


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row per document of ``docs (doc_id, text)`` against ``benchmark (item_id, text)``."""
    items = _items(benchmark)
    sent = _sent(docs, items, broadcast_bytes)
    if sent is None:
        return _joined(docs.select("doc_id", "text"), items).drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHash()
        index = Index([(i, words_of(t)) for i, t in sent.value], hashes)
        for batch in batches:
            yield _columns(_judged(batch.column(0).to_pylist(), batch.column(1), hashes, index))

    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)


def uncontaminated(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not contaminated."""
    items = _items(benchmark)
    sent = _sent(docs, items, broadcast_bytes)
    if sent is None:
        bad = _joined(docs.select("doc_id", "text"), items).filter("contaminated")
        bad = bad.select(F.struct("doc_id", "h").alias("_row_key")).distinct()
        return docs.withColumn("_row_key", row_key()).join(bad.hint("merge"), "_row_key", "left_anti").select(*docs.columns)
    at = docs.columns.index("text")

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bool]]:
        hashes = WordHash()
        index = Index([(i, words_of(t)) for i, t in sent.value], hashes)
        for batch in batches:
            yield [not c for c in _columns(_judged(range(batch.num_rows), batch.column(at), hashes, index))["contaminated"]]

    return kept_rows(docs, masks)


def _joined(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The way for a benchmark of any size; ``h`` is the text's hash in ``row_key``."""
    # lengths of short items that occur (1 .. WINDOW - 1, a bounded list)
    short = sorted(
        r.n
        for r in map_arrow(
            items.select("text"),
            lambda batches: ({"n": [len(words_of(t.as_py())) for t in b.column(0)]} for b in batches),
            "n int",
        )
        .filter(f"n between 1 and {WINDOW - 1}")
        .distinct()
        .collect()
    )

    def places(words: list[bytes], hashes: WordHash, whole: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length of what is looked up, places, their hashes): fingerprints as length 0, short items by their length."""
        h = hashes.array(words)
        if not whole or len(h) >= WINDOW:
            g = grams(h, GRAM)
            at = winnow(g, WINDOW - GRAM + 1)
            yield 0, at, g[at].view(np.int64)
        for n in short:
            if not whole or len(h) == n:
                g = grams(h, n)
                yield n, np.arange(len(g)), g.view(np.int64)

    def prints(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            hashes = WordHash()
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for n, _, g in places(words_of(text.as_py()), hashes, whole):
                        g = np.unique(g)
                        yield {"k": [key] * len(g), "size": [n] * len(g), "print": g}

        return run

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Windows of a document around the fingerprints it shares."""
        hashes = WordHash()
        for batch in batches:
            for key, text, shared in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words, wanted, spans = words_of(text.as_py()), {(s["size"], s["print"]) for s in shared}, set()
                for n, at, g in places(words, hashes, False):
                    for p, v in zip(at.tolist(), g.tolist()):
                        if (n, v) in wanted:
                            first, last = (p, p) if n else (max(0, p - WINDOW + GRAM), min(p, len(words) - WINDOW))
                            spans.update((s, n or WINDOW) for s in range(first, last + 1))
                spans = sorted(spans)
                yield {
                    "k": [key] * len(spans), "start": [s for s, _ in spans], "size": [n for _, n in spans],
                    "words": [b" ".join(words[s : s + n]) for s, n in spans],
                }

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                n = min(WINDOW, len(words))
                found = sorted({b" ".join(words[s : s + n]) for s in range(len(words) - n + 1)}) if n else []
                yield {"item_id": [item] * len(found), "words": found}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            n = [len(words_of(t.as_py())) for t in batch.column(1)]
            yield {"doc_id": batch.column(0), "h": batch.column(2), "n_words": n}

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            doc, h, n, spans, ids = (c.to_pylist() for c in batch.columns)
            rows = [
                (d, w, united([(s["start"], s["start"] + s["size"]) for s in found or []]), set(i or []))
                for d, w, found, i in zip(doc, n, spans, ids)
            ]
            yield _columns(rows) | {"h": h}

    keyed = docs.select(row_key().alias("k"), "text")
    known = map_arrow(items.select("item_id", "text"), prints(True), "k string, size int, print bigint").drop("k").distinct()
    mine = map_arrow(keyed, prints(False), f"k {KEY}, size int, print bigint").join(known, ["size", "print"], "left_semi")
    shared = mine.distinct().groupBy("k").agg(F.collect_list(F.struct("size", "print")).alias("shared"))
    near = map_arrow(keyed.dropDuplicates(["k"]).join(shared, "k").select("k", "text", "shared"), windows, f"k {KEY}, start int, size int, words binary")
    near = written(near, "contamination-windows")
    item_windows = map_arrow(items.select("item_id", "text"), of_items, "item_id string, words binary")
    spans = near.join(item_windows.select("words").distinct(), "words", "left_semi")
    spans = spans.groupBy("k").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    ids = near.select("k", "words").distinct().join(item_windows.filter("item_id is not null"), "words")
    ids = ids.select("k", "item_id").distinct().groupBy("k").agg(F.collect_list("item_id").alias("ids"))
    each = map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("h")), counts, "doc_id bigint, h bigint, n_words bigint")
    each = each.withColumn("k", F.struct("doc_id", "h")).join(spans, "k", "left").join(ids, "k", "left")
    return map_arrow(each.select("doc_id", "h", "n_words", "spans", "ids"), report, SCHEMA + ", h bigint")
