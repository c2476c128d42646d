"""SimHash near duplicates by a binary trie self-join.

The 64 bits of distinct fingerprints form a binary trie; the join walks pairs
of its nodes together, adds up the bits in which their paths differ and drops
a pair of nodes once that exceeds the error budget.  So that many tasks share
the walk, it starts below the root: of 3 blocks of bits at least one is equal
in any two fingerprints that differ in at most 2 bits, the same again for 3
sub-blocks of the remaining bits, and once more within what then remains.  Each
fingerprint is thus put under 27 starting nodes (three nested blocks and their
bits, first in the bit order of that trie), where the pair's budget is still
whole; a task walks the subtrees below the nodes it was dealt.  The constant 27
does not depend on the data.  Some 44 bits are settled at such a node, so it
holds at most 2**20 distinct fingerprints (8 MB) whatever the input, also
within a group of near copies of any size; exact copies are one fingerprint.

Links of fingerprints are joined to connected components by alternating
large-star and small-star steps; nothing is collected.

Null and empty texts have fingerprint zero and link like any other; a null
doc_id is never the smallest of its component unless all are null; repeated
rows share their component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import components, map_arrow, written

BITS = 64
SEED = 42
LEVELS = 3  # nested blocks that lead to a starting node; bounds its fingerprints by 2 ** (bits left)
LEAF = 16  # a pair of nodes with at most this many fingerprints each is compared directly


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of all ``shingle``-word runs (repeats included) of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(p, SEED) for p in parts), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` of ``docs (doc_id, text)``; ``fp`` holds the 64 bits as a signed long.

    ``keep``: further columns (long) to pass on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            kept = {name: batch.column(2 + i) for i, name in enumerate(keep)}
            yield {"doc_id": batch.column(0), "fp": np.array(fps, dtype=np.uint64).view(np.int64)} | kept

    return map_arrow(
        docs.select("doc_id", "text", *keep), run, "doc_id bigint, fp bigint" + "".join(f", {name} bigint" for name in keep)
    )


def blocks(start: int, stop: int, n: int) -> list[tuple[int, int]]:
    """``n`` nearly equal parts (first bit, last bit + 1) of a run of bits."""
    edges = [start + (stop - start) * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:]))


def bit_orders(budget: int, levels: int = LEVELS) -> list[tuple[list[int], int]]:
    """Starting nodes: (bits from the root down, depth of the node) for each choice of nested blocks."""
    out: list[tuple[list[int], list[int]]] = [([], list(range(BITS)))]
    for _ in range(levels):
        out = [
            (head + rest[a:b], rest[:a] + rest[b:]) for head, rest in out for a, b in blocks(0, len(rest), budget + 1)
        ]
    return [(head + rest, len(head)) for head, rest in out]


def permuted(fp: np.ndarray, order: list[int]) -> np.ndarray:
    """Fingerprints with bit ``order[0]`` as the highest, ``order[1]`` next and so on."""
    out = np.zeros(len(fp), dtype=np.uint64)
    i = 0
    while i < BITS:  # runs of neighbouring bits move together
        n = 1
        while i + n < BITS and order[i + n] == order[i] + n:
            n += 1
        part = (fp >> np.uint64(BITS - order[i] - n)) & np.uint64((1 << n) - 1)
        out |= part << np.uint64(BITS - i - n)
        i += n
    return out


def walk(keys: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of sorted distinct ``keys`` that differ in at most ``budget`` bits.

    ``keys`` agree in their first ``depth`` bits.  Each entry of the stack is a
    pair of trie nodes: two ranges of keys, their depth, and the bits left.
    """
    stack = [(0, len(keys), 0, len(keys), depth, budget)]
    while stack:
        a, b, c, d, at, left = stack.pop()
        same = a == c
        if b - a <= LEAF and d - c <= LEAF or at == BITS:
            i, j = np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij")
            i, j = i.ravel(), j.ravel()
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            if same:
                near &= i < j
            yield i[near], j[near]
            continue
        bit = np.uint64(BITS - at - 1)
        # within a node the paths agree, so its keys with this bit set follow those without
        m = a + int(np.searchsorted((keys[a:b] >> bit) & np.uint64(1), 1))
        n = m if same else c + int(np.searchsorted((keys[c:d] >> bit) & np.uint64(1), 1))
        pairs = [(a, m, c, n, left), (m, b, n, d, left), (a, m, n, d, left - 1)]
        if not same:
            pairs.append((m, b, c, n, left - 1))
        stack += [(p, q, r, s, at + 1, e) for p, q, r, s, e in pairs if e >= 0 and q > p and s > r]


def links(prints: DataFrame, budget: int = 2) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints in column ``fp`` at most ``budget`` bits apart."""
    orders = bit_orders(budget)
    # a node's name: its bits, then which of the starting nodes it is
    shift = (len(orders) - 1).bit_length()
    if shift + max(depth for _, depth in orders) > BITS:
        raise ValueError(f"budget of {budget} bits needs too many starting nodes")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for t, (order, depth) in enumerate(orders):
                bits = permuted(fp, order) >> np.uint64(BITS - depth)
                yield {"node": (bits << np.uint64(shift) | np.uint64(t)).view(np.int64), "fp": batch.column(0)}

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rest = None
        for batch in batches:
            node, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if rest is not None:
                node, fp = np.concatenate((rest[0], node)), np.concatenate((rest[1], fp))
            cut = np.flatnonzero(node[1:] != node[:-1]) + 1
            last = int(cut[-1]) if len(cut) else 0  # the last node may go on in the next batch
            rest = node[last:], fp[last:]
            if last:
                yield from subtrees(node[:last], cut[:-1], fp[:last])
        if rest is not None:
            yield from subtrees(rest[0], np.empty(0, dtype=np.int64), rest[1])

    def subtrees(node: np.ndarray, cut: np.ndarray, fp: np.ndarray) -> Iterator[dict]:
        starts, ends = np.r_[0, cut], np.r_[cut, len(node)]
        several = ends - starts > 1
        for a, b in zip(starts[several].tolist(), ends[several].tolist()):
            order, depth = orders[int(node[a]) & ((1 << shift) - 1)]
            here = fp[a:b].view(np.uint64)
            keys = permuted(here, order)
            by_key = np.argsort(keys)
            keys, mine = keys[by_key], fp[a:b][by_key]
            for i, j in walk(keys, depth, budget):
                if len(i):
                    yield {"a": mine[i], "b": mine[j]}

    dealt = map_arrow(prints.select("fp"), deal, "node bigint, fp bigint")
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "node").sortWithinPartitions("node")
    return map_arrow(dealt, join, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs (doc_id, text)``."""
    prints = written(fingerprints(docs, shingle), "simhash")
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    member = components(links(first, budget), "simhash-cc").withColumnRenamed("node", "fp")
    rooted = first.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # a component's smallest id; a component may hold many fingerprints, so sums are partial
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = rooted.join(lowest, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, row: tuple[str, ...], shingle: int = 3, budget: int = 2) -> DataFrame:
    """The values of the ``row`` columns (longs that no two rows share) of one row of each component.

    It is the row with the smallest doc_id (null after all others), then the smallest text hash, then the smallest ``row``.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), *(F.col(c).alias(f"r{i}") for i, c in enumerate(row)))
    names = tuple(f"r{i}" for i in range(len(row)))
    prints = written(fingerprints(hashed, shingle, ("h", *names)), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", *names)
    first = written(prints.groupBy("fp").agg(F.min(order).alias("first")), "simhash-first")
    member = components(links(first, budget), "simhash-cc").withColumnRenamed("node", "fp")
    rooted = first.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return lowest.select(*(F.col(f"first.r{i}").alias(c) for i, c in enumerate(row)))


def deduplicated(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """``docs`` (all columns) with one row of each component: the one ``representatives`` names.

    Rows read from files are known by file and place in it; other rows are written with a number first.  Texts
    are shuffled once, at every size, for the join with the kept rows' places.
    """
    columns = docs.columns
    try:
        rows = docs.select(
            "*", F.xxhash64("_metadata.file_path").alias("_row_file"), F.col("_metadata.row_index").alias("_row_at")
        )
    except AnalysisException:  # not read from files
        rows = docs.withColumn("_row_file", F.lit(0).cast("bigint")).withColumn("_row_at", F.monotonically_increasing_id())
        rows = written(rows, "simhash-numbered")
    place = ("_row_file", "_row_at")
    kept = written(representatives(rows, place, shingle, budget), "simhash-kept")
    return rows.join(kept.hint("merge"), list(place), "left_semi").select(*columns)
