"""Hard negatives for anchors of an embedding table, by Fagin's threshold algorithm.

Components become integers, floor(scale * x).  A row's score for an anchor is their integer
inner product; higher scores come first, ties by the smaller vec_id.  An
anchor's positives are its best rows of the same label; a positive's negatives
are the best rows of other labels whose score lies within a window of shares
of the positive's score.

Rows are dealt by ranges of (dimension, label, row) into blocks of at most ``BLOCK_ROWS``
rows, so a label of any share of the rows is spread over many blocks.  A block
holds a sorted list of its rows for each vector component.  Each anchor visits
the blocks that can hold rows for it (those with its label for positives, those
with another one for negatives) and walks a block's lists side by side:

* sorted access from the top of a list where the anchor's component is positive,
  from its bottom where it is negative (a zero component adds nothing);
* every row met is scored once by random access to its whole vector;
* the threshold is the score of a row made of the components last met.  No
  row not yet met can score more, so the walk ends once the threshold falls
  strictly below the k-th score of each window (or below the window itself),
  strictly because a row of an equal score may have a smaller vec_id.

The best of each block are merged by anchor, at most k rows a block.  Anchors
are a stated query set against all rows, in blocks: an anchor row travels
to a block, blocks are never paired with each other.

Rows with a null label, a null vector, or any null or non-finite component take
no part, as anchors neither.  Vectors of unlike lengths have no score with each
other; a vector without components scores zero.  A null vec_id is no anchor and
comes last among ties.  Repeated rows are rows of their own: an anchor's other rows include its copies,
and repeated anchors have results each.  Scores are exact integers up to 38 digits, beyond that set to the largest
of them; where they are reported, those beyond a long are set to its limits.  An
empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import map_arrow, written

# Rows of a block at most (memory bound only: results do not depend on it).
BLOCK_ROWS = 2048
# Entries of each list met in the first step of a walk; every step meets as many again as all before.
FIRST_STEP = 16
# Sums of integers below this are exact as doubles.
EXACT = 2**53
LONG = 2**63
# Scores are kept within what decimal(38) can hold.
WIDE = 10**38 - 1
SCORE = "decimal(38,0)"

ROWS = "rid bigint, vec_id bigint, label bigint, dim int, v binary"
BLOCK = "dim int, of_labels array<bigint>, rids binary, ids binary, id_null binary, labels binary, v binary"
#: A block's row comes before the anchors that visit it.
VISIT = f"bid bigint, kind int, anchor bigint, vec_id bigint, label bigint, bounds array<{SCORE}>, {BLOCK}"


def rows_of(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """Rows that take part, numbered, with integer components (as doubles) and the given label."""
    unfit = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", unfit))
    fit = fit.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("bigint").alias("vec_id"),
        label.cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            lists = batch.column(3)
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            dims = np.array(lists.value_lengths().to_pylist(), dtype=np.int64)
            ends = np.cumsum(dims)
            v = [flat[e - n : e].tobytes() for e, n in zip(ends.tolist(), dims.tolist())]
            yield {"rid": batch.column(0), "vec_id": batch.column(1), "label": batch.column(2), "dim": dims.astype(np.int32), "v": v}

    return map_arrow(fit, run, ROWS)


def blocks_of(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` packed into blocks of one vector length and neighbouring labels, each with an id ``bid``."""

    def pack(run: list[tuple]) -> dict:
        rids, ids, labels, dims, v = zip(*run)
        null = np.array([i is None for i in ids])
        return {
            "dim": dims[:1],
            "of_labels": [sorted(set(labels))],
            "rids": [np.array(rids, dtype=np.int64).tobytes()],
            "ids": [np.array([0 if i is None else i for i in ids], dtype=np.int64).tobytes()],
            "id_null": [null.tobytes()],
            "labels": [np.array(labels, dtype=np.int64).tobytes()],
            "v": [b"".join(v)],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (len(held) == BLOCK_ROWS or held[0][3] != row[3]):
                    yield pack(held)
                    held = []
                held.append(row)
        if held:
            yield pack(held)

    count = -(-n // BLOCK_ROWS)
    dealt = rows.repartitionByRange(max(1, count), "dim", "label", "rid").sortWithinPartitions("dim", "label", "rid")
    packed = map_arrow(dealt.select("rid", "vec_id", "label", "dim", "v"), run, BLOCK)
    return packed.select(F.monotonically_increasing_id().alias("bid"), "*")


class Lists:
    """Some rows of a block: whole vectors for random access, and a sorted list per component."""

    def __init__(self, v: np.ndarray, rids: np.ndarray, ids: np.ndarray, id_null: np.ndarray, labels: np.ndarray):
        self.v, self.rids, self.ids, self.id_null, self.labels = v, rids, ids, id_null, labels
        self.rising = np.ascontiguousarray(np.argsort(v, axis=0, kind="stable").T)
        self.falling = np.ascontiguousarray(self.rising[:, ::-1])
        self.largest = float(np.abs(v).max(initial=0))

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """Steps of the walk: (rows newly met, their scores, threshold of the others, None when there are none)."""
        n, dim = self.v.shape
        v = self.v
        wide = not self.largest * float(np.abs(anchor).max(initial=0)) * max(dim, 1) < EXACT
        held = (lambda x: np.clip(x, -WIDE, WIDE)) if wide else (lambda x: x)
        if wide:
            anchor = np.array([int(x) for x in anchor], dtype=object)
            v = np.array([[int(x) for x in row] for row in v], dtype=object).reshape(n, dim)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) + len(down):
            yield np.arange(n), np.zeros(n), None
            return
        met = np.zeros(n, dtype=bool)
        at, step = 0, FIRST_STEP
        while True:
            stop = min(n, at + step)
            found = np.zeros(n, dtype=bool)
            found[self.falling[up, at:stop].ravel()] = True
            found[self.rising[down, at:stop].ravel()] = True
            found &= ~met
            new = np.flatnonzero(found)
            met |= found
            if met.all():
                yield new, held(v[new] @ anchor), None
                return
            last = v[self.falling[up, stop - 1], up], v[self.rising[down, stop - 1], down]
            threshold = (anchor[up] * last[0]).sum() + (anchor[down] * last[1]).sum()
            yield new, held(v[new] @ anchor), held(threshold)
            at, step = stop, stop

    def best(self, anchor: np.ndarray, accept: np.ndarray, windows: list[tuple], k: int) -> list[list[tuple]]:
        """For each window (low, high; None: open) its first ``k`` accepted rows: (score, id or None, row)."""
        met, scores = [], []
        for new, score, threshold in self.walk(anchor):
            take = accept[new]
            met.append(new[take])
            scores.append(score[take])
            if threshold is None:
                break
            so_far = np.concatenate(scores)
            if all(self.settled(so_far, threshold, low, high, k) for low, high in windows):
                break
        rows, so_far = np.concatenate(met), np.concatenate(scores)
        out = []
        for low, high in windows:
            inside = self.inside(so_far, low, high)
            mine, score = rows[inside], so_far[inside]
            if len(score) > k:
                top = score >= np.sort(score)[-k]
                mine, score = mine[top], score[top]
            found = [
                (-int(s), bool(self.id_null[i]), int(self.ids[i]), int(self.rids[i])) for s, i in zip(score.tolist(), mine.tolist())
            ]
            out.append([(-s, None if null else i, rid) for s, null, i, rid in sorted(found)[:k]])
        return out

    @staticmethod
    def inside(score: np.ndarray, low, high) -> np.ndarray:
        inside = np.ones(len(score), dtype=bool)
        if low is not None:
            inside &= (score >= low).astype(bool)
        if high is not None:
            inside &= (score <= high).astype(bool)
        return inside

    @classmethod
    def settled(cls, score: np.ndarray, threshold, low, high, k: int) -> bool:
        """No row of a score up to ``threshold`` can be among the first ``k`` of the window."""
        if low is not None and (threshold < low or high < low):
            return True
        score = score[cls.inside(score, low, high)]
        return len(score) >= k and bool(threshold < np.sort(score)[-k])


class Block:
    def __init__(self, dim: int, rids: bytes, ids: bytes, id_null: bytes, labels: bytes, v: bytes):
        self.rids, self.ids = np.frombuffer(rids, dtype=np.int64), np.frombuffer(ids, dtype=np.int64)
        self.id_null = np.frombuffer(id_null, dtype=bool)
        self.labels = np.frombuffer(labels, dtype=np.int64)
        self.v = np.frombuffer(v, dtype=np.float64).reshape(len(self.rids), dim)
        self.made: dict[int | None, Lists] = {}

    def lists(self, label: int | None = None) -> Lists:
        """Lists of all rows, or of those of one label (neighbours in the block)."""
        if label not in self.made:
            a, b = (0, len(self.labels)) if label is None else np.searchsorted(self.labels, (label, label + 1))
            self.made[label] = Lists(self.v[a:b], self.rids[a:b], self.ids[a:b], self.id_null[a:b], self.labels[a:b])
        return self.made[label]


def as_long(score: Column) -> Column:
    return F.greatest(F.lit(-LONG).cast(SCORE), F.least(F.lit(LONG - 1).cast(SCORE), score)).cast("bigint")


def share(score: int, of: tuple[int, int], up: bool) -> int:
    """``score`` times the fraction ``of``, rounded up or down."""
    return -(-score * of[0] // of[1]) if up else score * of[0] // of[1]


def visited(visits: DataFrame, positives: bool, k: int, low: tuple[int, int], high: tuple[int, int]) -> DataFrame:
    """The best rows of each block for each anchor that visits it: ``(anchor, window, score, vec_id, rid)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block = None
        for batch in batches:
            out: dict[str, list] = {"anchor": [], "window": [], "score": [], "vec_id": [], "rid": []}
            cols = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                c = {name: values[r] for name, values in cols.items()}
                if c["kind"] == 0:
                    block = Block(c["dim"], c["rids"], c["ids"], c["id_null"], c["labels"], c["v"])
                    continue
                anchor = np.frombuffer(c["v"], dtype=np.float64)
                if positives:
                    lists, windows = block.lists(c["label"]), [(None, None)]
                    accept = lists.rids != c["anchor"]
                else:
                    lists = block.lists()
                    windows = [(share(s, low, True), share(s, high, False)) for s in map(int, c["bounds"])]
                    accept = lists.labels != c["label"]
                for w, found in enumerate(lists.best(anchor, accept, windows, k)):
                    for score, vec_id, rid in found:
                        for name, value in zip(out, (c["anchor"], w, score, vec_id, rid)):
                            out[name].append(value)
            yield out

    n = int(visits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = visits.repartition(n, "bid").sortWithinPartitions("bid", "kind", "anchor")
    return map_arrow(dealt, run, f"anchor bigint, window int, score {SCORE}, vec_id bigint, rid bigint")


def first_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each anchor's window over all blocks, with their ``rank`` from 1."""
    by = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    label: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``vectors (vec_id, embedding, label)``.

    ``anchor`` says which rows are anchors, by ``vec_id``; ``label`` replaces the
    label of a row.  ``low`` and ``high`` are the shares of a positive's score between
    which its negatives' scores lie, both ends included.
    """
    spark = vectors.sparkSession
    rows = written(rows_of(vectors, F.col("label") if label is None else label, scale), "negatives-rows")
    blocks = written(blocks_of(rows, rows.count()), "negatives-blocks")
    anchors = rows.where(anchor).select(F.col("rid").alias("anchor"), "vec_id", "label", "dim", "v")

    def visits(guests: DataFrame) -> DataFrame:
        """Blocks, and the anchors that visit them (``bid`` and the columns of ``anchors``, ``bounds``)."""
        null = lambda name, kind: F.lit(None).cast(kind).alias(name)
        hosts = blocks.select(
            "bid", F.lit(0).alias("kind"), *(null(n, "bigint") for n in ("anchor", "vec_id", "label")), null("bounds", f"array<{SCORE}>"),
            "dim", "of_labels", "rids", "ids", "id_null", "labels", "v",
        )
        guests = guests.select(
            "bid", F.lit(1).alias("kind"), "anchor", "vec_id", "label", "bounds", "dim", null("of_labels", "array<bigint>"),
            *(null(n, "binary") for n in ("rids", "ids", "id_null", "labels")), "v",
        )
        return hosts.unionByName(guests)

    same = anchors.join(blocks.select("bid", "dim", F.explode("of_labels").alias("label")), ["dim", "label"])
    found = visited(visits(same.withColumn("bounds", F.lit(None).cast(f"array<{SCORE}>"))), True, positives, low, high)
    near = written(first_of(found, positives), "negatives-positives")

    # blocks of an anchor's label only hold none of its negatives
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))
    guests = anchors.join(bounds.select("anchor", F.col("p.score").alias("bounds")), "anchor")
    guests = guests.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    homes = blocks.select("bid", "dim", "of_labels", F.pmod(F.xxhash64("bid"), F.lit(shards)).cast("int").alias("shard"))
    other = guests.join(homes, ["dim", "shard"]).where(
        (F.size("of_labels") > 1) | (F.element_at("of_labels", 1) != F.col("label"))
    )
    found = first_of(visited(visits(other), False, negatives, low, high), negatives)
    ids = rows.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    chosen = near.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(ids, "anchor")
    return found.join(chosen, ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        as_long(F.col("positive_score")).alias("positive_score"), as_long(F.col("score")).alias("negative_score"),
    )
