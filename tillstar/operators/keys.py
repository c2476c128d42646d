"""Ordered surrogate ids without a single-partition window (K1, K2, A4).

One algorithm numbers every frame, whatever its size: the rows are
range-partitioned on the sort key (plus a unique tiebreaker where the key
repeats, so even one key value holding a third of the rows is spread over many
tasks), sorted within their partition and written to the shared folder with
``monotonically_increasing_id`` (partition index in the high bits, position in
the low bits).  The written copy fixes the ranges, whose bounds come from
sampling.  The rows of each partition are then counted (at most one row per
partition reaches the driver), and an id is the partition's offset plus the
position.  The result is ``start + 1 + (rank of the row in the order)`` and the
same on every retry.

Group numbers (A4) of several keys come from one pass: the keys are stacked as
(kind, key), made distinct once, numbered together in (kind, key) order, and
each kind's first position is taken off.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.session import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1

# Up to this many range partitions the offsets travel as a literal array in
# the plan; beyond, as a broadcast frame (still at most one row per partition).
LITERAL_OFFSETS_MAX = 4096
# Bytes of keys and ids up to which a frame is broadcast (only the join's plan depends on it).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Bytes of a row besides its texts, as counted against BROADCAST_MAX_BYTES.
ROW_BYTES = 64


def _asc(cols: Sequence) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in cols]


class RangedIds:
    """Result of :func:`ranged_ids`: the numbered frame and the row total."""

    def __init__(self, frame: DataFrame, total: int):
        self.frame = frame
        self.total = total


def ranged_ids(
    df: DataFrame,
    order: Sequence,
    id_col: str,
    path: str,
    start: int = 0,
    tiebreak: Sequence = (),
    num_partitions: int | None = None,
) -> RangedIds:
    spark = df.sparkSession
    keys = _asc(list(order) + list(tiebreak))
    # Without an explicit count the range exchange may be coalesced by AQE:
    # neighbouring ranges merge, so partition indexes still follow key order.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys)
    ranged = materialize(ranged.withColumn("_rid", F.monotonically_increasing_id()), path)
    part = F.shiftright(F.col("_rid"), _POS_BITS)
    # One row per range partition: bounded by n, collected to the driver.
    counts = sorted((int(r[0]), int(r[1])) for r in ranged.groupBy(part.alias("_p")).count().collect())
    offsets, acc = {}, 0
    for p, c in counts:
        offsets[p] = acc
        acc += c
    pos = F.col("_rid").bitwiseAND(F.lit(_POS_MASK))
    base = int(start)
    if not counts:
        out = ranged.withColumn(id_col, F.lit(None).cast("bigint"))
    elif len(counts) <= LITERAL_OFFSETS_MAX:
        top = counts[-1][0]
        arr = F.array(*[F.lit(offsets.get(i, 0)) for i in range(top + 1)])
        out = ranged.withColumn(id_col, (F.lit(base) + F.element_at(arr, (part + 1).cast("int")) + pos + 1).cast("bigint"))
    else:
        off = spark.createDataFrame(list(offsets.items()), "_p bigint, _off bigint")
        out = ranged.join(F.broadcast(off), part == off["_p"])
        out = out.withColumn(id_col, (F.lit(base) + F.col("_off") + pos + 1).cast("bigint")).drop("_p", "_off")
    return RangedIds(out.drop("_rid"), acc)


def ordered_ids_ranged(
    df: DataFrame,
    order: Sequence,
    id_col: str,
    path: str,
    start: int = 0,
    tiebreak: Sequence = (),
    num_partitions: int | None = None,
) -> DataFrame:
    return ranged_ids(df, order, id_col, path, start, tiebreak, num_partitions).frame


@dataclass
class GroupMaps:
    """``table``: (key_kind, key_value, group_no) of all kinds; ``nbytes``: size of each kind's keys and numbers."""

    table: DataFrame
    nbytes: dict[str, int]

    def of(self, kind: str, key: str, out_col: str) -> DataFrame:
        """(key, number) of one kind, broadcast where its measured size allows it."""
        m = self.table.where((F.col("key_kind") == kind) & F.col("key_value").isNotNull())
        m = m.select(F.col("key_value").alias(key), F.col("group_no").alias(out_col))
        return F.broadcast(m) if self.nbytes.get(kind, 0) <= BROADCAST_MAX_BYTES else m


def group_maps(df: DataFrame, kinds: Mapping[str, str], path: str) -> GroupMaps:
    """A4: 0-based rank of each distinct text key of each kind (kind -> column); -1 for NULL."""
    return number_keys(stacked_keys(df, kinds), path)


def stacked_keys(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """(key_kind, key_value) of every row and kind."""
    args = ", ".join(f"'{kind}', `{col}`" for kind, col in kinds.items())
    return df.selectExpr(f"stack({len(kinds)}, {args}) as (key_kind, key_value)")


def number_keys(stacked: DataFrame, path: str) -> GroupMaps:
    """The numbers of ``group_maps`` for keys as ``stacked_keys`` gives them, in any number."""
    keys = stacked.distinct()
    ids = ordered_ids_ranged(keys, ["key_kind", "key_value"], "_id", path)
    size = F.sum(F.coalesce(F.octet_length("key_value"), F.lit(0)) + ROW_BYTES)
    nulls = F.count_if(F.col("key_value").isNull())  # NULL sorts first within its kind
    stats = ids.groupBy("key_kind").agg(F.min("_id"), nulls, size).collect()  # one row per kind
    if not stats:
        return GroupMaps(ids.select("key_kind", "key_value", F.col("_id").alias("group_no")), {})
    first = F.create_map(*[F.lit(v) for kind, low, null, _ in stats for v in (kind, int(low) + int(null))])
    table = ids.select("key_kind", "key_value", (F.col("_id") - first[F.col("key_kind")]).cast("bigint").alias("group_no"))
    return GroupMaps(table, {kind: int(n) for kind, _, _, n in stats})


def join_group_number(df: DataFrame, maps: GroupMaps, kind: str, key: str, out_col: str) -> DataFrame:
    """The number of each row's key (NULL key: -1); a join too large to broadcast is left to AQE's skew split."""
    out = df.join(maps.of(kind, key, out_col), key, "left")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(-1).cast("bigint")))


def group_numbers(df: DataFrame, key: str, out_col: str, path: str) -> DataFrame:
    """A4 for one key: 0-based rank of each distinct non-null key in sorted order, joined back; NULL keys get -1."""
    return join_group_number(df, group_maps(df, {key: key}, path), key, key, out_col)
