"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import materialize, work_dir

U64 = np.uint64
# Odd multiplier of the rolling word-gram hash (fixed value, golden ratio).
GRAM_BASE = 0x9E3779B97F4A7C15
# Entries a per-worker word cache may hold before it starts anew (memory bound only).
CACHE_WORDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back (cuts lineage)."""
    return materialize(df, f"{work_dir(df.sparkSession, name)}/data")


def map_arrow(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function that yields dicts of column lists."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def kept_rows(df: DataFrame, masks: Callable[[Iterator[pa.RecordBatch]], Iterator[list[bool]]]) -> DataFrame:
    """The rows of ``df`` that ``masks`` (one for each batch, in order) lets pass; read once, nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                yield batch

        for mask in masks(noted()):
            yield held.pop(0).filter(pa.array(mask, type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered per worker within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that their order looks random."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
        return h ^ (h >> U64(32))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for i in range(1, k):
            out *= U64(GRAM_BASE)
            out += h[i : i + n]
    return mix(out)


def winnow(g: np.ndarray, w: int) -> np.ndarray:
    """Positions of the (rightmost) smallest gram of every ``w`` consecutive ones."""
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    best, at = g[:n].copy(), np.zeros(n, dtype=np.int64)
    for i in range(1, w):
        take = g[i : i + n] <= best
        best[take] = g[i : i + n][take]
        at[take] = i
    at += np.arange(n)
    return at[np.r_[True, at[1:] != at[:-1]]]


KEY = "struct<doc_id:bigint,h:bigint>"


def row_key(doc_id: str = "doc_id", text: str = "text") -> F.Column:
    """A key of a document row: its id and a hash of its text (null safe inside the struct)."""
    return F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"))


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of undirected ``edges (a, b)``: rows ``(node, root)``.

    ``root`` is the smallest node of the component.  Alternates large-star and
    small-star steps (each a group-wise minimum and a join, nothing is
    collected but a count and a checksum); every step is a written table.
    Nodes that occur only in edges to themselves are left out.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, last = written(e, name), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every edge now points down (u > v)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        e = written(small, name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
