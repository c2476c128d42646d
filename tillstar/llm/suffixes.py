"""Repeated passages by a sparse suffix array over the corpus.

Suffixes are kept only where the text itself says so: at the positions whose
``GRAM``-word hash is the smallest of ``SPARSE`` neighbouring ones, so any two
occurrences of a passage keep the same suffixes of it, and any ``MIN_WORDS``
words hold one among their first ``SPARSE`` positions with ``PREFIX`` =
MIN_WORDS - SPARSE + 1 of those words after it.

1. Sort: the kept suffixes are sorted over the cluster by the hash of their
   first ``PREFIX`` words (range partitions, so equal prefixes may be split over
   tasks) and each is compared with its neighbours; one equal to a neighbour
   is a match.  The first and last of a task stay too, as their neighbours lie
   in another task.
2. Extend: around matches only, the windows of ``MIN_WORDS`` words that begin up
   to SPARSE - 1 words left of a match (and so end that much further right) are
   sorted and compared with their neighbours in the same way; equal first and
   last ones of tasks are put together by a join of these few.
3. A document's repeated windows are merged into maximal passages.

Exact copies of a text are one text with a count here: all its words are
repeated if it has ``MIN_WORDS`` of them.  A passage counts as repeated when it
occurs at two places, in one document or in several.  Words are runs without
ASCII white space, compared as they stand (by 64-bit hashes).

Null and empty texts have no words; repeated rows each get their text's
result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import WordHash, grams, map_arrow, winnow, written

MIN_WORDS = 50
SPARSE = 26
GRAM = 8


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def kept_suffixes(texts: DataFrame, min_words: int, sparse: int) -> DataFrame:
    """``(key, id, at)``: kept suffixes of ``texts (id, text)`` with the hash of their prefix."""
    prefix = min_words - sparse + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHash()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = hashes.array(words_of(text.as_py()))
                if len(h) < min_words:
                    continue
                at = winnow(grams(h, min(GRAM, prefix)), sparse)
                key = grams(h, prefix)
                at = at[at < len(key)]
                yield {"key": key[at].view(np.int64), "id": np.full(len(at), i), "at": at.astype(np.int32)}

    return map_arrow(texts.select("id", "text"), run, "key bigint, id bigint, at int")


def equal_neighbours(rows: DataFrame, name: str) -> DataFrame:
    """Of ``rows (key, id, at)`` in sorted order, those whose key another place shares.

    Repeated rows count once.  ``sure``: a neighbour in the same task shares the
    key.  A task's first and last rows are marked ``edge`` and always kept, as
    their neighbours may lie in another task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held[:3], cols)]
            fresh = np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)]
            key, i, at = (c[fresh] for c in cols)
            same = key[1:] == key[:-1]
            edge, sure = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
            edge[0] = first if held is None else held[4]
            sure[1:] |= same
            sure[:-1] |= same
            sure[0] |= held is not None and held[3]
            first = False
            n = len(key) - 1  # the last row waits for its neighbour
            held = (key[n:], i[n:], at[n:], bool(sure[n]), bool(edge[n]))
            take = (sure | edge)[:n]
            cols = {"key": key, "id": i, "at": at, "sure": sure, "edge": edge}
            yield {name: c[:n][take] for name, c in cols.items()}
        if held is not None:
            yield {"key": held[0], "id": held[1], "at": held[2], "sure": np.array([held[3]]), "edge": np.array([True])}

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = written(rows, name).repartitionByRange(n, "key", "id", "at").sortWithinPartitions("key", "id", "at")
    return map_arrow(sorted_rows, run, "key bigint, id bigint, at int, sure boolean, edge boolean")


def windows(texts: DataFrame, places: DataFrame, min_words: int, sparse: int) -> DataFrame:
    """``(key, id, at)`` of the windows that the extension of matches to both sides can give.

    ``places (id, doc_id, places)``: the matches in each text, and the row of
    ``texts (id, doc_id, text)`` that stands for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHash()
        for batch in batches:
            for i, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                key = grams(hashes.array(words_of(text.as_py())), min_words)
                step = np.zeros(len(key) + 1, dtype=np.int32)
                p = np.array(places.as_py(), dtype=np.int64)
                np.add.at(step, np.clip(p - sparse + 1, 0, len(key)), 1)
                np.add.at(step, np.minimum(p + 1, len(key)), -1)
                at = np.flatnonzero(np.cumsum(step)[:-1] > 0)
                yield {"key": key[at].view(np.int64), "id": np.full(len(at), i), "at": at.astype(np.int32)}

    one = texts["id"].eqNullSafe(places["id"]) & texts["doc_id"].eqNullSafe(places["doc_id"])
    joined = texts.join(places, one).select(texts["id"], "text", "places")
    return map_arrow(joined, run, "key bigint, id bigint, at int")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``(id, at)`` of rows whose key occurs at two places."""
    found = written(equal_neighbours(rows, "suffix-windows"), "suffix-repeated")
    edge = found.filter("edge")  # two rows a task
    # a key that goes on in another task is the last of one and the first of the next
    several = edge.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    settled = edge.filter("not sure").join(several, "key", "left_semi")
    return found.filter("sure").select("id", "at").union(settled.select("id", "at"))


def merged_spans(starts: DataFrame, min_words: int) -> DataFrame:
    """``(id, spans)``: windows that overlap or touch put together, as word ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            spans = []
            for cell in batch.column(1):
                at = np.unique(np.array(cell.as_py(), dtype=np.int64))
                cut = np.flatnonzero(np.diff(at) > min_words) + 1
                spans.append([
                    {"start": int(r[0]), "end": int(r[-1]) + min_words} for r in np.split(at, cut)
                ])
            yield {"id": batch.column(0), "spans": spans}

    listed = starts.groupBy("id").agg(F.collect_list("at").alias("at"))
    return map_arrow(listed, run, "id bigint, spans array<struct<start:int,end:int>>")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, sparse: int = SPARSE) -> DataFrame:
    """A row per row of ``docs (doc_id, text)``.

    ``(doc_id, class_id, n_copies, n_words, n_repeated, spans)``: ``class_id``
    is the smallest doc_id with the same text, ``n_copies`` their number,
    ``spans`` the repeated passages as word ranges (end exclusive),
    ``n_repeated`` the words in them.
    """
    whole = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", whole.alias("text"), F.xxhash64(whole, F.length(whole)).alias("id"))
    narrow = written(
        texts.select("doc_id", "id", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n_words")), "suffix-docs"
    )
    classes = narrow.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))
    matches = equal_neighbours(kept_suffixes(texts, min_words, sparse), "suffixes")
    places = matches.groupBy("id").agg(F.collect_list("at").alias("places")).join(classes.drop("n_copies"), "id")
    spans = merged_spans(repeated_windows(windows(texts, written(places, "suffix-places"), min_words, sparse)), min_words)
    of_class = classes.withColumnRenamed("doc_id", "class_id").join(spans, "id", "left")
    rows = narrow.join(of_class, "id")
    one = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    rows = rows.withColumn(
        "spans",
        F.when((F.col("n_copies") > 1) & (F.col("n_words") >= min_words), one).otherwise(F.coalesce("spans", none)),
    )
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        "doc_id", "class_id", "n_copies", F.col("n_words").cast("long").alias("n_words"), total.alias("n_repeated"), "spans"
    )
