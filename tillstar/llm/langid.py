"""Language identification with a blended-spectrum string kernel.

A text's features are the distinct runs of 1 to 4 characters (of its letters
and word gaps), hashed to ``BINS`` bins; the kernel of two texts is the number
of shared features over the geometric mean of their counts.  The kernel is
approximated with Nyström landmarks (labelled texts) and each language gets a
one-versus-rest kernel ridge regression, so scoring a batch of texts is two
matrix products: features x landmarks, then kernel x coefficients.

Fitted on a bounded sample: the ``MAX_LANGUAGES`` most frequent languages (ties by
name), up to ``per_language`` labelled rows of each and ``MAX_LEARNED`` in all, the
smallest by a hash of their id and text; at most ``MAX_LANDMARKS`` of them are landmarks.  All rows are scored.

Null texts and texts without a letter are 'und' with score 0; rows with a null
language are never learned from; ties go to the language first in order;
repeated rows are scored alike; an empty table gives no rows; without any
labelled row everything is 'und'.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import kept_rows, map_arrow

BINS = 1 << 16
MAX_GRAM = 4
PER_LANGUAGE = 300  # labelled texts learned from, per language
LANDMARKS = 24  # of them, landmarks, per language
# Bounds of what the driver and the model hold, whatever the labels are.
MAX_LANGUAGES = 256
MAX_LEARNED = 2400
MAX_LANDMARKS = 384
RIDGE = 1e-2
NO_LETTERS = re.compile(r"[\W\d_]+")
BATCH = 512


def features(text: str | None) -> np.ndarray | None:
    """Presence (bool) of each feature bin; None for a text without letters."""
    plain = NO_LETTERS.sub(" ", text.lower()) if text else ""
    if not plain.strip():
        return None
    flags = np.zeros(BINS, dtype=bool)
    c = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    h = np.zeros(len(c), dtype=np.uint32)
    for n in range(1, MAX_GRAM + 1):
        if len(c) < n:
            break
        m = len(c) - n + 1
        h = h[:m] * np.uint32(0x01000193) + c[n - 1 :]
        flags[((h ^ np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
    return flags


@dataclass
class Model:
    """Landmark features (used bins only) and regression coefficients."""

    languages: list[str]
    bins: np.ndarray  # bins that any landmark has
    landmarks: np.ndarray  # (bins, landmarks) float32, each column over the root of its feature count
    weights: np.ndarray  # (landmarks, languages) float32

    def scores(self, flags: list[np.ndarray]) -> np.ndarray:
        x = np.stack([f[self.bins] for f in flags]).astype(np.float32)
        x /= np.sqrt(np.array([f.sum() for f in flags], dtype=np.float32))[:, None]
        return (x @ self.landmarks) @ self.weights


def train(rows: list[tuple[str, np.ndarray]], per_language: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Nyström kernel ridge regression on (language, presence) rows."""
    if not rows:
        return None
    names = sorted({name for name, _ in rows})
    per_language = max(1, min(per_language, MAX_LANDMARKS // len(names)))
    marks, seen = [], dict.fromkeys(names, 0)
    for name, flags in rows:
        if seen[name] < per_language:
            seen[name] += 1
            marks.append(flags)
    bins = np.flatnonzero(np.any(marks, axis=0))
    land = np.stack([m[bins] for m in marks]).astype(np.float32)
    land /= np.sqrt(np.array([m.sum() for m in marks], dtype=np.float32))[:, None]
    among = (land @ land.T).astype(np.float64)
    value, vector = np.linalg.eigh(among)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])  # maps kernel rows to Nyström features
    phi = np.empty((len(rows), root.shape[1]))
    for at in range(0, len(rows), BATCH):
        part = [f for _, f in rows[at : at + BATCH]]
        x = np.stack([f[bins] for f in part]).astype(np.float32)
        x /= np.sqrt(np.array([f.sum() for f in part], dtype=np.float32))[:, None]
        phi[at : at + BATCH] = (x @ land.T).astype(np.float64) @ root
    y = np.array([[float(name == n) for n in names] for name, _ in rows])
    gram = phi.T @ phi + ridge * len(rows) / len(names) * np.eye(phi.shape[1])
    weights = root @ np.linalg.solve(gram, phi.T @ y)
    return Model(names, bins, np.ascontiguousarray(land.T), weights.astype(np.float32))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model | None:
    """Fit on a bounded sample of ``labelled (doc_id, text, lang)``.

    The sample's features (8 KB each) come to the driver, not its texts.
    """
    from pyspark.sql import Window

    known = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    counts = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES)
    share = {r.lang: r.rows for r in counts.collect()}
    if not share:
        return None
    per_language = max(1, min(per_language, MAX_LEARNED // len(share)))
    # a hash threshold per language thins large ones before the ordered cut
    thresholds = [(name, int(min(1.0, 4 * per_language / n) * (1 << 40))) for name, n in share.items()]
    cut = labelled.sparkSession.createDataFrame(thresholds, "lang string, cut bigint")
    rank = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    thin = known.withColumn("rank", rank).join(F.broadcast(cut), "lang").filter(F.col("rank") <= F.col("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = [
                (name, r, np.packbits(f).tobytes())
                for name, r, f in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), (features(t.as_py()) for t in batch.column(2))
                )
                if f is not None
            ]
            yield {"lang": [r[0] for r in rows], "rank": [r[1] for r in rows], "bits": [r[2] for r in rows]}

    thin = map_arrow(thin.select("lang", "rank", "text"), run, "lang string, rank bigint, bits binary")
    best = Window.partitionBy("lang").orderBy("rank", "bits")
    picked = thin.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= per_language).orderBy("lang", "n")
    rows = [(r.lang, np.unpackbits(np.frombuffer(r.bits, dtype=np.uint8)).astype(bool)) for r in picked.collect()]
    return train(rows, landmarks)


def judged(texts: pa.Array, model: Model | None) -> Iterator[tuple[str, float, bool]]:
    """(language, score, has letters) of each text."""
    for start in range(0, len(texts), BATCH):
        flags = [features(t.as_py()) for t in texts.slice(start, BATCH)]
        known = [i for i, f in enumerate(flags) if f is not None and model is not None]
        pred, score = ["und"] * len(flags), [0.0] * len(flags)
        if known:
            for i, row in zip(known, model.scores([flags[i] for i in known])):
                j = int(row.argmax())
                pred[i], score[i] = model.languages[j], float(min(1.0, max(0.0, row[j])))
        yield from zip(pred, score, (f is not None for f in flags))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs (doc_id, text)``.

    The model (landmarks are bounded by parameter) is sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = list(judged(batch.column(1), sent.value))
            yield {"doc_id": batch.column(0), "lang_pred": [r[0] for r in rows], "score": [r[1] for r in rows]}

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """Rows of ``docs`` (all columns) with letters and a best score of ``least`` or more; without a model, with letters."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bool]]:
        for batch in batches:
            yield [letters and (sent.value is None or score >= least) for _, score, letters in judged(batch.column(at), sent.value)]

    return kept_rows(docs, masks)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row's fold (crc32 of its id as text) is the one never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
